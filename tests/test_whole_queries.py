import datetime as dt
import hashlib
import json

from newsloom import queries

TITLES = ["Élan Vital opened in Köln by ÖBBund and Bräu", "Der Hafen von Bordak wächst", "Москва Today and BBC", "渡轮 opens in Kelfen", "Plain Title of Bordak"]
TIMES = ["2025-01-31T10:00:00Z", "2025-01-29T23:59:59Z", "2025-02-30T10:00:00Z", "2025-03-30T10:00:00.250Z", "2025-03-31T10:00:00+02:00"]


def _folder(spark, path, rows):
    schema = "ingest_seq bigint, run_id string, source_id string, title string, source_url string, summary string, byline string, source_tags array<string>, published_at string"
    spark.createDataFrame(rows, schema).write.parquet(str(path / "raw_items.parquet"))
    return str(path)


def _rows():
    return [(i, "r", f"s{i % 2}", t, f"http://x.org/{i}", f"{t} am Abend", "Jörg Ås", ["tag"], TIMES[i]) for i, t in enumerate(TITLES)]


def test_event_ids_of_large_groups(spark, tmp_path):
    rows = [(i, "r", "s", "One large title" if i < 120 else "Small group" if i < 123 else f"Alone {i}", "", "", "", [], "") for i in range(130)]
    want = {(n, hashlib.sha1("|".join(sorted(map(str, m))).encode()).hexdigest()[:12]) for n, m in ((120, range(120)), (3, range(120, 123)))}
    assert {(r["n"], r["event_id"]) for r in queries.QUERIES["event_ids"](spark, _folder(spark, tmp_path, rows)).collect()} == want


def test_iso_instants_of_month_ends(spark, tmp_path):
    got = {r["ingest_seq"]: r["instant"] for r in queries.QUERIES["iso_instants_all"](spark, _folder(spark, tmp_path, _rows())).collect()}
    d = dt.datetime
    assert got == {0: d(2025, 1, 31, 10), 1: d(2025, 1, 29, 23, 59, 59), 2: None, 3: d(2025, 3, 30, 10, 0, 0, 250_000), 4: d(2025, 3, 31, 8)}


def test_readers_and_names_beyond_ascii(spark, tmp_path):
    folder = _folder(spark, tmp_path, _rows())
    names = {r["name"]: r["n"] for r in queries.QUERIES["named_words_all"](spark, folder).collect()}
    assert set(names) == {"Vital", "Der", "Hafen", "Bordak", "Today", "BBC", "Kelfen", "Plain", "Title"}
    assert {k: names.get(k) for k in ("Vital", "Hafen", "Today", "BBC", "Kelfen", "Bordak")} == {"Vital": 1, "Hafen": 1, "Today": 1, "BBC": 1, "Kelfen": 1, "Bordak": 2}
    rss = {(r["title"], r["source_url"], r["n"]) for r in queries.QUERIES["rss_round_trip_all"](spark, folder).collect()}
    assert rss == {(t, f"http://x.org/{i}", 1) for i, t in enumerate(TITLES)}
    listed = {(r["title"], r["summary"], r["byline"], json.dumps(r["source_tags"])) for r in queries.QUERIES["json_round_trip_all"](spark, folder).collect()}
    assert listed == {(t, f"{t} am Abend", "Jörg Ås", '["tag"]') for t in TITLES}


def test_equal_titles_are_not_matched_by_characters(monkeypatch):
    """Pairs of equal titles, most of `merge_decisions`, are 1.0 at once, as the matcher finds, however long."""
    import difflib

    import pyarrow as pa

    from newsloom.functions import text

    ratio = lambda x, y: text.sequence_ratio.func(pa.array([x]), pa.array([y])).to_pylist()
    long_ = "a" * 300
    assert ratio(long_, long_) == [difflib.SequenceMatcher(None, long_, long_).ratio()] == [1.0]
    assert ratio("abc", "abd") == [difflib.SequenceMatcher(None, "abc", "abd").ratio()]
    monkeypatch.delattr(difflib.SequenceMatcher, "ratio")
    assert ratio("harbor opens", "harbor opens") == [1.0] and ratio(None, "") == [1.0]


def test_ratio_of_short_texts_is_the_matchers(monkeypatch):
    """Texts of any kind get what the matcher gives, which only long ones are left to."""
    import difflib
    import random

    from newsloom.functions import text

    random.seed(3)
    cases = [("", "a"), ("a", ""), ("abxcd", "abcd"), ("a" * 198, "a" * 199)]
    for _ in range(3000):
        letters = random.choice(["ab", "abcdefgh ", "aб云𐍈z "])
        cases.append(tuple("".join(random.choices(letters, k=random.randint(0, random.choice([4, 20, 70])))) for _ in range(2)))
    for _ in range(20):
        cases.append(tuple("".join(random.choices("abcde ", k=random.randint(190, 210))) for _ in range(2)))
    want = [difflib.SequenceMatcher(None, x, y).ratio() for x, y in cases]
    assert [text.matching_ratio(x, y) for x, y in cases] == want
    monkeypatch.delattr(difflib.SequenceMatcher, "ratio")
    assert [text.matching_ratio(x, y) for x, y in cases[:1000]] == want[:1000]


def test_words_are_runs_of_letters(spark):
    """The words taken at once are those of `plain_words` parted at blanks."""
    from pyspark.sql import functions as F

    from newsloom.functions import text

    titles = [*TITLES, "", " ", "a b cd", "A-b. 42 x7, 4", "渡 轮船 x渡", "cd CD cd ef", "İstanbul ẞ Straße", None]
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    for least in (1, 2, 3):
        parted = F.array_distinct(F.filter(F.split(text.plain_words(F.col("t")), " "), lambda w: F.length(w) >= least))  # noqa: B023
        assert all(r[0] == r[1] for r in df.select(text.word_array(F.col("t"), least), parted).collect())


def test_titles_of_few_pairs_are_not_shuffled(spark, tmp_path):
    """Only the titles that a pair names are written and joined; titles themselves are neither shuffled nor sorted."""
    rows = [(i, "harbor bridge opens in the north" + (" today" if i % 2 else " now"), "x", 1_700_000_000 + 3600 * i) for i in range(4)] + [(10 + i, f"title {i} w{i} v{i}", "x", 1_700_000_000) for i in range(50)]
    from pyspark.sql import functions as F

    spark.createDataFrame(rows, "ingest_seq bigint, title string, section string, at bigint").withColumn("fetched_at", F.timestamp_seconds("at").cast("timestamp_ntz")).write.parquet(str(tmp_path / "raw_items.parquet"))
    found = queries.QUERIES["title_ratio"](spark, str(tmp_path))
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and "raw_items" not in plan
    assert [(r["a"], r["b"]) for r in found.collect()] == [(0, 1)] and abs(found.first()["ratio"] - 2 * 33 / 71) < 0.05


def test_merge_decisions_are_those_of_all_pairs(spark, tmp_path):
    """Every pair that a rule merges is told, over sections, sources and other spellings, whoever came first, and the refused ones of one address or like words."""
    import random

    from pyspark.sql import functions as F

    from newsloom import event_queries as q
    from newsloom.functions import text
    from newsloom.operators import stories
    from newsloom.plans import rules

    random.seed(8)
    heads = ["Kelfen Harbor Trust opens the northern tunnel today", "Kelfen Harbor Trust open the northern tunnels today", "kelfenharbor trust opens the northerntunnel today", "Senate of Bordak and Zorvik Works refuse a treaty", "Zorvik Works, Bordak: a treaty is refused in the Senate", "Москва", "Ж", "", "Port", "Ports", "A quite different story about cats"]
    rows = [(i, random.choice(heads), random.choice(["", "the tunnel is open and the trust is glad", "a treaty is refused"]), random.choice(["s", "t", "u", None]), random.choice(["x", "y", None]), random.choice(["http://h.org/1", "http://h.org/2", f"http://h.org/{i}", f"http://k.org/{i}", ""]), 1_700_000_000 + 3600 * random.randrange(0, 300, 7) if i % 11 else None) for i in range(130)]
    items = spark.createDataFrame(rows, "ingest_seq bigint, title string, summary string, source_id string, section string, canonical_url string, at bigint").withColumns({"fetched_at": F.timestamp_seconds("at").cast("timestamp_ntz"), "source_url": F.lit("")})
    items.write.parquet(str(tmp_path / "raw_items.parquet"))
    e = text.missing_as_empty
    title = e(F.col("title"))
    own = {
        "source": F.col("source_id"), "url": text.page_identity(F.col("canonical_url")), "plain": text.plain_title(title), "host": text.host(F.col("canonical_url")), "words": text.word_array(F.concat(title, F.lit(" "), F.col("summary")), 3),
        "names": rules.entities(title), "tag": F.coalesce(F.get(rules.soft_tags(title, q._TAGS), F.lit(0))["tag"], F.lit("")), "at": F.col("fetched_at").cast("timestamp"), "w": text.word_array(title, 2),
    }
    side = lambda i, n: items.select(F.col("ingest_seq").alias(i), F.struct(*(c.alias(k) for k, c in own.items())).alias(n))
    near = F.abs(F.unix_micros("l.at") - F.unix_micros("r.at")) <= 48 * 3_600_000_000
    asked = (F.col("l.url") != "") & (F.col("l.url") == F.col("r.url")) | near & (text.jaccard(F.col("l.w"), F.col("r.w")) >= 0.5)
    every = stories.merges(side("a", "l").crossJoin(side("b", "r")).filter("a < b")).filter(F.col("merges") | asked)
    want = sorted(map(tuple, every.select("a", "b", "merges", "reason", "confidence").collect()))
    got = sorted(map(tuple, q.merge_decisions(spark, str(tmp_path)).collect()))
    assert got == want and len({x[3] for x in want}) >= 6

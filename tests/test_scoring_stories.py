import os
import random

from pyspark.sql import functions as F

from newsloom import event_queries
from newsloom.operators import events, scoring, stories
from newsloom.plans import packs


def _value(spark, c):
    return spark.range(1).select(c.alias("v")).first()["v"]


def test_points_by_tables(spark):
    lit = lambda x: F.lit(x).cast("string")
    platform = lambda t, g, r: _value(spark, F.least(F.lit(25.0), scoring.by_name(lit(t), packs.TIER_POINTS, 6) + scoring.by_name(lit(g), packs.GROUP_POINTS, 3) + scoring.by_name(lit(r), packs.ROLE_POINTS, 1.5)))
    assert platform("T1", "wire", "verification") == 24 and platform("T1", "regulator", "verification") == 25
    assert platform("?", None, "else") == 10.5
    rows = [(1, "homepage_top"), (11, "Latest "), (None, None), (21, ""), (-3, "my trend list"), (2, "top stories")]
    df = spark.createDataFrame(rows, "rank_position int, rank_section string")
    assert [r[0] for r in df.select(event_queries._rank_points()).collect()] == [25, 13, 8, 5, 12, 21]


def test_best_of_groups_takes_the_first_of_equals(spark):
    df = spark.createDataFrame([(1, "g", 5.0), (2, "g", 9.0), (3, "g", 9.0), (4, "h", 1.0), (5, None, 2.0)], "id int, grp string, s double")
    assert {tuple(r) for r in scoring.best_of_groups(df, "grp", "id", [], ["s"]).collect()} == {("g", 9.0, 2), ("h", 1.0, 4), (None, 2.0, 5)}
    assert scoring.best_of_groups(df.limit(0), "grp", "id", [], ["s"]).count() == 0


def test_rows_under_the_threshold_do_not_count_against_a_cap(spark):
    df = spark.createDataFrame([(i, "a" if i % 2 else "b", i) for i in range(20)], "id int, cat string, score int")
    got = scoring.chosen(df, "score", F.when(F.col("cat") == "a", 10).otherwise(3), F.col("cat"), [F.col("id")], {"a": 2}, 4, 5)
    assert [(r["id"], r["place"]) for r in got.orderBy("place").collect()] == [(19, 1), (18, 2), (17, 3), (16, 4), (14, 5)]


def test_first_fit_is_not_the_closure_and_settles_long_chains(spark):
    order = {"a": 0, "b": 1, "c": 2, "d": 3}
    items = spark.createDataFrame([(k, v) for k, v in order.items()], "id string, t int")
    edges = spark.createDataFrame([("c", "a"), ("c", "b"), ("d", "b")], "a string, b string")
    assert {r["id"]: r["bucket"] for r in events.first_fit(items, edges, "id", [F.col("t")]).collect()} == {"a": "a", "b": "b", "c": "a", "d": "b"}
    chain = spark.range(260).select("id", F.col("id").alias("t"))
    links = spark.range(1, 260).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    assert events.first_fit(chain, links, "id", [F.col("t")]).filter("bucket <> 0").count() == 0
    assert events.first_fit(items, edges.limit(0), "id", [F.col("t")]).filter("bucket <> id").count() == 0


def test_first_fit_matches_a_replay(spark):
    random.seed(2)
    n = 60
    links = {(random.randrange(n), random.randrange(n)) for _ in range(70)}
    links = {(a, b) for a, b in links if a != b}
    met = {frozenset(x) for x in links}
    buckets = []
    for i in range(n):
        home = next((b for b in buckets if any(frozenset((i, j)) in met for j in b)), None)
        (home.append(i) if home else buckets.append([i]))
    want = {i: b[0] for b in buckets for i in b}
    items = spark.createDataFrame([(i,) for i in range(n)], "id long")
    got = events.first_fit(items, spark.createDataFrame(list(links), "a long, b long"), "id", [F.lit(0).alias("same")])
    assert {r["id"]: r["bucket"] for r in got.collect()} == want


def test_pairs_are_found_without_a_loss(spark):
    """Every pair the cascade merges is a candidate: against all pairs of a small set."""
    random.seed(7)
    words = [f"{a}{b}{c}" for a in "bdf" for b in "aeo" for c in "lmnr"]
    rows = []
    for i in range(70):
        base = random.sample(words, 10) if i % 3 == 0 or not rows else rows[-1][5].split()
        text = [random.choice(words) if random.random() < 0.25 else w for w in base]
        if i % 5 == 0:
            text += ["Zorvik", "Brenda"]
        at = random.randrange(0, 150) * 3_600_000_000
        rows.append((i, random.choice(["x", "y"]), at, at + random.choice([0, 4]) * 3_600_000_000, random.choice(["s", "t", None]), " ".join(text)))
    df = spark.createDataFrame([(*r[:5], "media", r[5], None) for r in rows], "node long, g string, t0 long, t1 long, source string, source_group string, title string, summary string")
    r = stories.StoryRules(anchors=["bal", "dem"], broad=["dem"], families={"f": ["fol"]}, stop=["fen"])
    f = stories.features(df, "title", "summary", r).drop("title", "summary").cache()
    got = {tuple(x)[:2] for x in stories.decisions(f, r).filter("merges").collect()}
    feats = {x["node"]: x for x in f.collect()}
    best = set()
    for a in feats.values():
        for b in feats.values():
            if a["node"] < b["node"] and a["g"] == b["g"]:
                w = set(a["words"]) & set(b["words"])
                sim = len(w) / len(set(a["words"]) | set(b["words"]))
                gap = max(0, b["t0"] - a["t1"], a["t0"] - b["t1"]) / 3.6e9
                if gap <= r.hours and sim >= r.high_similarity:
                    best.add((a["node"], b["node"]))
                firm = (set(a["anchors"]) & set(b["anchors"])) - set(r.broad)
                if gap <= r.anchor_hours and len(firm) >= 2 and len(w) >= 3 and sim >= r.action_below and a["key"] != b["key"]:
                    best.add((a["node"], b["node"]))
    assert len(best) > 5 and best <= got
    assert stories.decisions(f.limit(0), r).count() == 0


def test_rounds_of_first_fit_keep_no_estimates(spark, monkeypatch):
    """Each round is written as a table of known size, so the optimizer's estimates do not grow with the rounds; only the last table of labels is left."""
    pins = {n: getattr(events, n) for n in ("pin", "pin_table") if hasattr(events, n)}
    bits, kept = [], []

    def spy(pinned):
        def run(df):
            bits.append(int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())).bit_length())
            kept.append(pinned(df))
            return kept[-1]

        return run

    for n, f in pins.items():
        monkeypatch.setattr(events, n, spy(f))
    chain = spark.range(70).select("id", F.col("id").alias("t"))
    links = spark.range(1, 70).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    assert events.first_fit(chain, links, "id", [F.col("t")]).filter("bucket <> 0").count() == 0
    assert len(bits) > 7 and max(bits) < 300
    labels = [df for df in kept if df.columns == ["later", "l"]]
    left = [os.path.exists(df.inputFiles()[0].removeprefix("file://")) for df in labels]
    assert left[-1] and not any(left[:-1])


def test_kept_candidates_match_a_fold(spark):
    random.seed(4)
    rows = [(i, random.choice("abcd"), random.choice(["u1", "u2", "u3", "u4", f"v{i}", "", None]), random.choice(["k1", "k2", f"t{i}", "", None]), random.randrange(5)) for i in range(120)]
    limits = {"a": 3, "b": 8, "c": 5}
    want, urls = set(), set()
    for s in sorted({r[1] for r in rows}, key=lambda s: min(r[0] for r in rows if r[1] == s)):
        n, keys = 0, set()
        for i, _, u, k, _ in sorted((r for r in rows if r[1] == s), key=lambda r: (r[4], r[0])):
            if (u and u in urls) or (k and k in keys) or n >= limits.get(s, 6):
                continue
            want.add(i)
            urls.add(u)
            keys.add(k)
            n += 1
    df = spark.createDataFrame(rows, "id long, s string, u string, k string, r int")
    top = spark.createDataFrame(list(limits.items()), "source string, top_k int")
    got = stories.kept_candidates(df, top, "id", "s", F.col("u"), F.col("k"), [F.col("r").alias("r")], 6)
    assert {r["id"] for r in got.collect()} == want
    assert stories.kept_candidates(df.limit(0), top, "id", "s", F.col("u"), F.col("k"), [F.col("r").alias("r")], 6).count() == 0


def test_merge_rules_in_their_order(spark):
    import datetime as dt

    t0, t1, t2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2), dt.datetime(2025, 1, 9)

    def report(source="s", url="", host="", plain="harbor opens", words=("harbor",), names=(), tag="", at=t0):
        return (source, url, host, plain, list(words), list(names), tag, at)

    cases = [
        (report(url="u", plain="harbor opens"), report(url="u", plain="quite another text"), "unlike titles at one address"),
        (report(url="u"), report("t", url="u", plain="quite another"), "same address"),
        (report(plain="x y"), report("t", plain="x y", at=t2), "same title"),
        (report(plain=""), report("t", plain="", at=t1), "like titles"),  # two empty titles are alike
        (report(plain=""), report("t", plain="", at=None), "too far apart"),
        (report(plain="harbor opens now"), report(plain="harbor opens nows"), "same source, nearly the same title"),
        (report(plain="harbor opens now"), report(plain="bridge shut"), "same source"),
        (report(plain="harbor opens now"), report("t", plain="harbor opens nows", at=t2), "too far apart"),
        (report(plain="abcdefghij", host="h"), report("t", plain="abcdefghxy", host="h"), "like titles on one host"),
        (report(plain="aaaa", words="abcd", names=["Foo", "Bar"], tag="w"), report("t", plain="zzzz", words="abxy", names=["foo", "BAR"], tag="w"), "names, words and section"),
        (report(plain="abcdef", words="abcd", tag="w"), report("t", plain="abcxyf", words="abcd", tag="w"), "many words and section"),
        (report(plain="abcdef"), report("t", plain="zzzz"), "too little in common"),
    ]
    kind = "struct<source:string,url:string,host:string,plain:string,words:array<string>,names:array<string>,tag:string,at:timestamp>"
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)], f"i int, l {kind}, r {kind}")
    got = {r["i"]: r["reason"] for r in stories.merges(df).collect()}
    assert got == {i: c[2] for i, c in enumerate(cases)}


def test_sweep_compares_as_all_pairs(spark):
    """Measures of the sweep against all pairs, over cells, long reports, missing groups and sources; pairs carry no features."""
    random.seed(11)
    hour = 3_600_000_000
    words = [f"w{i}" for i in range(40)]
    f = []
    for i in range(400):
        t0 = random.randrange(-300, 900) * hour
        own = random.sample(words, random.randint(0, 9))
        f.append((i, random.choice(["x", None]), t0, t0 + random.choice([0, 0, 5, 400]) * hour, random.choice(["s", "t", None]), random.choice(["m", None]), random.choice(["k1", "k2", f"own{i}"]), own, own[:2], [w for w in own if w < "w3"], random.sample(["b", "c"], 1), i % 7 == 0))
    names = ["node", "g", "t0", "t1", "source", "source_group", "key", "words", "names", "anchors", "actions", "roundup"]
    df = spark.createDataFrame(f, "node long, g string, t0 long, t1 long, source string, source_group string, key string, words array<string>, names array<string>, anchors array<string>, actions array<string>, roundup boolean")
    r = stories.StoryRules(broad=["w1", "w2"], shared=["w4", "w9"])
    rows = [dict(zip(names, x)) for x in f]
    last, before = {}, {}
    for x in sorted(rows, key=lambda x: (x["t0"], x["node"])):
        p = last.get((x["g"], x["key"]))
        if p and x["t0"] - p["t1"] <= 36 * hour:
            before[x["node"]] = p["node"]
        last[x["g"], x["key"]] = x
    want = {}
    for x in rows:
        for y in rows:
            gap = max(0, y["t0"] - x["t1"], x["t0"] - y["t1"]) / hour
            if x["node"] < y["node"] and x["g"] == y["g"] and gap <= 36:
                both = lambda c: set(x[c]) & set(y[c])  # noqa: B023, E731
                w, union = len(both("words")), len({*x["words"], *y["words"]})
                sim, firm = w / union if union else 0.0, len(both("anchors") - {"w1", "w2"})
                follows = before.get(x["node"]) == y["node"] or before.get(y["node"]) == x["node"]
                if w and sim >= 0.2 - 1e-9 or firm >= 2 or follows:
                    want[x["node"], y["node"]] = (
                        sim, w, len(both("names")), len(both("anchors")), firm, gap, len(both("actions")), bool(x["anchors"] and y["anchors"]), bool(both("words") & {"w4", "w9"}), x["roundup"] or y["roundup"],
                        x["key"] == y["key"], x["source"] is not None and x["source"] == y["source"], x["source_group"] == y["source_group"], follows,
                    )
    assert {tuple(x)[:2]: tuple(x)[2:] for x in stories.compared(df, r).collect()} == want and len(want) > 500
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        assert {tuple(x)[:2]: tuple(x)[2:] for x in stories.compared(df, r).collect()} == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "Join" not in stories.compared(df, r)._jdf.queryExecution().executedPlan().toString()


def test_reports_are_hashed_before_any_shuffle(spark):
    """Words and names go through the window and to the cells as hashes, so no shuffle of the sweep carries strings."""
    x = spark.createDataFrame([(1, "g", 0, 0, "s", "grp", "Kelfen reopened the ferry", "")], "node bigint, g string, t0 bigint, t1 bigint, source string, source_group string, title string, summary string")
    rules = stories.StoryRules()
    plan = stories.compared(stories.features(x, "title", "summary", rules).drop("title", "summary"), rules)._jdf.queryExecution().optimizedPlan().toString()
    window = next(line for line in plan.split("\n") if " Window [" in line or line.startswith("Window ["))
    assert "gh#" in window and " g#" not in window


def test_features_are_shuffled_only_to_their_nodes_and_cells(spark, tmp_path, monkeypatch):
    """Reports know the one before them by hashes alone: titles' words are not written for the nodes, no window carries features, and pairs are those of the window over all of them."""
    title = lambda i: ["Zorvik Works opened the ferry", "Zorvik Works opened a ferry!", "The ferry opened Zorvik works"][i % 3]
    rows = [(i, title(i) if i % 5 else None, f"Kelfen and Bordak sued {i % 4}", "s" if i % 2 else "t", "x" if i % 7 else None, 1_700_000_000 + 11 * 3600 * (i * i % 31)) for i in range(60)]
    rows += [(100 + i, "Harbor Trust opened a bridge", "", "s", "y", 1_700_000_000 + 30 * 3600 * i) for i in range(9)]  # one long report
    rows += [(200 + i, f"Harbor Trust opened {w} bridge", "", "s", "y", 1_700_000_000 + 50 * 3600 * (i + 1)) for i, w in enumerate(["the", "an", "on the"])]
    items = spark.createDataFrame(rows, "ingest_seq bigint, title string, summary string, source_id string, section string, at bigint").withColumn("fetched_at", F.timestamp_seconds("at").cast("timestamp_ntz"))
    items.write.parquet(str(tmp_path / "raw_items.parquet"))
    spark.createDataFrame([("s", "media")], "id string, source_group string").write.parquet(str(tmp_path / "source_catalog.parquet"))
    plans, pin = [], events.pin_table
    monkeypatch.setattr(events, "pin_table", lambda df: (plans.append((df.columns, df._jdf.queryExecution().optimizedPlan().toString())), pin(df))[1])
    f, _, _ = event_queries._stories(spark, str(tmp_path))
    assert plans and all("w" not in columns for columns, _ in plans)
    assert "Window" not in stories.compared(f, event_queries.STORIES)._jdf.queryExecution().optimizedPlan().toString()
    got = sorted(map(tuple, stories.compared(f, event_queries.STORIES).collect()))
    assert got == sorted(map(tuple, stories.compared(f.drop("before"), event_queries.STORIES).collect())) and any(x[-1] for x in got)


def test_a_report_follows_the_last_one_even_out_of_reach(spark):
    """The one before in time decides: where it is out of reach, an earlier one that lasts longer is not followed."""
    hour = 3_600_000_000
    rows = [(1, 7, 7, 0, 100 * hour), (2, 7, 7, 10 * hour, 10 * hour), (3, 7, 7, 90 * hour, 90 * hour), (4, 7, 8, 91 * hour, 91 * hour), (5, 7, 7, 92 * hour, 92 * hour)]
    df = spark.createDataFrame(rows, "node bigint, gh bigint, key bigint, t0 bigint, t1 bigint")
    assert {r["node"]: r["before"] for r in stories.followed(df, 36).collect()} == {1: -(2**63), 2: 1, 3: -(2**63), 4: -(2**63), 5: 3}

import random

from pyspark.sql import functions as F

from newsloom.functions import text, times
from newsloom.operators import events
from newsloom.operators import relational as rel
from newsloom.operators.graph import connected_components


def test_components_match_union_find(spark):
    random.seed(1)
    edges = [(random.randint(0, 300), random.randint(0, 300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 5001 + i) for i in range(60)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()}
    assert got == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "src bigint, dst bigint")).count() == 0


def test_first_fit_matches_sequential(spark):
    random.seed(2)
    n = 120
    edges = sorted({tuple(sorted(random.sample(range(n), 2))) for _ in range(150)})
    order = list(range(n))
    random.shuffle(order)
    place = {x: i for i, x in enumerate(order)}
    near = {x: set() for x in range(n)}
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    buckets, where = [], {}
    for x in order:
        hit = next((i for i, m in enumerate(buckets) if m & near[x]), None)
        if hit is None:
            buckets.append({x})
            where[x] = x
        else:
            buckets[hit].add(x)
            where[x] = next(y for y in order if y in buckets[hit])
    items = spark.createDataFrame([(x, place[x]) for x in range(n)], "id bigint, p int")
    got = {r["id"]: r["bucket"] for r in events.first_fit(items, spark.createDataFrame(edges, "a bigint, b bigint"), "id", [F.col("p")]).collect()}
    assert got == where


def test_similar_titles_match_brute_force(spark):
    random.seed(3)
    words = [f"w{i}" for i in range(12)]
    rows = [(i, " ".join(random.sample(words, random.randint(2, 5))), random.choice(["x", "y", None]), 2000.0 * random.randint(0, 400)) for i in range(300)] + [(900, "", "x", 0.0), (901, None, "x", 0.0), (902, "w1 w2", "x", None)]
    rows += [(1000 + i, "hot title here", "x", 10.0 * i) for i in range(400)]
    df = spark.createDataFrame(rows, "id bigint, title string, g string, s double").withColumn("at", F.timestamp_seconds("s"))
    nodes, members = events.title_nodes(df, "id", "title", "g", "at", 20)
    classes = {}
    for i, t, g, s in rows:
        if t and s is not None:
            classes.setdefault((g, frozenset(t.split())), []).append((s, i))
    want, node = {}, {}
    for (g, w), m in classes.items():
        last = first = None
        for s, i in sorted(m):
            if last is None or s - last > 20 * 3600:
                first = i
                want[first] = (g, w, s, s)
            node[i] = first
            want[first] = (*want[first][:3], s)
            last = s
    assert {r["id"]: r["node"] for r in members.collect()} == node
    got = {(r["a"], r["b"]) for r in events.similar_nodes(nodes, 0.5, 20).collect()}
    pairs = set()
    for i, (g, a, s0, s1) in want.items():
        for j, (h, b, v0, v1) in want.items():
            if i < j and g == h and a != b and len(a & b) >= 0.5 * len(a | b) and v0 - s1 <= 72000 and s0 - v1 <= 72000:
                pairs.add((i, j))
    assert got == pairs


def test_words_of_titles_stay_out_of_sums_and_order(spark, monkeypatch):
    """Only a hash goes through the sums; an id that came twice keeps a node for each of its titles, as in SQL."""
    plans, pin = [], events.pin_table
    monkeypatch.setattr(events, "pin_table", lambda df: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), pin(df))[1])
    rows = [(1, "alpha beta", "x", 0.0), (1, "beta alpha", "x", 0.0), (1, "gamma delta", "x", 0.0), (2, "beta, alpha", "x", 60.0), (3, "alpha beta", None, 0.0), (4, "alpha beta", "x", 1e6)]
    df = spark.createDataFrame(rows, "id bigint, title string, g string, s double").withColumn("at", F.timestamp_seconds("s"))
    nodes, members = events.title_nodes(df, "id", "title", "g", "at", 20)
    got = sorted((r["node"], r["g"] or "", tuple(r["w"]), r["t0"], r["t1"]) for r in nodes.collect())
    ab = ("alpha", "beta")
    assert got == [(1, "x", ab, 0, 60_000_000), (1, "x", ("delta", "gamma"), 0, 0), (3, "", ab, 0, 0), (4, "x", ab, 10**12, 10**12)]
    assert sorted((r["id"], r["node"]) for r in members.collect()) == [(1, 1), (1, 1), (1, 1), (2, 1), (3, 3), (4, 4)]
    assert " w#" not in plans[1]


def test_first_and_last_wins(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 3), (3, None, 1), (4, None, 2), (5, "b", 1)], "id int, k string, o int")
    assert {r["id"] for r in rel.first_wins(df, [F.col("k")], [F.col("o")]).collect()} == {2, 3, 5}
    assert {r["id"] for r in rel.last_wins(df, [F.col("k")], [F.col("o")]).collect()} == {1, 4, 5}
    assert rel.first_wins(df.limit(0), [F.col("k")], [F.col("o")]).count() == 0


def test_text_functions(spark):
    one = spark.range(1)
    pick = lambda c: one.select(c.alias("x")).first()["x"]
    s = lambda v: F.lit(v).cast("string")
    assert pick(text.squeeze(s(" a 　 b\t"))) == "a b"
    assert pick(text.squeeze(s(None))) is None
    assert pick(text.title_key(s("Hello, World! 世界"))) == "hello world 世界"
    assert pick(text.page_address(s("https://a.b/c/?x=1#y"))) == "https://a.b/c"
    assert pick(text.page_identity(s("HTTPS://A.B/C/"))) == "https://a.b/C"
    assert pick(text.host(s("https://user@www.Ex.com:80/p"))) == "ex.com"
    assert pick(text.host(s(None))) == ""
    assert pick(text.has_keyword(s("said so"), "ai")) is False
    assert pick(text.has_keyword(s("AI芯片"), "ai")) is True
    assert pick(text.has_phrase(s("ai芯片"), "ai")) is False
    assert pick(text.jaccard(F.array(s("a"), s("b")), F.array(s("b"), s("c")))) == 1 / 3
    assert pick(text.overlap(F.array(s("a"), s("b")), F.array(s("b")))) == 1.0
    assert pick(text.contained_or_overlap(s("Big Storm"), s("The big storm hits"))) == 1.0
    assert pick(text.sequence_ratio(s(""), s(""))) == 1.0
    assert pick(text.clean_markup(s("<b>a</b> &amp; b"))) == "a & b"
    assert pick(text.paragraphs(s("a\na\n\nb"))) == ["a", "b"]
    assert pick(text.plain_title(s("3. Big: news - Daily Paper"))) == "big news"
    assert pick(text.slug(F.array().cast("array<string>"))) == "misc-event"
    assert pick(text.steps(F.lit(7), [(6, 4.0), (24, 2.0)], -8.0)) == 2.0
    assert str(pick(times.address_date(s("https://x/2025/01/31/a")))) == "2025-01-31"
    assert str(pick(times.address_date(s("https://x/01/31/2025/a")))) == "2025-01-31"
    assert pick(times.address_date(s("https://x/a"))) is None
    assert pick(times.hours_before(F.lit(None).cast("timestamp"), F.current_timestamp())) == 999
    assert pick(F.unix_timestamp(times.rfc822_instant(s("Wed, 15 Jan 2025 06:00:00 +0100")))) == 1736917200


def test_quota_and_caps(spark):
    rows = [(i, "s1" if i % 2 else "s2", "r" if i % 3 else "q", f"u{i // 2}") for i in range(40)]
    df = spark.createDataFrame(rows, "id int, s string, r string, u string")
    out = rel.quota_fill(df, F.col("s"), F.col("r"), [F.col("id")], 3, {"s2": 4}, F.col("u")).collect()
    assert len(out) == 4 and {r["s"] for r in out} == {"s2"}
    top = rel.capped_then_ranked(df, [F.col("s")], [F.col("id")], 2, 3).collect()
    assert [(r["id"], r["place"]) for r in sorted(top, key=lambda r: r["place"])] == [(0, 1), (1, 2), (2, 3)]


def test_sessions(spark):
    random.seed(8)
    rows = [(random.choice(["a", "b", None]), random.randint(0, 20000)) for _ in range(400)]
    df = spark.createDataFrame(rows, "u string, s int").withColumn("at", F.timestamp_seconds("s"))
    want, last = [], {}
    for u, s in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        n, t = last.get(u, (0, None))
        n += t is None or s - t > 100
        last[u] = (n, s)
        want.append((str(u), s, n))
    got = sorted((str(r["u"]), r["s"], r["session"]) for r in rel.sessions(df, "u", "at", 100).collect())
    assert got == sorted(want)
    assert rel.sessions(df.limit(0), "u", "at", 100).count() == 0


def test_as_of_join_matches_brute_force(spark):
    import datetime as dt
    import random

    from pyspark.sql import functions as F

    random.seed(1)
    at = lambda h: dt.datetime(2025, 1, 1) + dt.timedelta(hours=h)
    left = [(i, random.choice(["a", "b", None, "z"]), at(random.randrange(400)) if i else None) for i in range(60)]
    right = [(random.choice(["a", "b", None]), at(random.randrange(400)), i) for i in range(40)] + [("a", None, 99)]
    x = spark.createDataFrame(left, "id int, k string, t timestamp")
    y = spark.createDataFrame(right, "k string, rt timestamp, v int")
    got = {r["id"]: r["match"] and r["match"]["v"] for r in rel.as_of(x, y, ["k"], "t", "rt").collect()}
    want = {}
    for i, k, t in left:
        fits = [(rt, v) for kk, rt, v in right if kk == k and rt is not None and t is not None and rt <= t]
        want[i] = max(fits)[1] if fits else None
    assert got == want
    assert rel.as_of(x.limit(0), y, ["k"], "t", "rt").count() == 0 and rel.as_of(x, y.limit(0), ["k"], "t", "rt").filter(F.col("match").isNotNull()).count() == 0


def test_titles_that_share_a_word_are_no_candidates(spark):
    """Of 3,000 titles with a word in common and 4 like ones only the 2 that are near in time and group are compared by their words, though every word is posted."""
    rows = [(i, "x", 3_600_000_000 * (i // 20), ["shared", *(f"w{i}x{j}" for j in range(2))]) for i in range(3000)]
    rows += [(5000, "x", 0, ["p", "q", "shared", "v"]), (5001, "x", 0, ["p", "q", "shared", "u"]), (5002, None, 0, ["p", "q", "shared", "u"]), (5003, "x", 10**12, ["p", "q", "shared", "u"])]
    nodes = spark.createDataFrame(rows, "node long, g string, t0 long, w array<string>").selectExpr("node", "xxhash64(g, w) as s", "g", "w", "t0", "t0 as t1")
    post = events.posted_words(nodes.selectExpr("node", "xxhash64(g) as gh", "t0", "t1", "w"), "w", F.col("n"))
    met = events.met_postings(post, 36 * 3_600_000_000, F.ceil((F.col("p.n") + F.col("q.n")) * 0.375))
    assert [tuple(r) for r in met.collect()] == [(5000, 5001)]
    assert [tuple(r) for r in events.similar_nodes(nodes, 0.6, 36).collect()] == [(5000, 5001, 0.6)]


def test_sweep_of_hashed_sets_loses_no_pair(spark):
    """Sets of a hot cell are dealt out, one is longer than its bits, some last for several cells: pairs are those of all pairs, each once."""
    import random

    random.seed(5)
    width, day = 10, 40
    rows = [(i, random.choice([1, 2]), t, t + random.choice([0, 0, 3, 95]), random.sample(range(-9, 9), random.randint(1, 6))) for i in range(400) for t in [random.choice([17, random.randrange(-day, 3 * day)])]]
    rows += [(900, 1, 5, 5, list(range(3000))), (901, 1, 6, 6, list(range(2, 3001)))]
    sets = spark.createDataFrame(rows, "node bigint, gh bigint, t0 bigint, t1 bigint, x array<bigint>").selectExpr("node", "gh", "t0", "t1", "transform(x, v -> xxhash64(v)) as h")
    want = set()
    for i, g, s0, s1, a in rows:
        for j, h, v0, v1, b in rows:
            if i < j and g == h and v0 - s1 <= width and s0 - v1 <= width and len({*a} & {*b}) >= 0.6 * len({*a} | {*b}):
                want.add((i, j))
    for hot in (20_000, 7):
        got = [(r["a"], r["b"]) for r in events.near_sets(sets, 0.6, width, hot).collect()]
        assert len(want) > 100 and set(got) == want and len(got) == len(want)
    assert events.near_sets(sets.limit(0), 0.6, width).count() == 0


def test_like_titles_are_found_without_postings(spark):
    """The words are not joined with each other: no shuffle of the search has the rows of postings."""
    rows = [(i, "x", 3_600_000_000 * i, [f"w{i % 7}", "shared", f"v{i}"]) for i in range(300)]
    nodes = spark.createDataFrame(rows, "node long, g string, t0 long, w array<string>").selectExpr("node", "xxhash64(g, w) as s", "g", "w", "t0", "t0 as t1")
    sets = nodes.selectExpr("node", "xxhash64(g) as gh", "t0", "t1", "transform(w, v -> xxhash64(v)) as h")
    plan = events.near_sets(sets, 0.5, 36 * 3_600_000_000)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "explode(h" not in plan
    got = {(r["a"], r["b"]) for r in events.similar_nodes(nodes, 0.5, 36).collect()}
    assert got == {(i, j) for i in range(300) for j in range(i + 1, min(300, i + 37)) if i % 7 == j % 7}


def test_texts_of_a_ratio_are_met_by_their_pairs_of_characters(spark):
    """No two texts whose matching-blocks ratio reaches the bound are lost, whichever comes first; most others are not met."""
    import difflib

    random.seed(6)
    texts = ["".join(random.choices("abc d渡", k=random.randint(1, 9))) for _ in range(60)] + ["".join(random.choices("abcdefghijklmno ", k=50)) for _ in range(40)]
    for _ in range(60):
        t = list("harbor bridge opens in the north of kelfen today")
        for _ in range(random.randint(0, 8)):
            t[random.randrange(len(t))] = random.choice(["", "x", "yz"])
        texts.append("".join(t))
    df = spark.createDataFrame(list(enumerate(texts)), "node long, t string").select("node", F.lit(1).cast("long").alias("gh"), F.lit(0).cast("long").alias("t0"), F.lit(0).cast("long").alias("t1"), events.gram_bits("t").alias("g"))
    ratio = lambda x, y: difflib.SequenceMatcher(None, x, y).ratio()
    for least in (0.78, 0.9):
        want = {(a, b) for b in range(len(texts)) for a in range(b) if max(ratio(texts[a], texts[b]), ratio(texts[b], texts[a])) >= least}
        got = {tuple(r) for r in events.near_sets(df.select("node", "gh", "t0", "t1", "g.*"), width=5, fold=4, **events.like_texts(least)).collect()}
        assert want <= got and len(want) > 50 and len(got) < 0.5 * len(texts) ** 2 / 2

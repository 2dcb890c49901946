import datetime as dt

from pyspark.sql import functions as F

from newsloom.plans import pipeline, rules

PACK = rules.RulePack(
    buckets={"energy": ["refinery", "ai", "refinery"], "policy": ["senate"]},
    section_boosts=[("s1", "Top News", "policy", 2)],
    source_boosts=[(["s2"], ["senate"], "energy", 5)],
    strong=[("policy", 3, ["treaty", "accord"])],
    context=["startup"],
    routes=[("tech", ["chip"], ["cloud"]), ("tech2", ["robot"], [])],
    priority=[("policy", ["urgent"], 1)],
    tags=[("a", ["x1y"]), ("b", ["refinery"]), ("c", ["senate"])],
    fallback={"s3": "policy"},
    default="other",
)
CASES = [
    ("s9", "", "refinery", "energy", "score"),  # listed twice, counts twice
    ("s9", "", "refinery senate", "energy", "score"),
    ("s1", " top  news ", "refinery senate", "policy", "score"),
    ("s2", "", "senate", "energy", "score"),
    ("s9", "", "treaty accord", "policy", "score"),  # a rule adds its points once
    ("s9", "", "startup chip cloud refinery", "tech", "route"),
    ("s9", "", "chip without its context", "other", "default"),
    ("s9", "", "startup robot chip", "tech", "route"),
    ("s9", "", "urgent refinery senate", "policy", "priority"),
    ("s9", "", "said", "other", "default"),  # 'ai' is a whole word
    ("s3", "", "nothing", "policy", "source"),
    (None, None, None, "other", "default"),
]


def test_classification(spark):
    df = spark.createDataFrame([(i, s, x, t, None, "clash") for i, (s, x, t, _, _) in enumerate(CASES)], "id int, source_id string, section string, title string, summary string, bucket string")
    got = {r["id"]: r for r in rules.classified(df, "id", ["title", "summary"], "source_id", "section", PACK).collect()}
    for i, (_, _, t, want, by) in enumerate(CASES):
        assert (got[i]["bucket"], got[i]["decided_by"]) == (want, by), t
    assert got[1]["tags"] == ["b", "c"] and got[0]["score_energy"] == 2
    assert rules.classified(df.limit(0), "id", ["title"], "source_id", "section", PACK).count() == 0


def test_expressions(spark):
    one = spark.range(1)
    pick = lambda c: one.select(c.alias("x")).first()["x"]
    assert [(x["tag"], x["score"]) for x in pick(rules.soft_tags(F.lit("a tunnel and a senate, a harbor"), {"s": ["senate"], "w": ["tunnel", "harbor"], "n": ["zzz"]}))] == [("w", 0.71), ("s", 0.53)]
    assert pick(rules.soft_capped(F.lit(90.0), 88, 0.5)) == 89 and pick(rules.soft_capped(F.lit(2.5), 88, 0.5)) == 2 and pick(rules.soft_capped(F.lit(-3.0), 88, 0.5)) == 0
    assert pick(rules.flags({"a": F.lit(True), "b": F.lit(False), "c": F.lit(None).cast("boolean")})) == ["a"]
    assert pick(rules.entities(F.lit("Big Oil Company met 华兴银行 and Big Oil Company"))) == ["Big Oil Company", "华兴银行"]


def test_pipeline(spark):
    t = dt.datetime(2025, 1, 1)
    rows = [
        (1, "a", "Refinery fire closes the northern harbor today", "u1", t, 3, "ok"),
        (2, "b", "Refinery fire closes the northern harbor", "u2", t + dt.timedelta(hours=2), 1, "ok"),
        (3, "c", "Refinery fire closes the northern harbor", "u3", t + dt.timedelta(hours=90), 0, "ok"),
        (4, "a", "Senate votes", "u4", t, None, "ok"),
        (5, "a", " senate  VOTES ", "u4", t, None, "ok"),
        (6, "a", "", "u5", t, None, "ok"),
        (7, "a", "Refinery closes", "u6", t, None, "bad"),
    ]
    df = spark.createDataFrame(rows, "ingest_seq bigint, source_id string, title string, canonical_url string, fetched_at timestamp_ntz, rank_position int, fulltext_status string")
    df = df.withColumns({"source_url": F.lit(""), "summary": F.lit(None).cast("string"), "section": F.lit("")})
    out = pipeline.item_events(df, PACK, {"bad": F.col("fulltext_status") == "bad"})
    assert {r["ingest_seq"] for r in out.rejected.collect()} == {6, 7}
    ranking = [(r["main_id"], r["n_items"], r["bucket"], r["place"]) for r in out.ranking.orderBy("place").collect()]
    assert ranking == [(2, 2, "energy", 1), (3, 1, "energy", 2), (4, 1, "policy", 3)]
    assert pipeline.item_events(df.limit(0), PACK, {}).ranking.count() == 0


def test_plan_reads_its_items_once(spark):
    """Deduplicated and classified items are written, so no later step repeats either."""
    rows = [(i, f"s{i % 2}", f"title number {i // 2}", "", "", "", "", "", 1) for i in range(6)]
    schema = "ingest_seq bigint, source_id string, title string, summary string, section string, canonical_url string, source_url string, fulltext_status string, rank_position int"
    df = spark.createDataFrame(rows, schema).withColumn("fetched_at", F.timestamp_seconds(F.col("ingest_seq") * 60))
    plan = pipeline.item_events(df, PACK, {}).candidates._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan

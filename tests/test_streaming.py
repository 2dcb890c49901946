from pyspark.sql import functions as F

from newsloom.runtime import ensure_checkpoint_dir
from newsloom.streaming import items as stream


def _table(spark, tmp_path):
    rows = [(i % 40, f"s{i % 3}", 60 * i) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, source string, s int").withColumn("at", F.timestamp_seconds("s"))
    path = str(tmp_path / "t")
    df.repartition(3).write.parquet(path)
    return df, path


def test_deduplication_and_windows(spark, tmp_path):
    df, path = _table(spark, tmp_path)
    got = stream.run_to_end(stream.deduplicated(stream.read_stream(spark, path), ["id"], "at", "1 day").select("id"), "d")
    assert got.count() == got.distinct().count() == 40
    w = stream.run_to_end(stream.windowed_counts(stream.read_stream(spark, path), "at", ["source"], "10 minutes", None, "1 minute"), "w")
    assert w.agg(F.sum("n")).first()[0] == 110 and w.count() == 33  # the last window stays open
    s = stream.run_to_end(stream.session_counts(stream.read_stream(spark, path).filter("s < 1800 or s > 5400"), "at", ["source"], "5 minutes", "1 minute"), "s")
    assert {(r["source"], r["n"]) for r in s.collect()} == {("s0", 10), ("s1", 10), ("s2", 10)}


def test_running_totals(spark, tmp_path):
    _, path = _table(spark, tmp_path)
    spark.conf.set(*stream.ROCKSDB)
    q = stream.source_totals(stream.read_stream(spark, path, 1), "source").writeStream.outputMode("update").format("memory").queryName("totals").option("checkpointLocation", f"{ensure_checkpoint_dir(spark)}/totals-{tmp_path.name}").trigger(availableNow=True).start()
    q.awaitTermination()
    spark.conf.unset(stream.ROCKSDB[0])
    last = spark.table("totals").groupBy("source").agg(F.max("n").alias("n")).collect()
    assert {(r["source"], r["n"]) for r in last} == {("s0", 40), ("s1", 40), ("s2", 40)}

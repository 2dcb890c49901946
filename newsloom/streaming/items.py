"""Item streams: deduplication within a watermark, windowed counts and per-source state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from newsloom.runtime import ensure_checkpoint_dir


def read_stream(spark: SparkSession, path: str, files_per_trigger: int = 16) -> DataFrame:
    """A table's files as they arrive; the schema is taken from those already there."""
    schema = spark.read.parquet(path).schema
    folder, glob = (path, "*.parquet") if spark.read.parquet(path).inputFiles()[0].rstrip("/").rpartition("/")[0].endswith(path.rstrip("/").rpartition("/")[2]) else (path.rpartition("/")[0], path.rpartition("/")[2])
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def deduplicated(stream: DataFrame, keys: list[str], at: str, delay: str) -> DataFrame:
    """One row per key as long as the watermark remembers it."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, at: str, by: list[str], width: str, slide: str | None, delay: str) -> DataFrame:
    """Counts per window and key, given out once the watermark has passed the window."""
    w = F.window(at, width, slide) if slide else F.window(at, width)
    return stream.withWatermark(at, delay).groupBy(w.alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n")


def session_counts(stream: DataFrame, at: str, by: list[str], gap: str, delay: str) -> DataFrame:
    w = F.session_window(at, gap)
    return stream.withWatermark(at, delay).groupBy(w.alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n")


class _Totals(StatefulProcessor):
    """Rows and batches of one source, in a value state."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "n bigint, batches int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, batches = self.total.get() if self.total.exists() else (0, 0)
        n, batches = n + sum(len(f) for f in rows), batches + 1
        self.total.update((n, batches))
        yield pd.DataFrame({"source": [key[0]], "n": [n], "batches": [batches]})

    def close(self) -> None:
        pass


def source_totals(stream: DataFrame, source: str) -> DataFrame:
    """(source, n, batches): running totals per source, kept as arbitrary state in RocksDB, which a session that runs it must name as its state store."""
    own = stream.select(F.col(source).alias("source"))
    return own.groupBy("source").transformWithStateInPandas(_Totals(), "source string, n bigint, batches int", "Update", "None")


ROCKSDB = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def run_to_end(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Process all there is into a table of the checkpoint folder and return it; appends only."""
    spark = stream.sparkSession
    import uuid

    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{name}-{uuid.uuid4().hex}"
    q = stream.writeStream.outputMode(mode).format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")

"""A mixture of sources by token shares: whole copies first, then Pareto order sampling of the rest."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.runtime import pin_table

TOKENIZER = os.environ.get("NEWSLOOM_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
# Fixed value: the split pattern that belongs to the byte-level rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_tokens(docs: DataFrame, text_col: str, keep: list[str], tokenizer: str = TOKENIZER) -> DataFrame:
    """`keep` columns and `tokens`, the length of the whole text in tokens; null counts 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(tokenizer).encode_ordinary
        for batch in batches:
            n = [len(encode(t)) if t else 0 for t in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(n, pa.int64())], names=[*keep, "tokens"])

    own = docs.select(*keep, F.col(text_col).alias("_text"))
    return own.mapInArrow(run, T.StructType([*own.schema.fields[: len(keep)], T.StructField("tokens", T.LongType())]))


def _expected_tokens(scale: float, cap: int, rows: list) -> float:
    return sum(min(cap, scale * r["weight"]) * r["tokens"] for r in rows)


def _scale(goal: float, cap: int, rows: list) -> float:
    """The factor at which the expected copies min(cap, factor * weight) add up to the goal, by bisection."""
    lo, hi = 0.0, cap / min(r["weight"] for r in rows)
    if goal >= _expected_tokens(hi, cap, rows):
        return hi
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _expected_tokens(mid, cap, rows) < goal else (lo, mid)
    return hi


def plan(spark: SparkSession, sized: DataFrame, targets: DataFrame, bins_per_doubling: int, length_power: float, total_tokens: int | None) -> DataFrame:
    """One row per target source: its goal in tokens and the factor of expected copies.

    The statistics cover every document: per source and length bin the number of documents and their
    tokens, at most targets x bins rows, which is what reaches the driver. Without `total_tokens` the
    total is the greatest at which every source that has documents can meet its share under its cap,
    the shares of sources without documents being left unfilled in proportion.
    """
    bin_ = F.floor(F.log2(F.col("tokens")) * bins_per_doubling).cast("int")
    stats = sized.filter("tokens > 0").groupBy("source", bin_.alias("bin")).agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens")).collect()
    by: dict[str, list] = {}
    for r in stats:
        mean = r["tokens"] / r["n"]
        by.setdefault(r["source"], []).append({"weight": (2.0 ** ((r["bin"] + 0.5) / bins_per_doubling)) ** length_power, "tokens": r["tokens"], "mean": mean})
    wanted = [r for r in targets.select("source", F.col("target_share").cast("double").alias("share"), F.col("max_repeats").cast("int").alias("cap")).distinct().collect() if r["source"] is not None and (r["share"] or 0) > 0 and (r["cap"] or 0) > 0]
    live = [r for r in wanted if r["source"] in by]
    if total_tokens is None:
        total_tokens = min((sum(x["tokens"] for x in by[r["source"]]) * r["cap"] / r["share"] for r in live), default=0)
    rows = [(r["source"], float(r["share"]), int(r["cap"]), float(r["share"] * total_tokens), _scale(r["share"] * total_tokens, r["cap"], by[r["source"]]) if r in live else 0.0) for r in wanted]
    return spark.createDataFrame(rows, "source string, target_share double, max_repeats int, goal double, scale double")


def mixture(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", tokenizer: str = TOKENIZER, total_tokens: int | None = None, length_power: float = 0.25, seed: int = 17, bins: int = 4096, bins_per_doubling: int = 8) -> tuple[DataFrame, DataFrame]:
    """(mixture, plan): (id, source, tokens, copies) of every document used, copies <= max_repeats.

    Each document of a source gets expected copies proportional to its length to the power
    `length_power` (0: alike), up to the cap, adding up to the source's goal. The whole part is given
    with certainty; of the fractions a fixed number of documents is drawn by Pareto order sampling: rank
    by random odds u/(1-u) over inclusion odds p/(1-p), least first. u is a hash of the id and `seed`, so
    a lost task draws the same again. The cut is found from a histogram of the ranks; only the documents
    of the one bin that holds it are sorted, so no source is gathered into one task.

    Documents without text, of other sources or with a null id or source take no part; a repeated id is one
    document (its longest text). Targets with no documents, a null or zero share or cap give nothing.
    """
    spark = docs.sparkSession
    # targets are a fixed table (one row per source); Spark's own size check picks the join
    own = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("text")).filter("id is not null and source is not null")
    own = own.join(targets.select("source").distinct(), "source", "left_semi")
    sized = pin_table(with_tokens(own, "text", ["id", "source"], tokenizer).groupBy("id", "source").agg(F.max("tokens").alias("tokens")))
    goals = plan(spark, sized, targets, bins_per_doubling, length_power, total_tokens)
    weight = F.pow(F.pow(F.lit(2.0), (F.floor(F.log2(F.col("tokens")) * bins_per_doubling) + 0.5) / bins_per_doubling), F.lit(length_power))
    drawn = sized.filter("tokens > 0").join(F.broadcast(goals), "source")  # goals: one row per target, collected above
    drawn = drawn.withColumn("expected", F.least(F.col("max_repeats").cast("double"), F.col("scale") * weight)).withColumn("sure", F.floor("expected").cast("int"))
    u = (F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    drawn = drawn.withColumn("p", F.col("expected") - F.col("sure")).withColumn("rank", F.when(F.col("p") > 0, u * (1 - F.col("p")) / ((1 - u) * F.col("p"))))
    drawn = drawn.withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * bins).cast("int"))
    counts = drawn.groupBy("source", "bin").agg(F.count("*").alias("n"), F.sum("p").alias("p"))
    size = counts.groupBy("source").agg(F.round(F.sum("p")).cast("long").alias("take"))
    below = counts.filter("bin is not null").withColumn("upto", F.sum("n").over(W.partitionBy("source").orderBy("bin"))).join(size, "source")  # at most `bins` rows a source
    cut = below.filter("upto - n < take").groupBy("source").agg(F.max("bin").alias("cut_bin"), F.max_by(F.col("take") - F.col("upto") + F.col("n"), "bin").alias("left"))
    marked = drawn.join(F.broadcast(cut), "source", "left")
    inside = marked.filter("bin = cut_bin").withColumn("place", F.row_number().over(W.partitionBy("source").orderBy("rank", "id"))).filter("place <= left").select("id", F.lit(1).alias("extra"))
    extra = F.when(F.col("bin") < F.col("cut_bin"), 1).otherwise(F.coalesce("extra", F.lit(0)))
    out = marked.join(inside, "id", "left").withColumn("copies", (F.col("sure") + extra).cast("int")).filter("copies > 0")
    return out.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "tokens", "copies"), goals


def shares(mixed: DataFrame, goals: DataFrame, source_col: str = "source") -> DataFrame:
    """Target and actual share of every target source, with documents, copies and the most any was repeated."""
    got = mixed.groupBy(F.col(source_col).alias("source")).agg(
        F.count("*").alias("n_documents"), F.sum("copies").alias("n_copies"), F.max("copies").alias("most_repeats"), F.sum(F.col("tokens") * F.col("copies")).alias("tokens")
    )
    all_ = goals.select("source", "target_share", "max_repeats", "goal").join(got, "source", "left").na.fill(0, ["n_documents", "n_copies", "most_repeats", "tokens"])
    total = F.sum("tokens").over(W.partitionBy())  # one row per target source
    return all_.select("source", "target_share", "max_repeats", "n_documents", "n_copies", "most_repeats", "tokens", F.round("goal").cast("long").alias("goal_tokens"), F.when(total > 0, F.col("tokens") / total).otherwise(0.0).alias("actual_share"))


def kept_promises(docs: DataFrame, mixed: DataFrame, goals: DataFrame, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """(source, within_cap, within_goal, known, once) of every target source that has documents: what a mixture must keep to.

    within_cap: no document is used more often than allowed. within_goal: the tokens miss the goal by no
    more than fixed-size sampling must: the draw's own deviation, four of its standard deviations, and one
    document for the rounding of their number. known: all its documents are documents of that source.
    once: each stands in the mixture once.
    """
    have = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(source_col).alias("source")).distinct()
    used = mixed.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), "tokens", "copies")
    real = used.join(have.withColumn("real", F.lit(1)), ["id", "source"], "left")
    got = real.groupBy("source").agg(
        F.max("copies").alias("most"), F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.max("tokens").alias("longest"),
        F.sqrt(F.sum(F.col("tokens").cast("double") * F.col("tokens")) / 4).alias("deviation"), F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.count("real").alias("known"),
    )
    all_ = goals.join(have.select("source").distinct(), "source", "left_semi").join(got, "source", "left")
    gap = F.abs(F.coalesce("tokens", F.lit(0)) - F.col("goal"))
    return all_.select(
        "source", (F.coalesce("most", F.lit(0)) <= F.col("max_repeats")).alias("within_cap"), (gap <= 4 * F.coalesce("deviation", F.lit(0.0)) + F.coalesce("longest", F.lit(0))).alias("within_goal"),
        (F.coalesce("known", F.lit(0)) == F.coalesce("n", F.lit(0))).alias("known"), (F.coalesce("ids", F.lit(0)) == F.coalesce("n", F.lit(0))).alias("once"),
    )

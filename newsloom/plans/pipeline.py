"""From ingested items to ranked events: one declarative plan over rule packs a user brings along."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import text
from newsloom.operators import events
from newsloom.operators import relational as rel
from newsloom.plans import rules
from newsloom.runtime import pin_table


@dataclass(frozen=True)
class Settings:
    similarity: float = 0.6
    hours: float = 36
    per_section: int = 15
    total: int = 100


@dataclass(frozen=True)
class Result:
    kept: DataFrame
    rejected: DataFrame
    candidates: DataFrame
    edges: DataFrame
    events: DataFrame
    ranking: DataFrame


def sifted(items: DataFrame, drop: dict[str, Column], keep: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected with `reasons`): rows no drop rule holds for, or that the keep rule saves."""
    marked = items.withColumn("reasons", rules.flags({k: F.coalesce(v, F.lit(False)) for k, v in drop.items()}))
    saved = F.coalesce(keep, F.lit(False)) if keep is not None else F.lit(False)
    out = (F.size("reasons") > 0) & ~saved
    return marked.filter(~out).drop("reasons"), marked.filter(out)


def item_events(items: DataFrame, pack: rules.RulePack, drop: dict[str, Column], settings: Settings = Settings()) -> Result:
    """Deduplicate, sift, classify, group similar reports first-fit inside a bucket and rank the events.

    Reports with the same title words that follow one another are one node; nodes are grouped.
    items has the ingested columns with ingest_seq and fetched_at. An event's main item is its best
    ranked, then earliest; events order by sources, items and main item. What is kept and the candidates are
    written, since several steps read them.
    """
    once = rel.first_wins(items, [F.lower(text.squeeze(text.missing_as_empty(F.col("title")))), text.first_non_empty(F.col("canonical_url"), F.col("source_url"))], [F.col("ingest_seq")])
    kept, rejected = sifted(once, {"no title": text.missing_as_empty(F.col("title")) == "", **drop})
    own = pin_table(kept.select("ingest_seq", "source_id", "title", "summary", "section", "fetched_at", "rank_position"))
    named = rules.classified(own, "ingest_seq", ["title", "summary", "section"], "source_id", "section", pack)
    candidates = pin_table(own.join(named, "ingest_seq").select("ingest_seq", "source_id", "title", "fetched_at", "rank_position", "bucket", "decided_by", "tags"))
    nodes, members = events.title_nodes(candidates, "ingest_seq", "title", "bucket", "fetched_at", settings.hours)
    edges = events.similar_nodes(nodes, settings.similarity, settings.hours)
    joined = events.first_fit(nodes, edges, "node", [F.col("t0")])
    placed = members.join(joined, "node").select(F.col("id").alias("ingest_seq"), F.col("bucket").alias("group_id"))
    buckets = candidates.select("ingest_seq").join(placed, "ingest_seq", "left").select("ingest_seq", F.coalesce("group_id", "ingest_seq").alias("group_id"))
    rank = F.when(F.col("rank_position") > 0, F.col("rank_position")).otherwise(9999)
    found = events.group_summary(candidates, buckets, "ingest_seq", "source_id", "fetched_at", [rank.alias("r"), F.col("fetched_at")])
    found = found.join(candidates.select(F.col("ingest_seq").alias("main_id"), "title", "bucket"), "main_id")
    order = [F.desc("n_sources"), F.desc("n_items"), F.asc("main_id")]
    ranking = rel.capped_then_ranked(found, [F.col("bucket")], order, settings.per_section, settings.total)
    return Result(kept, rejected, candidates, edges, found, ranking)

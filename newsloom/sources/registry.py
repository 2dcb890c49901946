"""Sources declared as data: what protocol each speaks and how its payloads become items."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import text
from newsloom.sources import feeds, landing, pages


@dataclass(frozen=True)
class Source:
    """One source. `options` depends on the protocol: json needs list_path and fields, sitemap may have a marker, links may have a pattern and at_most."""

    id: str
    protocol: str
    location: str
    ranked: bool = False
    section: str = ""
    options: dict = field(default_factory=dict)
    keep: str = ""
    drop: str = ""


PROTOCOLS = ("rss", "atom", "sitemap", "json", "json_ld", "trends", "links")


def chosen(registry: Sequence[Source], ids: Sequence[str]) -> tuple[list[Source], list[str]]:
    """(sources, unknown ids) in the order asked for, each once."""
    by = {s.id: s for s in registry}
    ids = list(dict.fromkeys(ids))
    return [by[i] for i in ids if i in by], [i for i in ids if i not in by]


def _link_items(payloads: DataFrame, s: Source) -> DataFrame:
    """A listing page's links as ranked items, those whose address matches the pattern."""
    each = payloads.select("source_id", F.posexplode(F.filter(pages.html_links("payload"), lambda x: x["href"].rlike(s.options.get("pattern", "")))).alias("at", "l"))
    each = each.filter(F.col("at") < s.options.get("at_most", 100))
    base = s.options.get("base", "")
    url = F.when(F.col("l.href").rlike("^https?://"), F.col("l.href")).otherwise(F.concat(F.lit(base), F.col("l.href")))
    return feeds.as_items(
        each.select("source_id", F.col("l.label").alias("title"), url.alias("source_url"), text.page_address(url).alias("canonical_url"), F.lit("html_ranked").alias("discovery_method"), (F.col("at") + 1).alias("rank_position"))
    )


def parse(payloads: DataFrame, s: Source) -> DataFrame:
    """Items of one source's payloads; `keep` and `drop` are patterns on the address."""
    own = payloads.filter((F.col("source_id") == s.id) & (F.col("status") == "ok")).withColumn("section", F.lit(s.section))
    if s.protocol == "rss":
        items = feeds.rss_items(own, s.ranked)
    elif s.protocol == "atom":
        items = feeds.atom_items(own)
    elif s.protocol == "json_ld":
        items = feeds.json_ld_items(own)
    elif s.protocol == "trends":
        items = feeds.trend_items(own)
    elif s.protocol == "json":
        items = feeds.json_items(own, s.options["list_path"], s.options["fields"], s.ranked)
    elif s.protocol == "sitemap":
        m = feeds.sitemap_pages(own, s.options.get("marker"))
        items = feeds.as_items(m.select("source_id", F.col("url").alias("source_url"), text.page_address(F.col("url")).alias("canonical_url"), F.coalesce(F.date_format("modified", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"), F.lit("")).alias("published_at"), F.lit("sitemap_listing").alias("discovery_method")))
    elif s.protocol == "links":
        items = _link_items(own, s)
    else:
        raise ValueError(f"unknown protocol {s.protocol!r}; known: {', '.join(PROTOCOLS)}")
    if s.keep:
        items = items.filter(F.col("source_url").rlike(s.keep))
    if s.drop:
        items = items.filter(~F.col("source_url").rlike(s.drop))
    return items


def ingest(spark: SparkSession, registry: Sequence[Source], ids: Sequence[str], timeout: float = 20) -> tuple[DataFrame, DataFrame]:
    """(items of all chosen sources, a summary row per asked source: status, error, items)."""
    found, unknown = chosen(registry, ids)
    missing = spark.createDataFrame([(i, "missing_adapter", f"no source {i}") for i in unknown], "source_id string, status string, error string")
    if not found:
        return feeds.as_items(spark.createDataFrame([], "source_id string")), missing.withColumn("n_items", F.lit(0).cast("bigint"))
    payloads = landing.read_payloads(spark, [{"source_id": s.id, "protocol": s.protocol, "location": s.location} for s in found], timeout)
    items = parse(payloads, found[0])
    for s in found[1:]:
        items = items.unionByName(parse(payloads, s))
    state = payloads.groupBy("source_id").agg(F.max_by("status", F.col("status") != "ok").alias("status"), F.max("error").alias("error")).unionByName(missing)
    n = items.groupBy("source_id").agg(F.count("*").alias("n_items"))
    return items, state.join(n, "source_id", "left").na.fill(0, ["n_items"])

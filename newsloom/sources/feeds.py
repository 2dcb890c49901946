"""Feeds as DataFrames: RSS, Atom, sitemaps and JSON listings parsed from landed payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newsloom.functions import text, times
from newsloom.sources import pages

_RSS_ITEM = "struct<title:string,link:string,guid:string,pubDate:string,description:string,author:string,category:array<string>>"
RSS = f"struct<channel:struct<title:string,link:string,item:array<{_RSS_ITEM}>>>"
ATOM = "struct<title:string,entry:array<struct<title:string,id:string,link:array<struct<_href:string,_rel:string>>,published:string,updated:string,summary:string,author:struct<name:string>>>>"
SITEMAP = "struct<url:array<struct<loc:string,lastmod:string>>>"
SITEMAP_INDEX = "struct<sitemap:array<struct<loc:string,lastmod:string>>>"

#: The columns of an ingested item every reader ends in, with '' for no value and 0 for no rank.
ITEM = "source_id string, title string, source_url string, canonical_url string, published_at string, summary string, byline string, section string, discovery_method string, body_text string, fulltext_status string, fulltext_note string, rank_position int, rank_section string, source_tags array<string>"


def _iso(c: Column) -> Column:
    return F.coalesce(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"), F.lit(""))


def as_items(df: DataFrame) -> DataFrame:
    """Complete and order the columns of `ITEM`; missing ones get their empty value."""
    have = set(df.columns)
    out = []
    for f in ITEM.split(", "):
        name, kind = f.split(" ", 1)
        empty = F.array().cast("array<string>") if kind.startswith("array") else F.lit(0) if kind == "int" else F.lit("")
        out.append((F.coalesce(F.col(name).cast(kind), empty) if name in have else empty.cast(kind)).alias(name))
    keep = [c for c in ("ingest_seq", "run_id", "fetched_at") if c in have]
    return df.select(*keep, *out)


def rss_items(payloads: DataFrame, ranked: bool = False) -> DataFrame:
    """Items of RSS payloads(source_id, payload, section): the feed's order is the rank where `ranked`.

    A payload that is no RSS gives no rows; items without a title or link are kept with ''.
    """
    feed = payloads.withColumn("f", F.from_xml("payload", RSS, {"mode": "PERMISSIVE"}))
    each = feed.select("source_id", *(["section"] if "section" in payloads.columns else []), F.posexplode("f.channel.item").alias("at", "i"))
    when_ = times.rfc822_instant(F.col("i.pubDate"))
    return as_items(
        each.select(
            "source_id",
            text.clean_markup(F.col("i.title")).alias("title"),
            F.trim(F.col("i.link")).alias("source_url"),
            text.page_address(F.trim(F.col("i.link"))).alias("canonical_url"),
            _iso(F.coalesce(when_, times.iso_instant(F.col("i.pubDate")))).alias("published_at"),
            text.clean_markup(F.col("i.description")).alias("summary"),
            text.squeeze(F.col("i.author")).alias("byline"),
            (F.col("section") if "section" in payloads.columns else F.lit("")).alias("section"),
            F.lit("rss_ranked" if ranked else "rss_listing").alias("discovery_method"),
            (F.col("at") + 1 if ranked else F.lit(0)).alias("rank_position"),
            F.coalesce(F.col("i.category"), F.array().cast("array<string>")).alias("source_tags"),
        )
    )


def atom_items(payloads: DataFrame) -> DataFrame:
    feed = payloads.withColumn("f", F.from_xml("payload", ATOM))
    each = feed.select("source_id", F.explode("f.entry").alias("i"))
    link = F.coalesce(F.get(F.filter("i.link", lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate"), 0)["_href"], F.get(F.col("i.link"), 0)["_href"])
    return as_items(
        each.select(
            "source_id",
            text.clean_markup(F.col("i.title")).alias("title"),
            link.alias("source_url"),
            text.page_address(link).alias("canonical_url"),
            _iso(times.iso_instant(F.coalesce("i.published", "i.updated"))).alias("published_at"),
            text.clean_markup(F.col("i.summary")).alias("summary"),
            F.col("i.author.name").alias("byline"),
            F.lit("atom_listing").alias("discovery_method"),
        )
    )


def sitemap_pages(payloads: DataFrame, marker: str | None = None) -> DataFrame:
    """(source_id, url, modified) of a sitemap, with `marker` only addresses that contain it."""
    each = payloads.withColumn("f", F.from_xml("payload", SITEMAP)).select("source_id", F.explode("f.url").alias("u"))
    out = each.select("source_id", F.trim("u.loc").alias("url"), times.iso_instant(F.col("u.lastmod")).alias("modified"))
    return out.filter(F.col("url").contains(marker)) if marker else out


def sitemap_children(payloads: DataFrame) -> DataFrame:
    return payloads.withColumn("f", F.from_xml("payload", SITEMAP_INDEX)).select("source_id", F.explode("f.sitemap").alias("u")).select("source_id", F.trim("u.loc").alias("url"))


def json_items(payloads: DataFrame, list_path: str, fields: dict[str, str | list[str]], ranked: bool = False) -> DataFrame:
    """Items of a JSON listing. `fields` maps item columns to paths inside an element, the first that has a value.

    Payloads become VARIANT values, so a listing's own shape needs no schema; JSONP wrappers are taken
    off. A payload that is no JSON, or has no list at `list_path`, gives no rows.
    """
    bare = F.regexp_replace(F.trim("payload"), r"^[\w$.]+\((.*)\);?$", "$1")
    v = payloads.withColumn("v", F.try_parse_json(bare))
    elements = F.try_variant_get("v", list_path, "array<variant>")
    each = v.select("source_id", F.posexplode(elements).alias("at", "e"))
    got = {}
    for name, paths in fields.items():
        paths = [paths] if isinstance(paths, str) else paths
        kind = "array<string>" if name == "source_tags" else "string"
        got[name] = F.coalesce(*[F.try_variant_get("e", p, kind) for p in paths])
    if "published_at" in got:
        p = got["published_at"]
        number = p.try_cast("double")
        got["published_at"] = _iso(F.when(number.isNotNull(), times.epoch_instant(number)).otherwise(times.iso_instant(p)))
    if "summary" in got:
        got["summary"] = text.clean_markup(got["summary"])
    return as_items(each.select("source_id", *[c.alias(n) for n, c in got.items()], (F.col("at") + 1 if ranked else F.lit(0)).alias("rank_position"), F.lit("api_ranked" if ranked else "api_listing").alias("discovery_method")))


_TREND = "struct<title:string,link:string,pubDate:string,`ht:approx_traffic`:string,`ht:news_item`:array<struct<`ht:news_item_title`:string,`ht:news_item_url`:string,`ht:news_item_source`:string>>>"
TRENDS = f"struct<channel:struct<item:array<{_TREND}>>>"
_LISTED = "array<struct<position:string,url:string,name:string,item:struct<url:string,name:string,`@id`:string>>>"


def trend_items(payloads: DataFrame) -> DataFrame:
    """Items of a feed of trends in the `ht:` namespace, in the feed's order; the first related news gives address, summary and byline."""
    each = payloads.withColumn("f", F.from_xml("payload", TRENDS)).select("source_id", F.posexplode("f.channel.item").alias("at", "i"))
    news = F.get(F.col("i.`ht:news_item`"), F.lit(0))
    url = text.first_non_empty(F.trim(news["ht:news_item_url"]), F.trim(F.col("i.link")))
    traffic = F.when(F.col("i.`ht:approx_traffic`") != "", F.concat(F.lit("traffic: "), F.col("i.`ht:approx_traffic`")))
    return as_items(
        each.select(
            "source_id", text.clean_markup(F.col("i.title")).alias("title"), url.alias("source_url"), text.page_address(url).alias("canonical_url"), _iso(times.rfc822_instant(F.col("i.pubDate"))).alias("published_at"),
            F.concat_ws(" | ", F.nullif(text.clean_markup(news["ht:news_item_title"]), F.lit("")), traffic).alias("summary"), news["ht:news_item_source"].alias("byline"), F.lit("trends_ranked").alias("discovery_method"), (F.col("at") + 1).alias("rank_position"),
        )
    )


def encoded_bodies(payloads: DataFrame, least: int = 20) -> DataFrame:
    """(source_id, source_url, body_text) of RSS items that carry their article in `content:encoded`: its paragraphs of `least` characters or more."""
    item = "struct<link:string,`content:encoded`:string>"
    each = payloads.withColumn("f", F.from_xml("payload", f"struct<channel:struct<item:array<{item}>>>")).select("source_id", F.explode("f.channel.item").alias("i"))
    body = F.array_join(F.filter(pages.html_paragraphs(F.col("i.`content:encoded`")), lambda p: F.length(p) >= least), "\n")
    return each.select("source_id", F.trim("i.link").alias("source_url"), body.alias("body_text")).filter("body_text <> ''")


def json_ld_items(payloads: DataFrame) -> DataFrame:
    """Ranked items of the lists a page declares in JSON-LD; of one address the first place counts. Pages without such a list give no rows."""
    blocks = payloads.select("source_id", F.posexplode(F.regexp_extract_all("payload", F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))).alias("block", "j"))
    v = blocks.withColumn("v", F.try_parse_json("j"))
    lists = F.coalesce(F.from_json(F.to_json(F.try_variant_get("v", "$.itemListElement", "variant")), _LISTED), F.from_json(F.to_json(F.try_variant_get("v", "$.mainEntity.itemListElement", "variant")), _LISTED))
    each = v.select("source_id", "block", F.posexplode(lists).alias("at", "e"))
    url = text.first_non_empty(F.col("e.url"), F.col("e.item.url"), F.col("e.item.`@id`"))
    each = each.select("source_id", "block", "at", url.alias("url"), text.first_non_empty(F.col("e.name"), F.col("e.item.name")).alias("title")).filter("url <> ''")
    once = each.groupBy("source_id", "url").agg(F.min(F.struct("block", "at", "title")).alias("m"))
    place = F.row_number().over(W.partitionBy("source_id").orderBy("m.block", "m.at"))  # one page's list
    return as_items(once.select("source_id", F.col("m.title").alias("title"), F.col("url").alias("source_url"), text.page_address(F.col("url")).alias("canonical_url"), F.lit("html_ranked").alias("discovery_method"), place.alias("rank_position")))


def embedded_json(page: Column, element_id: str) -> Column:
    """The JSON a page carries in a script element of that id, as VARIANT; null where there is none."""
    return F.try_parse_json(F.regexp_extract(page, rf'(?s)<script[^>]*\bid="{element_id}"[^>]*>(.*?)</script>', 1))


def enriched(ranked: DataFrame, feed: DataFrame, key: str, columns: list[str], inner: bool = False) -> DataFrame:
    """Ranked listing rows with `columns` filled from the feed row of the same key where they are empty; the first feed row of a key counts."""
    once = feed.filter(F.col(key) != "").groupBy(key).agg(*[F.first(c, ignorenulls=True).alias(f"_{c}") for c in columns])
    joined = ranked.join(once, key, "inner" if inner else "left")
    return joined.withColumns({c: text.first_non_empty(text.missing_as_empty(F.col(c)), text.missing_as_empty(F.col(f"_{c}"))) for c in columns}).drop(*[f"_{c}" for c in columns])

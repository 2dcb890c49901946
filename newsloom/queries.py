"""Queries of the core operators, and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import text, times
from newsloom.operators import events, timestamps
from newsloom.operators import relational as rel
from newsloom.plans import pipeline, rules
from newsloom.runtime import table
from newsloom.sources import feeds, landing, pages
from newsloom.streaming import items as stream

FLAGSHIP = "pipeline_ranking"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _items(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "raw_items")


_KEY = "lower(trim(regexp_replace(coalesce(title,''), '[\\s\\p{Z}]+', ' ', 'g')))"
_URL = "coalesce(nullif(canonical_url,''), nullif(source_url,''), '')"
_HOST = "regexp_replace(lower(regexp_extract(coalesce({0},''), '^[A-Za-z][A-Za-z0-9+.\\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^www\\.', '')"
_WORDS = "list_filter(string_split(trim(regexp_replace(lower(coalesce(title,'')), '[^a-z0-9\\x{4e00}-\\x{9fff}]+', ' ', 'g')), ' '), lambda w: length(w) >= 2)"


def _url() -> F.Column:
    return text.first_non_empty(F.col("canonical_url"), F.col("source_url"))


# --- timestamps -------------------------------------------------------------------------------


# the SQL's own month names: by their beginnings, of each language in turn
_MONTH_SQL = "b0"
for _n, _begin in enumerate("jan|jän|ene|янв feb|fév|fev|фев mar|mär|мар apr|avr|abr|апр may|mai|мая|май jun|juin|июн jul|juil|июл aug|août|aout|ago|авг sep|set|сен oct|okt|окт nov|ноя dec|dez|déc|dic|дек".split(), 1):
    _MONTH_SQL = f"regexp_replace({_MONTH_SQL}, '(^|\\s)(?:{_begin})[\\p{{L}}]*\\.?(\\s|$)', '\\1m{_n:02d}\\2', 'i')"
_OFFSETS = {"PST": -8, "PDT": -7, "EST": -5, "EDT": -4, "GMT": 0, "UTC": 0, "BST": 1, "CET": 1, "CEST": 2, "MSK": 3, "IST": 5.5, "CST": 8, "JST": 9, "AEST": 10, "AEDT": 11}


@query(f"""WITH v AS (SELECT r.ingest_seq, c.zone_name, c.date_order, trim(r.published_at) AS v FROM raw_items r JOIN source_clock c USING (source_id) WHERE r.published_at <> ''),
          p AS (SELECT *, regexp_extract(v, '\\[(.*)\\]$', 1) AS zone, regexp_extract(v, ' ([A-Z]{{3,4}})$', 1) AS abbr, regexp_extract(v, '(?::\\d\\d(?:\\.\\d+)? ?|[AP]M )([+-]\\d\\d:?\\d\\d)$', 1) AS off FROM v),
          q AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(v, '\\[.*\\]$| [A-Z]{{3,4}}$|[Zz]$| Uhr$', ''), '(:\\d\\d(?:\\.\\d+)?|[AP]M) ?[+-]\\d\\d:?\\d\\d$', '\\1'), '^[A-Z][a-z]{{2}}, ', '') AS b FROM p),
          m AS (SELECT *, replace(replace(replace(replace(b, ' de ', ' '), ' à ', ' '), ',', ''), '年', '-') AS b0 FROM q),
          n AS (SELECT *, regexp_replace(replace(replace({_MONTH_SQL}, '月', '-'), '日', ''), '(\\d)h(\\d)', '\\1:\\2') AS x FROM m),
          l AS (SELECT *, CASE WHEN contains(x, '/') AND NOT regexp_matches(x, '^\\d{{4}}') THEN
                  CASE WHEN date_order = 'mdy' THEN coalesce(try_strptime(x, '%m/%d/%Y %I:%M %p'), try_strptime(x, '%m/%d/%Y %H:%M')) ELSE coalesce(try_strptime(x, '%d/%m/%Y %I:%M %p'), try_strptime(x, '%d/%m/%Y %H:%M')) END
                ELSE coalesce(try_strptime(x, ['%Y/%m/%d %H:%M', '%Y-%m-%d %H:%M:%S.%f', '%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S.%f', '%Y-%m-%dT%H:%M:%S', '%Y-%m-%dt%H:%M:%S', '%Y-%m-%d', '%Y%m%dT%H%M%S', '%Y-%m-%d %H:%M',
                  '%d m%m %Y %H:%M:%S', '%d m%m %Y %H:%M', 'm%m %d %Y %I:%M %p', 'm%m %d %Y', '%d.%m.%Y %H:%M'])) END AS local FROM n)
          SELECT ingest_seq, us AS published_us FROM (SELECT ingest_seq, CASE
            WHEN regexp_full_match(v, '\\d+(\\.\\d+)?') THEN CASE WHEN v::DECIMAL(30,6) < 1e11 THEN v::DECIMAL(30,6) * 1000000 WHEN v::DECIMAL(30,6) < 1e14 THEN v::DECIMAL(30,6) * 1000 ELSE v::DECIMAL(30,6) END::BIGINT
            WHEN zone <> '' THEN least(epoch_us(timezone(zone, local)), epoch_us(timezone(zone, local - INTERVAL 1 HOUR)) + 3600000000)
            WHEN off <> '' THEN epoch_us(local) - (CASE WHEN off[1] = '-' THEN -1 ELSE 1 END * (off[2:3]::INT * 3600 + right(off, 2)::INT * 60))::BIGINT * 1000000
            WHEN regexp_matches(v, '[Zz]$') AND regexp_matches(v, '\\d[Zz]$') THEN epoch_us(local)
            WHEN abbr <> '' AND abbr NOT IN ('AM', 'PM') THEN epoch_us(local) - (CASE abbr {' '.join(f"WHEN '{k}' THEN {h}" for k, h in _OFFSETS.items())} END * 3600)::BIGINT * 1000000
            ELSE least(epoch_us(timezone(zone_name, local)), epoch_us(timezone(zone_name, local - INTERVAL 1 HOUR)) + 3600000000) END AS us FROM l) t WHERE us IS NOT NULL""")
def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return timestamps.to_instants(_items(spark, d), table(spark, d, "source_clock")).select("ingest_seq", "published_us")


@query()
def p7_zone_estimates(spark: SparkSession, d: str) -> DataFrame:
    """The zone each source's arrivals alone suggest, beside the stated one."""
    clocks = table(spark, d, "source_clock")
    names = sorted({r[0] for r in clocks.select("zone_name").distinct().limit(1000).collect() if r[0]})
    items = _items(spark, d).join(clocks.select("source_id", "date_order"), "source_id", "left")
    own = items.select(F.col("source_id").alias("source"), "published_at", "date_order", timestamps.utc_micros(items, "fetched_at").alias("arrived_us"))
    p = timestamps.parse_notation(own, "published_at", "date_order")
    blank = F.col("offset_s").isNull() & F.col("abbr").isNull() & F.col("zone").isNull()
    found = timestamps.estimate_zones(p.filter(~timestamps.dateonly(F.col("local_us"), blank)), names)
    return found.join(clocks.select(F.col("source_id").alias("source"), F.col("zone_name").alias("stated_zone")), "source", "left")


@query("SELECT ingest_seq, try_strptime(published_at, '%Y-%m-%dT%H:%M:%SZ') AS instant FROM raw_items WHERE regexp_full_match(published_at, '[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z')")
def iso_instants(spark: SparkSession, d: str) -> DataFrame:
    """Every value in the full ISO notation of UTC; null where the date is impossible."""
    x = _items(spark, d).filter(F.col("published_at").rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z$"))
    return x.select("ingest_seq", times.iso_instant(F.col("published_at")).cast("timestamp_ntz").alias("instant"))


@query()
def iso_instants_all(spark: SparkSession, d: str) -> DataFrame:
    """Every ISO value, with fractions, offsets and the ends of months; null where the date is impossible."""
    x = _items(spark, d).filter(F.col("published_at").rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([Tt ]|$)"))
    return x.select("ingest_seq", times.iso_instant(F.col("published_at")).cast("timestamp_ntz").alias("instant"))


@query("""SELECT r.ingest_seq, greatest(0, floor(epoch(g.generated_at - r.fetched_at) / 3600))::INT AS hours_before
          FROM raw_items r JOIN ingest_runs g USING (run_id)""")
def hours_before_run(spark: SparkSession, d: str) -> DataFrame:
    x = _items(spark, d).select("ingest_seq", "run_id", "fetched_at").join(table(spark, d, "ingest_runs"), "run_id")
    return x.select("ingest_seq", times.hours_before(F.col("fetched_at").cast("timestamp"), F.col("generated_at").cast("timestamp")).alias("hours_before"))


@query("""SELECT r.run_id, count(*) AS n_items FROM raw_items r JOIN ingest_runs g USING (run_id)
          WHERE r.fetched_at >= g.generated_at - to_hours(g.lookback_hours) AND r.fetched_at <= g.generated_at GROUP BY 1""")
def within_lookback(spark: SparkSession, d: str) -> DataFrame:
    x = _items(spark, d).select("run_id", "fetched_at").join(table(spark, d, "ingest_runs").select("run_id", "generated_at", "lookback_hours"), "run_id")
    recent = landing.within_lookback(x, F.col("fetched_at"), F.col("generated_at"), F.col("lookback_hours"))
    return recent.filter("fetched_at <= generated_at").groupBy("run_id").agg(F.count("*").alias("n_items"))


@query("""SELECT run_id, source_id, count(*) AS n_late, max(fetched_at) AS latest FROM raw_items r JOIN ingest_runs g USING (run_id)
          WHERE r.fetched_at > g.generated_at GROUP BY 1, 2""")
def late_arrivals(spark: SparkSession, d: str) -> DataFrame:
    x = _items(spark, d).join(table(spark, d, "ingest_runs").select("run_id", "generated_at"), "run_id").filter("fetched_at > generated_at")
    return x.groupBy("run_id", "source_id").agg(F.count("*").alias("n_late"), F.max("fetched_at").alias("latest"))


# --- deduplication ----------------------------------------------------------------------------


@query(f"SELECT ingest_seq FROM (SELECT ingest_seq, row_number() OVER (PARTITION BY {_KEY}, {_URL} ORDER BY ingest_seq) AS rn FROM raw_items) t WHERE rn = 1")
def dedupe_first_wins(spark: SparkSession, d: str) -> DataFrame:
    x = _items(spark, d).select("ingest_seq", F.lower(text.squeeze(text.missing_as_empty(F.col("title")))).alias("t"), _url().alias("u"))
    return rel.first_wins(x, [F.col("t"), F.col("u")], [F.col("ingest_seq")]).select("ingest_seq")


@query(f"""SELECT source_id, k AS title_key, max(ingest_seq) AS ingest_seq FROM (SELECT source_id, ingest_seq,
          trim(regexp_replace({_KEY}, '[^a-z0-9\\x{{4e00}}-\\x{{9fff}} ]', '', 'g')) AS k FROM raw_items) t WHERE k <> '' GROUP BY 1, 2""")
def latest_by_title_key(spark: SparkSession, d: str) -> DataFrame:
    x = _items(spark, d).select("source_id", "ingest_seq", text.title_key(text.missing_as_empty(F.col("title"))).alias("title_key")).filter("title_key <> ''")
    return rel.last_wins(x, [F.col("source_id"), F.col("title_key")], [F.col("ingest_seq")])


@query(f"""SELECT p AS page, count(*) AS n_rows, count(DISTINCT source_id) AS n_sources FROM (SELECT source_id,
          regexp_replace(regexp_replace(source_url, '[?#].*$', ''), '/+$', '') AS p FROM raw_items WHERE source_url <> '') t GROUP BY 1""")
def pages_by_address(spark: SparkSession, d: str) -> DataFrame:
    x = _items(spark, d).filter("source_url <> ''").select("source_id", text.page_address(F.col("source_url")).alias("page"))
    return x.groupBy("page").agg(F.count("*").alias("n_rows"), F.count_distinct("source_id").alias("n_sources"))


@query("""SELECT count(*) AS n_rows, count(*) FILTER (WHERE a = b) AS n_same FROM (SELECT
          regexp_replace(regexp_replace(source_url, '[?#].*$', ''), '/+$', '') AS a, regexp_replace(regexp_replace(canonical_url, '[?#].*$', ''), '/+$', '') AS b
          FROM raw_items WHERE source_url <> '' AND canonical_url <> '') t""")
def address_agreement(spark: SparkSession, d: str) -> DataFrame:
    x = _items(spark, d).filter("source_url <> '' and canonical_url <> ''")
    return x.agg(F.count("*").alias("n_rows"), F.count_if(text.page_address(F.col("source_url")) == text.page_address(F.col("canonical_url"))).alias("n_same"))


@query(f"SELECT h AS host, count(*) AS n FROM (SELECT {_HOST.format('source_url')} AS h FROM raw_items) t GROUP BY 1")
def items_by_host(spark: SparkSession, d: str) -> DataFrame:
    return _items(spark, d).groupBy(text.host(F.col("source_url")).alias("host")).agg(F.count("*").alias("n"))


@query("SELECT ingest_seq, substr(md5(coalesce(source_id,'')||'|'||coalesce(title,'')||'|'||coalesce(published_at,'')),1,10) AS item_id, substr(sha1(coalesce(source_id,'')||'|'||coalesce(source_url,'')||'|'||coalesce(title,'')),1,12) AS candidate_id FROM raw_items")
def item_ids(spark: SparkSession, d: str) -> DataFrame:
    return _items(spark, d).select(
        "ingest_seq",
        text.short_id(10, F.col("source_id"), F.col("title"), F.col("published_at"), algorithm="md5").alias("item_id"),
        text.short_id(12, F.col("source_id"), F.col("source_url"), F.col("title")).alias("candidate_id"),
    )


# --- order, caps, quotas ----------------------------------------------------------------------


@query("""SELECT source_id, run_id, ingest_seq, place FROM (SELECT source_id, run_id, ingest_seq, row_number() OVER (PARTITION BY source_id, run_id ORDER BY
            CASE WHEN rank_position > 0 THEN 0 ELSE 1 END,
            CASE WHEN rank_position > 0 THEN rank_position END ASC NULLS LAST, CASE WHEN rank_position > 0 THEN published_at END ASC NULLS LAST, CASE WHEN rank_position > 0 THEN title END ASC NULLS LAST,
            CASE WHEN coalesce(rank_position,0) <= 0 THEN published_at END DESC NULLS LAST, CASE WHEN coalesce(rank_position,0) <= 0 THEN title END DESC NULLS LAST, ingest_seq) AS place
          FROM raw_items) t WHERE place <= 20""")
def source_listing(spark: SparkSession, d: str) -> DataFrame:
    """Each run's items of a source in listing order, cut at the usual limit."""
    x = _items(spark, d).select("source_id", "run_id", "ingest_seq", "rank_position", "published_at", "title")
    _, order = rel.listing_order(F.col("rank_position"), F.col("published_at"), F.col("title"))
    return rel.capped(x, [F.col("source_id"), F.col("run_id")], [*order, F.col("ingest_seq")], 20).select("source_id", "run_id", "ingest_seq", "place")


@query("""WITH lim AS (SELECT run_id, source_id, max(requested_limit) AS lim FROM source_summaries GROUP BY 1, 2),
          n AS (SELECT r.run_id, r.source_id, l.lim, r.ingest_seq, row_number() OVER (PARTITION BY r.run_id, r.source_id ORDER BY r.ingest_seq) AS place
                FROM raw_items r JOIN lim l USING (run_id, source_id))
          SELECT run_id, source_id, ingest_seq FROM n WHERE place <= lim""")
def requested_limits(spark: SparkSession, d: str) -> DataFrame:
    """The limit of a source is the greatest its requests ask for."""
    lim = table(spark, d, "source_summaries").groupBy("run_id", "source_id").agg(F.max("requested_limit").alias("lim"))
    x = _items(spark, d).select("run_id", "source_id", "ingest_seq").join(lim, ["run_id", "source_id"])
    return rel.capped(x, [F.col("run_id"), F.col("source_id")], [F.col("ingest_seq")], F.col("lim")).select("run_id", "source_id", "ingest_seq")


@query("""WITH k AS (SELECT ingest_seq, source_id, rank_position, row_number() OVER (PARTITION BY source_id ORDER BY rank_position, ingest_seq) AS g FROM raw_items WHERE rank_position > 0)
          SELECT ingest_seq, source_id, row_number() OVER (ORDER BY rank_position, ingest_seq) AS place FROM k WHERE g <= 3 QUALIFY place <= 100""")
def capped_and_reranked(spark: SparkSession, d: str) -> DataFrame:
    x = _items(spark, d).filter("rank_position > 0").select("ingest_seq", "source_id", "rank_position")
    return rel.capped_then_ranked(x, [F.col("source_id")], [F.col("rank_position"), F.col("ingest_seq")], 3, 100).select("ingest_seq", "source_id", "place")


_QUOTAS = {"world": 40, "tech": 40, "energy": 30, "policy": 20, "health": 15}


@query(f"""WITH base AS (SELECT r.ingest_seq, r.section, coalesce(c.role, 'context') AS role, {_URL} AS u FROM raw_items r LEFT JOIN source_catalog c ON r.source_id = c.id WHERE r.section <> ''),
          once AS (SELECT * FROM base QUALIFY row_number() OVER (PARTITION BY u ORDER BY ingest_seq) = 1),
          roles AS (SELECT * FROM once QUALIFY row_number() OVER (PARTITION BY section, role ORDER BY ingest_seq) <= 12),
          q AS (SELECT *, row_number() OVER (PARTITION BY section ORDER BY ingest_seq) AS place FROM roles)
          SELECT section, role, ingest_seq FROM q WHERE place <= CASE section {' '.join(f"WHEN '{k}' THEN {v}" for k, v in _QUOTAS.items())} ELSE 0 END""")
def quota_fill(spark: SparkSession, d: str) -> DataFrame:
    x = _items(spark, d).filter("section <> ''").select("ingest_seq", "source_id", "section", _url().alias("u"))
    x = rel.lookup(x, table(spark, d, "source_catalog"), "source_id", "id", {"role": "context"})
    return rel.quota_fill(x, F.col("section"), F.col("role"), [F.col("ingest_seq")], 12, _QUOTAS, F.col("u")).select("section", "role", "ingest_seq")


@query("SELECT source_id, min(ingest_seq) AS ingest_seq FROM raw_items WHERE fulltext_status = 'full_text_capable' GROUP BY 1")
def stable_sample(spark: SparkSession, d: str) -> DataFrame:
    x = _items(spark, d).filter("fulltext_status = 'full_text_capable'").select("source_id", "ingest_seq")
    return rel.first_wins(x, [F.col("source_id")], [F.col("ingest_seq")])


# --- sources and runs -------------------------------------------------------------------------


@query("""WITH names AS (SELECT id AS name, id, 0 AS o FROM source_catalog UNION ALL SELECT unnest(aliases), id, 1 FROM source_catalog)
          SELECT name, arg_min(id, (o, id)) AS id FROM names WHERE name IS NOT NULL GROUP BY 1""")
def catalog_names(spark: SparkSession, d: str) -> DataFrame:
    return rel.with_aliases(table(spark, d, "source_catalog"), "id", "aliases").filter("name is not null")


@query("""SELECT coalesce(c.tier, 'T2') AS tier, coalesce(c.source_group, 'media') AS source_group, coalesce(c.role, 'discovery') AS role, count(*) AS n
          FROM raw_items r LEFT JOIN source_catalog c ON r.source_id = c.id GROUP BY 1, 2, 3""")
def items_by_source_kind(spark: SparkSession, d: str) -> DataFrame:
    x = rel.lookup(_items(spark, d).select("source_id"), table(spark, d, "source_catalog"), "source_id", "id", {"tier": "T2", "source_group": "media", "role": "discovery"})
    return x.groupBy("tier", "source_group", "role").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT source_id FROM raw_items WHERE source_id NOT IN (SELECT id FROM source_catalog WHERE id IS NOT NULL)")
def sources_without_catalog(spark: SparkSession, d: str) -> DataFrame:
    return _items(spark, d).select("source_id").distinct().join(table(spark, d, "source_catalog").select(F.col("id").alias("source_id")), "source_id", "left_anti")


@query("""SELECT s.run_id, s.source_id, coalesce(s.source_name, c.name, s.source_id) AS label, s.output_count, coalesce(n.n, 0) AS n_delivered
          FROM source_summaries s LEFT JOIN source_catalog c ON s.source_id = c.id
          LEFT JOIN (SELECT run_id, source_id, count(*) AS n FROM raw_items GROUP BY 1, 2) n ON s.run_id = n.run_id AND s.source_id = n.source_id""")
def run_source_counts(spark: SparkSession, d: str) -> DataFrame:
    n = _items(spark, d).groupBy("run_id", "source_id").agg(F.count("*").alias("n"))
    c = table(spark, d, "source_catalog").select(F.col("id").alias("source_id"), "name")
    x = table(spark, d, "source_summaries").join(c, "source_id", "left").join(n, ["run_id", "source_id"], "left")
    return x.select("run_id", "source_id", F.coalesce("source_name", "name", "source_id").alias("label"), "output_count", F.coalesce("n", F.lit(0)).alias("n_delivered"))


@query("SELECT run_id, source_id, status, error FROM source_summaries WHERE status <> 'ok' OR output_count = 0")
def source_gaps(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "source_summaries").filter("status <> 'ok' or output_count = 0").select("run_id", "source_id", "status", "error")


@query("""SELECT 'fulltext_status' AS dimension, fulltext_status AS value, count(*) AS n FROM raw_items GROUP BY 2
          UNION ALL SELECT 'section', section, count(*) FROM raw_items GROUP BY 2 UNION ALL SELECT 'discovery_method', discovery_method, count(*) FROM raw_items GROUP BY 2""")
def distributions(spark: SparkSession, d: str) -> DataFrame:
    return rel.distributions(_items(spark, d), ["fulltext_status", "section", "discovery_method"])


@query("SELECT t AS tag, count(*) AS n FROM (SELECT unnest(source_tags) AS t FROM raw_items) x WHERE t IS NOT NULL GROUP BY 1 ORDER BY n DESC, tag ASC LIMIT 40")
def commonest_tags(spark: SparkSession, d: str) -> DataFrame:
    return rel.counted(_items(spark, d).select(F.explode("source_tags").alias("t")).filter("t is not null"), F.col("t"), "tag", 40)


@query("""WITH n AS (SELECT source_id, section, count(*) AS n, min(ingest_seq) AS seen FROM raw_items WHERE section <> '' GROUP BY 1, 2)
          SELECT source_id, arg_min(section, (-n, seen)) AS section, max(n) AS n FROM n GROUP BY 1""")
def usual_section(spark: SparkSession, d: str) -> DataFrame:
    return rel.most_common(_items(spark, d).filter("section <> ''"), ["source_id"], "section", "ingest_seq")


@query("""WITH v AS (SELECT source_id, unnest(source_tags) AS tag, CASE WHEN rank_position > 0 THEN 1.0 / rank_position ELSE 0.02 END AS w FROM raw_items),
          s AS (SELECT source_id, tag, sum(w) AS score FROM v WHERE tag IS NOT NULL GROUP BY 1, 2)
          SELECT source_id, arg_min(tag, (-round(score, 6), tag)) AS tag FROM s GROUP BY 1""")
def tag_vote(spark: SparkSession, d: str) -> DataFrame:
    w = F.when(F.col("rank_position") > 0, F.lit(1.0) / F.col("rank_position")).otherwise(F.lit(0.02))
    v = _items(spark, d).select("source_id", F.explode("source_tags").alias("tag"), w.alias("w")).filter("tag is not null")
    s = v.groupBy("source_id", "tag").agg(F.round(F.sum("w"), 6).alias("score"))
    return rel.voted(s, ["source_id"], "tag", "score").select("source_id", "tag")


@query("""SELECT source_id, count(*) FILTER (WHERE fulltext_status = 'full_text_capable') AS capable, count(*) FILTER (WHERE fulltext_status = 'partial_only') AS partial,
          count(*) FILTER (WHERE fulltext_status = 'mixed') AS mixed, count(*) AS total FROM raw_items GROUP BY 1""")
def capability_report(spark: SparkSession, d: str) -> DataFrame:
    c = lambda v: F.count_if(F.col("fulltext_status") == v)
    return _items(spark, d).groupBy("source_id").agg(c("full_text_capable").alias("capable"), c("partial_only").alias("partial"), c("mixed").alias("mixed"), F.count("*").alias("total"))


# --- text -------------------------------------------------------------------------------------


@query(f"SELECT ingest_seq, length(array_to_string(list_sort(list_distinct({_WORDS})), ' ')) AS n_chars, len(list_distinct({_WORDS})) AS n_words FROM raw_items")
def title_words(spark: SparkSession, d: str) -> DataFrame:
    x = _items(spark, d).select("ingest_seq", F.array_sort(text.word_array(text.missing_as_empty(F.col("title")))).alias("w"))
    return x.select("ingest_seq", F.length(F.array_join("w", " ")).cast("bigint").alias("n_chars"), F.size("w").cast("bigint").alias("n_words"))


@query(f"""SELECT ingest_seq, coalesce(nullif(array_to_string(list_filter(w, lambda x, i: i = list_position(w, x))[1:6], '-'), ''), 'misc-event') AS slug FROM (SELECT ingest_seq, {_WORDS} AS w FROM raw_items) t""")
def event_slugs(spark: SparkSession, d: str) -> DataFrame:
    return _items(spark, d).select("ingest_seq", text.slug(text.word_array(text.missing_as_empty(F.col("title")))).alias("slug"))


_BUCKETS = {"energy": ["refinery", "turbine", "reactor", "pipeline", "utility"], "finance": ["bond", "bank", "loan", "lender", "ipo"], "policy": ["senate", "treaty", "tribunal", "ai"]}


def _hits_sql(words: list[str]) -> str:
    one = lambda k: f"list_contains(regexp_split_to_array(x, '[^a-z0-9]+'), '{k}')" if len(k) <= 3 else f"contains(x, '{k}')"
    return " + ".join(f"({one(k)})::INT" for k in words)


@query(f"SELECT ingest_seq, {', '.join(f'{_hits_sql(v)} AS {k}' for k, v in _BUCKETS.items())} FROM (SELECT ingest_seq, lower(coalesce(title,'')||' '||coalesce(summary,'')) AS x FROM raw_items) t")
def keyword_buckets(spark: SparkSession, d: str) -> DataFrame:
    x = _items(spark, d).select("ingest_seq", F.concat(text.missing_as_empty(F.col("title")), F.lit(" "), text.missing_as_empty(F.col("summary"))).alias("x"))
    return x.select("ingest_seq", *[text.keyword_hits(F.col("x"), v).alias(k) for k, v in _BUCKETS.items()])


@query("SELECT ingest_seq FROM raw_items WHERE regexp_matches(lower(coalesce(title,'')), '\\brival\\s+ballot\\b|\\bdraft\\s+treaty\\b') OR contains(coalesce(title,''), '用电价格')")
def phrase_matches(spark: SparkSession, d: str) -> DataFrame:
    t = text.missing_as_empty(F.col("title"))
    return _items(spark, d).filter(text.has_phrase(t, "rival ballot") | text.has_phrase(t, "draft treaty") | text.has_phrase(t, "用电价格")).select("ingest_seq")


@query("""SELECT w AS name, count(*) AS n FROM (SELECT DISTINCT ingest_seq, unnest(regexp_extract_all(title, '\\b([A-Z][A-Za-z0-9&.\\-]+)', 1)) AS w FROM raw_items
          WHERE regexp_full_match(title, '[ -~]*')) t GROUP BY 1""")
def named_words(spark: SparkSession, d: str) -> DataFrame:
    """Over titles in ASCII, where the SQL engine's word boundaries agree."""
    return _name_counts(_items(spark, d).filter(F.col("title").rlike("^[ -~]*$")))


@query()
def named_words_all(spark: SparkSession, d: str) -> DataFrame:
    """Over all titles."""
    return _name_counts(_items(spark, d))


def _name_counts(x: DataFrame) -> DataFrame:
    return x.select(F.explode(text.named_words(F.col("title"))).alias("name")).groupBy("name").agg(F.count("*").alias("n"))


@query("""SELECT ingest_seq, (length(regexp_replace(coalesce(title,''), '[^A-Za-z]', '', 'g')) >= 8 AND length(regexp_replace(coalesce(title,''), '[^A-Za-z]', '', 'g')) >
          length(regexp_replace(coalesce(title,''), '[^\\x{4e00}-\\x{9fff}]', '', 'g'))) AS english FROM raw_items""")
def english_titles(spark: SparkSession, d: str) -> DataFrame:
    return _items(spark, d).select("ingest_seq", text.mostly_english(F.col("title")).alias("english"))


@query("SELECT ingest_seq, regexp_extract(summary, '\\bvotes=([0-9]+)', 1)::BIGINT AS votes, regexp_extract(summary, '\\breplies=([0-9]+)', 1)::BIGINT AS replies FROM raw_items WHERE contains(summary, '| votes=')")
def listing_counters(spark: SparkSession, d: str) -> DataFrame:
    x = _items(spark, d).filter(F.col("summary").contains("| votes="))
    return x.select("ingest_seq", text.counter_value(F.col("summary"), "votes").alias("votes"), text.counter_value(F.col("summary"), "replies").alias("replies"))


@query("""SELECT ingest_seq, len(p) AS n_paragraphs, coalesce(list_sum(list_transform(p, lambda x: length(x))), 0)::BIGINT AS n_chars FROM (SELECT ingest_seq,
          list_filter(list_transform(string_split(coalesce(body_text,''), chr(10)), lambda x: trim(regexp_replace(x, '[\\s\\p{Z}]+', ' ', 'g'))), lambda x: length(x) >= 20) AS p FROM raw_items) t""")
def body_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs of 20 characters or more; repeats in a row do not occur in these tables."""
    x = _items(spark, d).select("ingest_seq", text.paragraphs(F.col("body_text"), 20).alias("p"))
    return x.select("ingest_seq", F.size("p").cast("bigint").alias("n_paragraphs"), F.aggregate("p", F.lit(0).cast("bigint"), lambda n, v: n + F.length(v)).alias("n_chars"))


@query("""SELECT c AS page_class, count(*) AS n FROM (SELECT CASE WHEN n >= 5 AND k >= 1200 THEN 'full' WHEN n >= 2 AND k >= 300 THEN 'mixed' WHEN b THEN 'blocked' ELSE 'partial' END AS c FROM (
          SELECT len(p) AS n, coalesce(list_sum(list_transform(p, lambda x: length(x))), 0) AS k, b FROM (SELECT coalesce(fulltext_note,'') IN ('http_403_blocked','challenge_or_access_denied') AS b,
          list_filter(list_transform(string_split(coalesce(body_text,''), chr(10)), lambda x: trim(regexp_replace(x, '[\\s\\p{Z}]+', ' ', 'g'))), lambda x: length(x) >= 20) AS p FROM raw_items) t) u) v GROUP BY 1""")
def page_classes(spark: SparkSession, d: str) -> DataFrame:
    x = _items(spark, d).select(text.paragraphs(F.col("body_text"), 20).alias("p"), text.missing_as_empty(F.col("fulltext_note")).isin("http_403_blocked", "challenge_or_access_denied").alias("b"))
    x = x.select(F.size("p").alias("n"), F.aggregate("p", F.lit(0), lambda n, v: n + F.length(v)).alias("k"), "b")
    return x.groupBy(pages.page_class(F.lit(200), F.col("n"), F.col("k"), F.col("b")).alias("page_class")).agg(F.count("*").alias("n"))


@query("SELECT DISTINCT title FROM raw_items WHERE title <> '' AND title NOT IN (SELECT title FROM raw_items WHERE fulltext_status = 'fulltext' AND title IS NOT NULL)")
def cache_misses(spark: SparkSession, d: str) -> DataFrame:
    """Titles a cache built from the full-text items does not hold."""
    x = _items(spark, d)
    return rel.cache_misses(x.select("title"), x.filter("fulltext_status = 'fulltext'").select("title").distinct(), "title")


@query()
def title_ratio(spark: SparkSession, d: str) -> DataFrame:
    """Matching-blocks ratio of the titles that share most of their words."""
    pairs = events.with_sides(_similar(spark, d), _items(spark, d), "ingest_seq", ["title"])
    return pairs.select("a", "b", text.sequence_ratio(F.col("p.title"), F.col("q.title")).alias("ratio"))


# --- events -----------------------------------------------------------------------------------


@query(f"""WITH RECURSIVE n AS (SELECT ingest_seq, {_URL} AS u, trim(regexp_replace({_KEY}, '[^a-z0-9\\x{{4e00}}-\\x{{9fff}} ]', '', 'g')) AS k FROM raw_items),
          hub AS (SELECT a.ingest_seq AS s, min(b.ingest_seq) AS t FROM n a JOIN n b ON a.u = b.u AND a.u <> '' GROUP BY 1 UNION ALL SELECT a.ingest_seq, min(b.ingest_seq) FROM n a JOIN n b ON a.k = b.k AND a.k <> '' GROUP BY 1),
          e AS (SELECT s, t FROM hub UNION SELECT t, s FROM hub),
          c(id, g) AS (SELECT ingest_seq, ingest_seq FROM n UNION SELECT e.t, c.g FROM c JOIN e ON e.s = c.id)
          SELECT id AS ingest_seq, min(g) AS group_id FROM c GROUP BY 1""")
def linked_groups(spark: SparkSession, d: str) -> DataFrame:
    """Items linked by address or title key, directly or through others."""
    x = _items(spark, d).select("ingest_seq", _url().alias("u"), text.title_key(text.missing_as_empty(F.col("title"))).alias("k"))
    return events.linked_groups(x, "ingest_seq", [F.col("u"), F.col("k")])


_STORY = f"list_sort(list_distinct({_WORDS}))"


_NODES = f"""x AS (SELECT ingest_seq, coalesce(section,'') AS g, epoch_us(fetched_at) AS t, {_STORY} AS w FROM raw_items WHERE fetched_at IS NOT NULL),
          y AS (SELECT *, CASE WHEN t - lag(t) OVER o <= 36 * 3600000000 THEN 0 ELSE 1 END AS opens FROM x WHERE len(w) > 0 WINDOW o AS (PARTITION BY g, w ORDER BY t, ingest_seq)),
          z AS (SELECT *, sum(opens) OVER (PARTITION BY g, w ORDER BY t, ingest_seq ROWS UNBOUNDED PRECEDING) AS k FROM y),
          n AS (SELECT arg_min(ingest_seq, (t, ingest_seq)) AS node, g, w, min(t) AS t0, max(t) AS t1, count(*) AS n_items FROM z GROUP BY g, w, k)"""


@query(f"WITH {_NODES} SELECT node, n_items FROM n")
def title_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Items with the same title words in one section, as long as they follow one another within 36 hours."""
    return _nodes(spark, d)[1].groupBy("node").agg(F.count("*").alias("n_items"))


@query(f"""WITH {_NODES}, u AS (SELECT node, g, unnest(w) AS x FROM n), c AS (SELECT DISTINCT a.node AS a, b.node AS b FROM u a JOIN u b ON a.x = b.x AND a.g = b.g AND a.node < b.node)
          SELECT c.a, c.b, round(len(list_intersect(p.w, q.w)) / len(list_distinct(list_concat(p.w, q.w))), 6) AS similarity FROM c JOIN n p ON c.a = p.node JOIN n q ON c.b = q.node
          WHERE p.w <> q.w AND len(list_intersect(p.w, q.w)) >= (0.6 - 1e-9) * len(list_distinct(list_concat(p.w, q.w))) AND q.t0 - p.t1 <= 36 * 3600000000 AND p.t0 - q.t1 <= 36 * 3600000000""")
def similar_titles(spark: SparkSession, d: str) -> DataFrame:
    return _similar(spark, d).select("a", "b", F.round("similarity", 6).alias("similarity"))


def _nodes(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    x = _items(spark, d).select("ingest_seq", text.missing_as_empty(F.col("title")).alias("title"), text.missing_as_empty(F.col("section")).alias("section"), "fetched_at")
    return events.title_nodes(x, "ingest_seq", "title", "section", "fetched_at", 36)


def _similar(spark: SparkSession, d: str) -> DataFrame:
    return events.similar_nodes(_nodes(spark, d)[0], 0.6, 36)


_SIMILAR = """u AS (SELECT node, g, unnest(w) AS x FROM n), c AS (SELECT DISTINCT a.node AS a, b.node AS b FROM u a JOIN u b ON a.x = b.x AND a.g = b.g AND a.node < b.node),
          sim AS (SELECT c.a, c.b, round(len(list_intersect(p.w, q.w)) / len(list_distinct(list_concat(p.w, q.w))), 6) AS similarity FROM c JOIN n p ON c.a = p.node JOIN n q ON c.b = q.node
          WHERE p.w <> q.w AND len(list_intersect(p.w, q.w)) >= (0.6 - 1e-9) * len(list_distinct(list_concat(p.w, q.w))) AND q.t0 - p.t1 <= 36 * 3600000000 AND p.t0 - q.t1 <= 36 * 3600000000)"""


def first_fit_sql(nodes: str, edges: str, order: str) -> str:
    """The first node of `order` that edges to earlier nodes lead to: CTEs that end in ff(node, bucket)."""
    return f"""od AS (SELECT node, row_number() OVER (ORDER BY {order}) AS pl FROM {nodes}),
          bk AS (SELECT x.node AS later, y.node AS earlier FROM (SELECT a, b FROM {edges} UNION ALL SELECT b, a FROM {edges}) e JOIN od x ON e.a = x.node JOIN od y ON e.b = y.node WHERE y.pl < x.pl),
          rc(i, r) AS (SELECT node, node FROM od UNION SELECT rc.i, bk.earlier FROM rc JOIN bk ON bk.later = rc.r),
          ff AS (SELECT rc.i AS node, arg_min(rc.r, od.pl) AS bucket FROM rc JOIN od ON od.node = rc.r GROUP BY 1)"""


_MEMBERS = "zm AS (SELECT ingest_seq, first_value(ingest_seq) OVER (PARTITION BY g, w, k ORDER BY t, ingest_seq) AS node FROM z)"


@query(f"""WITH RECURSIVE {_NODES}, {_MEMBERS}, {_SIMILAR}, {first_fit_sql('n', 'sim', 't0, node')} SELECT zm.ingest_seq, ff.bucket FROM zm JOIN ff USING (node)""")
def first_fit_events(spark: SparkSession, d: str) -> DataFrame:
    """Buckets of similar titles in the order of their first delivery."""
    nodes, members = _nodes(spark, d)
    found = events.first_fit(nodes, events.similar_nodes(nodes, 0.6, 36), "node", [F.col("t0")])
    return members.join(found, "node").select(F.col("id").alias("ingest_seq"), "bucket")


@query(f"""WITH RECURSIVE n AS (SELECT ingest_seq, {_URL} AS u, trim(regexp_replace({_KEY}, '[^a-z0-9\\x{{4e00}}-\\x{{9fff}} ]', '', 'g')) AS k FROM raw_items),
          hub AS (SELECT a.ingest_seq AS s, min(b.ingest_seq) AS t FROM n a JOIN n b ON a.u = b.u AND a.u <> '' GROUP BY 1 UNION ALL SELECT a.ingest_seq, min(b.ingest_seq) FROM n a JOIN n b ON a.k = b.k AND a.k <> '' GROUP BY 1),
          e AS (SELECT s, t FROM hub UNION SELECT t, s FROM hub), c(id, g) AS (SELECT ingest_seq, ingest_seq FROM n UNION SELECT e.t, c.g FROM c JOIN e ON e.s = c.id),
          lg AS (SELECT id AS ingest_seq, min(g) AS group_id FROM c GROUP BY 1)
          SELECT group_id, arg_min(ingest_seq, (CASE WHEN rank_position > 0 THEN rank_position ELSE 9999 END, ingest_seq)) AS main_id, count(*) AS n_items, count(DISTINCT source_id) AS n_sources, min(fetched_at) AS first_seen, max(fetched_at) AS last_seen
          FROM raw_items JOIN lg USING (ingest_seq) GROUP BY 1 ORDER BY n_sources DESC, n_items DESC, group_id LIMIT 100""")
def event_ranking(spark: SparkSession, d: str) -> DataFrame:
    """The largest events: items linked by address or title, their main item, sources and span, best hundred."""
    x = _items(spark, d).select("ingest_seq", "source_id", "fetched_at", "rank_position", _url().alias("u"), text.title_key(text.missing_as_empty(F.col("title"))).alias("k"))
    groups = events.linked_groups(x, "ingest_seq", [F.col("u"), F.col("k")])
    rank = F.when(F.col("rank_position") > 0, F.col("rank_position")).otherwise(9999)
    summary = events.group_summary(x, groups, "ingest_seq", "source_id", "fetched_at", [rank.alias("r")])
    return summary.orderBy(F.desc("n_sources"), F.desc("n_items"), "group_id").limit(100)


# --- sources: round trips ---------------------------------------------------------------------

_PRINTABLE = "title IS NOT NULL AND regexp_full_match(title, '[!-~]+( [!-~]+)*') AND source_url <> ''"


@query(f"SELECT source_id, title, source_url, count(*) AS n FROM raw_items WHERE {_PRINTABLE} GROUP BY 1, 2, 3")
def rss_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Items written as one RSS payload per run and source, read back by the feed reader."""
    return _through_rss(_items(spark, d).filter(F.col("title").rlike("^[!-~]+( [!-~]+)*$") & (F.col("source_url") != "")))


@query()
def rss_round_trip_all(spark: SparkSession, d: str) -> DataFrame:
    """Every item through the RSS reader, which squeezes blanks and strips markup."""
    e = text.missing_as_empty
    return _through_rss(_items(spark, d).withColumns({"title": e(F.col("title")), "source_url": e(F.col("source_url"))}))


def _through_rss(x: DataFrame) -> DataFrame:
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    item = F.concat(F.lit("<item><title>"), esc(F.col("title")), F.lit("</title><link>"), esc(F.col("source_url")), F.lit("</link></item>"))
    # a payload is one run's listing of a source: a few hundred items
    feed = x.groupBy("run_id", "source_id").agg(F.concat(F.lit("<rss><channel><title>t</title>"), F.concat_ws("", F.collect_list(item)), F.lit("</channel></rss>")).alias("payload"))
    return feeds.rss_items(feed.select("source_id", "payload")).groupBy("source_id", "title", "source_url").agg(F.count("*").alias("n"))


@query("SELECT source_id, title, summary, byline, coalesce(source_tags, []) AS source_tags, count(*) AS n FROM raw_items WHERE title <> '' AND regexp_full_match(summary, '[!-%''-;=?-~]+( [!-%''-;=?-~]+)*') AND byline <> '' GROUP BY 1, 2, 3, 4, 5")
def json_round_trip(spark: SparkSession, d: str) -> DataFrame:
    return _through_json(_items(spark, d).filter(F.col("summary").rlike("^[!-%'-;=?-~]+( [!-%'-;=?-~]+)*$") & (F.col("title") != "") & (F.col("byline") != "")))


@query()
def json_round_trip_all(spark: SparkSession, d: str) -> DataFrame:
    """Every item through the JSON reader, which cleans the summary."""
    return _through_json(_items(spark, d))


def _through_json(x: DataFrame) -> DataFrame:
    listing = x.groupBy("run_id", "source_id").agg(F.to_json(F.struct(F.collect_list(F.struct("title", "summary", "byline", "source_tags")).alias("items"))).alias("payload"))
    got = feeds.json_items(listing.select("source_id", "payload"), "$.items", {"title": "$.title", "summary": ["$.abstract", "$.summary"], "byline": "$.byline", "source_tags": "$.source_tags"})
    return got.groupBy("source_id", "title", "summary", "byline", "source_tags").agg(F.count("*").alias("n"))


# --- streams and events -----------------------------------------------------------------------


@query("SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY 1, 2")
def hourly_events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("value"))


@query("""WITH s AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS opens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
          n AS (SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING)::BIGINT AS session FROM s)
          SELECT user_id, session, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM n GROUP BY 1, 2""")
def user_sessions(spark: SparkSession, d: str) -> DataFrame:
    x = rel.sessions(table(spark, d, "events").select("user_id", "ts"), "user_id", "ts", 1800)
    return x.groupBy("user_id", "session").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query("SELECT DISTINCT event_id, event_type FROM events")
def stream_deduplicated(spark: SparkSession, d: str) -> DataFrame:
    """The events table as a stream, one row per event id within the watermark."""
    s = stream.read_stream(spark, f"{d}/events.parquet").withColumn("at", F.col("ts").cast("timestamp"))
    return stream.run_to_end(stream.deduplicated(s, ["event_id"], "at", "1 hour").select("event_id", "event_type"), "dedup")


@query("""SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events
          WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 30 MINUTE FROM events) GROUP BY 1, 2""")
def stream_windows(spark: SparkSession, d: str) -> DataFrame:
    """Hourly counts of the stream, of windows the watermark has closed."""
    s = stream.read_stream(spark, f"{d}/events.parquet").withColumn("at", F.col("ts").cast("timestamp"))
    out = stream.windowed_counts(s.select("at", "event_type"), "at", ["event_type"], "1 hour", None, "30 minutes")
    return stream.run_to_end(out, "windows").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("""SELECT s.source_id, s.run_id, s.status, max_by(g.run_id, (g.generated_at, g.run_id)) AS earlier_run FROM source_summaries s JOIN ingest_runs h ON s.run_id = h.run_id
          LEFT JOIN (SELECT t.source_id, r.run_id, r.generated_at FROM source_summaries t JOIN ingest_runs r USING (run_id) WHERE t.status = 'ok') g ON g.source_id = s.source_id AND g.generated_at <= h.generated_at
          WHERE s.status <> 'ok' GROUP BY ALL""")
def last_good_run(spark: SparkSession, d: str) -> DataFrame:
    """As-of join: for each source that failed in a run its latest run that went well, at that time or before."""
    s = table(spark, d, "source_summaries").select("run_id", "source_id", "status").join(table(spark, d, "ingest_runs").select("run_id", "generated_at"), "run_id")
    good = s.filter("status = 'ok'").select("source_id", F.col("generated_at").alias("good_at"), F.col("run_id").alias("good_run"))
    met = rel.as_of(s.filter("status <> 'ok'").distinct(), good, ["source_id"], "generated_at", "good_at", 30 * 86_400)
    return met.select("source_id", "run_id", "status", F.col("match.good_run").alias("earlier_run"))


_OUTCOME = "nullif(regexp_extract(coalesce(fulltext_note,''), 'http_([0-9]{3})', 1), '')::INT"


@query(f"""WITH t AS (SELECT CASE WHEN fulltext_note = 'request_failed' THEN NULL ELSE coalesce({_OUTCOME}, 200) END AS st, coalesce(fulltext_note,'') IN ('challenge_or_access_denied','body_extracted_with_challenge_markers') AS ch,
          list_filter(list_transform(string_split(coalesce(body_text,''), chr(10)), lambda x: trim(regexp_replace(x, '[\\s\\p{{Z}}]+', ' ', 'g'))), lambda x: length(x) >= 20) AS p FROM raw_items),
          u AS (SELECT st, ch, len(p) AS n, coalesce(list_sum(list_transform(p, lambda x: length(x))), 0) AS k FROM t),
          v AS (SELECT CASE WHEN st IS NULL THEN 'request_failed' WHEN st IN (401, 403) THEN 'http_' || st || '_blocked' WHEN st >= 400 THEN 'http_' || st WHEN n >= 5 AND k >= 1200 THEN 'body_extracted' WHEN n >= 2 AND k >= 300 AND ch THEN 'body_extracted_with_challenge_markers'
            WHEN n >= 2 AND k >= 300 THEN 'partial_body_extracted' WHEN ch THEN 'challenge_or_access_denied' ELSE 'body_too_short' END AS note FROM u)
          SELECT note, CASE WHEN note = 'body_extracted' THEN 'full_text_capable' WHEN note IN ('body_extracted_with_challenge_markers', 'partial_body_extracted') THEN 'mixed' ELSE 'partial_only' END AS capability, count(*) AS n FROM v GROUP BY 1, 2""")
def page_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Every page's outcome by the answer its note tells of and by its paragraphs."""
    note = text.missing_as_empty(F.col("fulltext_note"))
    status = F.when(note != "request_failed", F.coalesce(F.nullif(F.regexp_extract(note, "http_([0-9]{3})", 1), F.lit("")).cast("int"), F.lit(200)))
    x = _items(spark, d).select(text.paragraphs(F.col("body_text"), 20).alias("p"), status.alias("s"), note.isin("challenge_or_access_denied", "body_extracted_with_challenge_markers").alias("c"))
    x = x.select("s", "c", F.size("p").alias("n"), F.aggregate("p", F.lit(0), lambda n, v: n + F.length(v)).alias("k"))
    return x.groupBy(pages.page_outcome(F.col("s"), F.col("n"), F.col("k"), F.col("c")).alias("o")).agg(F.count("*").alias("n")).select("o.note", "o.capability", "n")


@query("SELECT source_id, 'ok' AS status, count(*) AS n FROM source_clock GROUP BY 1 UNION ALL SELECT 'missing', 'failed', 1")
def landed_payloads(spark: SparkSession, d: str) -> DataFrame:
    """One landing task per source of the clock table; a source that cannot be read gives a row with its status."""
    names = [r[0] for r in table(spark, d, "source_clock").select("source_id").distinct().limit(1000).collect()]
    specs = [{"source_id": n, "protocol": "bytes", "location": f"{d}/source_clock.parquet"} for n in names]
    import os

    for s in specs:
        if os.path.isdir(s["location"]):
            s["location"] = sorted(os.path.join(s["location"], x) for x in os.listdir(s["location"]) if x.endswith(".parquet"))[0]
    specs.append({"source_id": "missing", "protocol": "bytes", "location": f"{d}/no-such-file"})
    return landing.read_payloads(spark, specs).groupBy("source_id", "status").agg(F.count("*").alias("n"))


# --- rules and the whole plan -----------------------------------------------------------------

PACK = rules.RulePack(
    buckets=_BUCKETS,
    section_boosts=[("harbor-wire", "energy", "energy", 2)],
    strong=[("policy", 3, ["treaty", "tribunal"])],
    fallback={"harbor-wire": "finance"},
    default="other",
    tags=[("legal", ["tribunal", "inquiry"]), ("transport", ["ferry", "railway", "airline"]), ("figures", ["percent"])],
)
_TEXT = "lower(coalesce(title,'')||' '||coalesce(summary,'')||' '||coalesce(section,''))"
_STRONG = "CASE WHEN contains(x,'treaty') OR contains(x,'tribunal') THEN 3 ELSE 0 END"


@query(f"""WITH t AS (SELECT ingest_seq, coalesce(source_id,'') AS s, lower(coalesce(section,'')) AS sec, {_TEXT} AS x FROM raw_items),
          n AS (SELECT ingest_seq, s, x, {_hits_sql(_BUCKETS['energy'])} + CASE WHEN s = 'harbor-wire' AND sec = 'energy' THEN 2 ELSE 0 END AS e, {_hits_sql(_BUCKETS['finance'])} AS f, {_hits_sql(_BUCKETS['policy'])} + {_STRONG} AS p FROM t)
          SELECT ingest_seq, CASE WHEN greatest(e,f,p) = 0 THEN CASE WHEN s = 'harbor-wire' THEN 'finance' ELSE 'other' END WHEN e = greatest(e,f,p) THEN 'energy' WHEN f = greatest(e,f,p) THEN 'finance' ELSE 'policy' END AS bucket,
          array_to_string(list_slice(list_filter([CASE WHEN contains(x,'tribunal') OR contains(x,'inquiry') THEN 'legal' END, CASE WHEN contains(x,'ferry') OR contains(x,'railway') OR contains(x,'airline') THEN 'transport' END, CASE WHEN contains(x,'percent') THEN 'figures' END], lambda v: v IS NOT NULL), 1, 2), ',') AS tags FROM n""")
def classified_items(spark: SparkSession, d: str) -> DataFrame:
    out = rules.classified(_items(spark, d), "ingest_seq", ["title", "summary", "section"], "source_id", "section", PACK)
    return out.select("ingest_seq", "bucket", F.array_join("tags", ",").alias("tags"))


@query("""WITH f AS (SELECT ingest_seq, list_filter([CASE WHEN length(coalesce(title,'')) < 8 THEN 'short title' END, CASE WHEN coalesce(source_url,'') = '' THEN 'no address' END,
          CASE WHEN fulltext_status = 'metadata_only' THEN 'metadata only' END, CASE WHEN contains(coalesce(summary,''), '| votes=') THEN 'listing' END], lambda v: v IS NOT NULL) AS r FROM raw_items)
          SELECT ingest_seq, array_to_string(r, ',') AS reasons FROM f WHERE len(r) > 0""")
def noise_flags(spark: SparkSession, d: str) -> DataFrame:
    e = text.missing_as_empty
    drop = {"short title": F.length(e(F.col("title"))) < 8, "no address": e(F.col("source_url")) == "", "metadata only": F.col("fulltext_status") == "metadata_only", "listing": e(F.col("summary")).contains("| votes=")}
    return pipeline.sifted(_items(spark, d), drop)[1].select("ingest_seq", F.array_join("reasons", ",").alias("reasons"))


@query("""WITH v AS (SELECT ingest_seq, 40.0 + 12.0 * (CASE WHEN coalesce(rank_position,0) > 0 THEN 1.0 / rank_position ELSE 0 END) * 5 + length(coalesce(title,'')) * 0.25 AS raw FROM raw_items)
          SELECT ingest_seq, greatest(0, least(100, round_even(CASE WHEN raw > 88 THEN 88 + (raw - 88) * 0.5 ELSE raw END, 0)::INT)) AS score FROM v""")
def soft_capped_scores(spark: SparkSession, d: str) -> DataFrame:
    inverse = F.when(F.coalesce("rank_position", F.lit(0)) > 0, F.lit(1.0) / F.col("rank_position")).otherwise(0.0)
    raw = 40.0 + 12.0 * inverse * 5 + F.length(text.missing_as_empty(F.col("title"))) * 0.25
    return _items(spark, d).select("ingest_seq", rules.soft_capped(raw, 88, 0.5).alias("score"))


@query("""WITH h AS (SELECT ingest_seq, (regexp_matches(x, '\\btunnel\\b')::INT + regexp_matches(x, '\\bharbor\\b')::INT) AS a, (regexp_matches(x, '\\bsenate\\b')::INT + regexp_matches(x, '\\btreaty\\b')::INT) AS b
          FROM (SELECT ingest_seq, lower(title) AS x FROM raw_items WHERE title IS NOT NULL) t),
          s AS (SELECT ingest_seq, CASE WHEN a > 0 THEN round(least(1.0, 0.35 + 0.18 * a), 3) END AS a, CASE WHEN b > 0 THEN round(least(1.0, 0.35 + 0.18 * b), 3) END AS b FROM h)
          SELECT ingest_seq, CASE WHEN a IS NULL AND b IS NULL THEN NULL WHEN b IS NULL OR a >= b THEN 'works' ELSE 'state' END AS best FROM s""")
def best_soft_tag(spark: SparkSession, d: str) -> DataFrame:
    tags = rules.soft_tags(F.col("title"), {"works": ["tunnel", "harbor"], "state": ["senate", "treaty"]})
    return _items(spark, d).filter("title is not null").select("ingest_seq", F.get(tags, F.lit(0))["tag"].alias("best"))


@query("""WITH e AS (SELECT DISTINCT source_id, ingest_seq, unnest(source_tags) AS t FROM raw_items), n AS (SELECT source_id, lower(t) AS k, count(*) AS n FROM e WHERE t IS NOT NULL GROUP BY 1, 2)
          SELECT source_id, k AS entity, n FROM n QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY n DESC, k) <= 10""")
def source_entities(spark: SparkSession, d: str) -> DataFrame:
    """The ten commonest tags of each source."""
    e = _items(spark, d).select("source_id", "ingest_seq", F.explode("source_tags").alias("t")).filter("t is not null").distinct()
    n = e.groupBy("source_id", F.lower("t").alias("entity")).agg(F.count("*").alias("n"))
    return rel.capped(n, [F.col("source_id")], [F.desc("n"), F.asc("entity")], 10).select("source_id", "entity", "n")


@query()
def title_entities(spark: SparkSession, d: str) -> DataFrame:
    x = _items(spark, d).select(F.explode(rules.entities(text.missing_as_empty(F.col("title")))).alias("entity"))
    return x.groupBy("entity").agg(F.count("*").alias("n"))


_CLASSIFIED = ORACLE["classified_items"]


@query(f"""WITH RECURSIVE once AS (SELECT * FROM raw_items QUALIFY row_number() OVER (PARTITION BY {_KEY}, {_URL} ORDER BY ingest_seq) = 1),
          cd AS (SELECT o.ingest_seq, o.source_id, o.title, o.fetched_at, o.rank_position, k.bucket FROM once o JOIN ({_CLASSIFIED}) k USING (ingest_seq) WHERE coalesce(o.fulltext_status, '') <> 'metadata_only' AND coalesce(o.title, '') <> ''),
          {_NODES.replace("coalesce(section,'')", "bucket").replace('FROM raw_items', 'FROM cd')}, {_MEMBERS}, {_SIMILAR}, {first_fit_sql('n', 'sim', 't0, node')},
          gr AS (SELECT cd.ingest_seq, coalesce(ff.bucket, cd.ingest_seq) AS group_id FROM cd LEFT JOIN zm USING (ingest_seq) LEFT JOIN ff ON ff.node = zm.node),
          ev AS (SELECT group_id, arg_min(ingest_seq, (CASE WHEN rank_position > 0 THEN rank_position ELSE 9999 END, fetched_at, ingest_seq)) AS main_id, count(*) AS n_items, count(DISTINCT source_id) AS n_sources, min(fetched_at) AS first_seen, max(fetched_at) AS last_seen
                FROM cd JOIN gr USING (ingest_seq) GROUP BY 1),
          rk AS (SELECT ev.*, cd.title, cd.bucket, row_number() OVER (PARTITION BY cd.bucket ORDER BY n_sources DESC, n_items DESC, main_id) AS pl FROM ev JOIN cd ON cd.ingest_seq = ev.main_id)
          SELECT main_id, group_id, n_items, n_sources, first_seen, last_seen, title, bucket, row_number() OVER (ORDER BY n_sources DESC, n_items DESC, main_id) AS place FROM rk WHERE pl <= 15 QUALIFY place <= 100""")
def pipeline_ranking(spark: SparkSession, d: str) -> DataFrame:
    """The whole plan: deduplicated, sifted, classified and grouped items, the best events of each bucket."""
    drop = {"listing only": F.coalesce(F.col("fulltext_status"), F.lit("")) == "metadata_only"}
    return pipeline.item_events(_items(spark, d), PACK, drop).ranking


# --- reports ----------------------------------------------------------------------------------


@query(f"""SELECT k AS title_key, substr(sha1(string_agg(ingest_seq::VARCHAR, '|' ORDER BY ingest_seq::VARCHAR)), 1, 12) AS event_id, count(*) AS n FROM (SELECT ingest_seq,
          trim(regexp_replace({_KEY}, '[^a-z0-9\\x{{4e00}}-\\x{{9fff}} ]', '', 'g')) AS k FROM raw_items) t WHERE k <> '' GROUP BY 1 HAVING count(*) BETWEEN 2 AND 50""")
def event_ids(spark: SparkSession, d: str) -> DataFrame:
    """An id over the sorted members of each title's group of two or more, however large."""
    x = _items(spark, d).select("ingest_seq", text.title_key(text.missing_as_empty(F.col("title"))).alias("title_key")).filter("title_key <> ''")
    return events.member_ids(x, "title_key", "ingest_seq")


@query("""SELECT section, ingest_seq, place FROM (SELECT section, ingest_seq, row_number() OVER (PARTITION BY section ORDER BY CASE WHEN rank_position > 0 THEN rank_position ELSE 9999 END, fetched_at DESC, ingest_seq) AS place
          FROM raw_items WHERE section <> '') t WHERE place <= 15""")
def section_report(spark: SparkSession, d: str) -> DataFrame:
    rank = F.when(F.col("rank_position") > 0, F.col("rank_position")).otherwise(9999)
    x = _items(spark, d).filter("section <> ''").select("section", "ingest_seq", "fetched_at", rank.alias("r"))
    return rel.capped(x, [F.col("section")], [F.col("r"), F.desc("fetched_at"), F.col("ingest_seq")], 15).select("section", "ingest_seq", "place")


@query("""WITH x AS (SELECT c.source_group, r.ingest_seq, r.fetched_at, count(*) OVER (PARTITION BY c.source_group) AS total FROM raw_items r JOIN source_catalog c ON r.source_id = c.id WHERE r.title <> '' AND r.source_url <> '')
          SELECT source_group, ingest_seq, total FROM x QUALIFY row_number() OVER (PARTITION BY source_group ORDER BY fetched_at DESC, ingest_seq) <= 8""")
def group_digest(spark: SparkSession, d: str) -> DataFrame:
    """The latest eight items of each group of sources, with the size of the whole group."""
    c = table(spark, d, "source_catalog").select(F.col("id").alias("source_id"), "source_group")
    x = _items(spark, d).filter("title <> '' and source_url <> ''").select("source_id", "ingest_seq", "fetched_at").join(c, "source_id")
    total = x.groupBy("source_group").agg(F.count("*").alias("total"))
    top = rel.capped(x, [F.col("source_group")], [F.desc("fetched_at"), F.col("ingest_seq")], 8)
    return top.join(total, "source_group").select("source_group", "ingest_seq", "total")


@query("""SELECT ingest_seq, len(list_filter(string_split(body_text, chr(10)), lambda x: trim(x) <> '' AND NOT regexp_matches(x, '(?i)cookie|all rights reserved'))) AS n FROM raw_items WHERE body_text <> ''""")
def filtered_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    x = _items(spark, d).filter("body_text <> ''").select("ingest_seq", "source_id", F.filter(F.split("body_text", "\n"), lambda p: F.trim(p) != "").alias("p"))
    return x.select("ingest_seq", F.size(pages.filtered_paragraphs(F.col("p"), F.col("source_id"), {}, "cookie|all rights reserved")).cast("bigint").alias("n"))


@query(f"""WITH {_NODES}, {_SIMILAR} SELECT a, b, similarity = 1 OR NOT (same AND similarity < 0.8) AS merges, CASE WHEN similarity = 1 THEN 'same title' WHEN same AND similarity < 0.8 THEN 'same source needs more' ELSE 'similar' END AS reason,
          CASE WHEN similarity = 1 THEN 1.0 WHEN same AND similarity < 0.8 THEN 0.0 ELSE similarity END::DOUBLE AS confidence
          FROM (SELECT sim.*, coalesce(p.source_id = q.source_id, false) AS same FROM sim JOIN raw_items p ON sim.a = p.ingest_seq JOIN raw_items q ON sim.b = q.ingest_seq) s""")
def pair_decisions(spark: SparkSession, d: str) -> DataFrame:
    """Similar titles with the first rule that decides them."""
    t = _items(spark, d).select("ingest_seq", "source_id")
    pairs = _similar(spark, d).join(t.select(F.col("ingest_seq").alias("a"), F.col("source_id").alias("sa")), "a").join(t.select(F.col("ingest_seq").alias("b"), F.col("source_id").alias("sb")), "b")
    same = F.col("sa") == F.col("sb")
    pairs = pairs.withColumn("similarity", F.round("similarity", 6))
    rules_ = [("same title", F.col("similarity") == 1, True, 1.0), ("same source needs more", same & (F.col("similarity") < 0.8), False, 0.0), ("similar", F.lit(True), True, F.col("similarity"))]
    return rel.decided(pairs, rules_).select("a", "b", "merges", "reason", "confidence")


@query("""WITH s AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS opens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
          n AS (SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM s),
          g AS (SELECT user_id, k, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS e, count(*) AS n FROM n GROUP BY 1, 2)
          SELECT user_id, start, n FROM g WHERE e <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    """User sessions of the event stream that the watermark has closed."""
    s = stream.read_stream(spark, f"{d}/events.parquet").select("user_id", F.col("ts").cast("timestamp").alias("at"))
    out = stream.run_to_end(stream.session_counts(s, "at", ["user_id"], "30 minutes", "10 minutes"), "sessions")
    return out.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n")

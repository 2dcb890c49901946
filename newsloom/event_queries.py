"""Queries that score, choose and group reports, and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import text, times
from newsloom.operators import events, scoring, stories, timestamps
from newsloom.operators import relational as rel
from newsloom.plans import packs, rules
from newsloom.queries import _BUCKETS, _KEY, _MEMBERS, _NODES, _URL, _hits_sql, _items, _url, first_fit_sql, query
from newsloom.runtime import pin_table, table
from newsloom.sources import pages


def _case(x: str, points: dict, otherwise) -> str:
    return f"CASE {x} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in points.items()) + f" ELSE {otherwise} END"


# --- scores of items --------------------------------------------------------------------------

_PLATFORM = f"""least(25.0, {_case("coalesce(c.tier, 'T2')", packs.TIER_POINTS, 6.0)} + {_case("coalesce(c.source_group, 'media')", packs.GROUP_POINTS, 3.0)}
            + {_case("coalesce(c.role, 'discovery_and_context')", packs.ROLE_POINTS, 1.5)})::DOUBLE"""
_PLACE = "CASE WHEN coalesce(p, 0) <= 0 THEN 6.0 WHEN p = 1 THEN 15.0 WHEN p <= 3 THEN 13.0 WHEN p <= 5 THEN 11.0 WHEN p <= 10 THEN 8.0 WHEN p <= 20 THEN 5.0 ELSE 3.0 END"
_LIST = """CASE WHEN s = '' THEN 2.0 WHEN s IN ('homepage_top', 'news_homepage', 'business_homepage', 'technology_homepage', 'top_headlines') THEN 10.0
            WHEN s IN ('homepage_rank_proxy', 'important_flash', 'headline', 'hot_article', 'latest') THEN 8.0 WHEN s IN ('most_popular', 'hotrank', 'hot_rank', 'trending') THEN 6.0
            WHEN contains(s, 'homepage') OR contains(s, 'top') THEN 8.0 WHEN contains(s, 'hot') OR contains(s, 'popular') OR contains(s, 'trend') THEN 6.0 ELSE 4.0 END"""


def _platform(spark: SparkSession, d: str, items: DataFrame) -> DataFrame:
    """Adds platform_score, tier, source_group and role, with defaults for sources the catalog does not have."""
    x = rel.lookup(items, table(spark, d, "source_catalog"), "source_id", "id", packs.MISSING_SOURCE)
    points = (
        scoring.by_name(F.col("tier"), packs.TIER_POINTS, packs.OTHER_TIER)
        + scoring.by_name(F.col("source_group"), packs.GROUP_POINTS, packs.OTHER_GROUP)
        + scoring.by_name(F.col("role"), packs.ROLE_POINTS, packs.OTHER_ROLE)
    )
    return x.withColumn("platform_score", F.least(F.lit(packs.MOST_POINTS), points))


def _rank_points() -> F.Column:
    rank = F.when(F.col("rank_position") > 0, F.col("rank_position"))
    place = scoring.by_step(rank, packs.PLACE_STEPS, packs.PLACE_BEYOND, packs.UNRANKED)
    return F.least(F.lit(packs.MOST_POINTS), place + scoring.by_label(F.col("rank_section"), packs.LIST_NAMES, packs.LIST_PARTS, packs.LIST_BLANK, packs.LIST_OTHER))


@query(f"SELECT r.ingest_seq, {_PLATFORM} AS platform_score FROM raw_items r LEFT JOIN source_catalog c ON r.source_id = c.id")
def platform_scores(spark: SparkSession, d: str) -> DataFrame:
    """Points of each item's source by its tier, group and role."""
    return _platform(spark, d, _items(spark, d).select("ingest_seq", "source_id")).select("ingest_seq", "platform_score")


@query(f"""WITH l AS (SELECT lower(trim(source_id)) AS sid, lower(trim(title)) AS t, max(ingest_seq) AS q FROM raw_items WHERE trim(coalesce(source_id, '')) <> '' AND trim(coalesce(title, '')) <> '' GROUP BY 1, 2),
          m AS (SELECT l.sid, l.t, r.rank_position AS p, lower(trim(coalesce(r.rank_section, ''))) AS s FROM l JOIN raw_items r ON r.ingest_seq = l.q)
          SELECT r.ingest_seq, least(25.0, CASE WHEN m.sid IS NULL THEN 6.0 ELSE {_PLACE} END + CASE WHEN m.sid IS NULL THEN 2.0 ELSE {_LIST} END)::DOUBLE AS rank_score
          FROM raw_items r LEFT JOIN m ON lower(trim(r.source_id)) = m.sid AND lower(trim(r.title)) = m.t""")
def rank_scores(spark: SparkSession, d: str) -> DataFrame:
    """Points of each item's place in a ranking; of equal titles of a source the last delivery's place holds for all."""
    key = [F.lower(F.trim(F.col("source_id"))).alias("k"), F.lower(F.trim(F.col("title"))).alias("t")]
    x = _items(spark, d).select("ingest_seq", *key, "rank_position", "rank_section")
    meta = rel.last_wins(x.filter("k <> '' and t <> ''"), [F.col("k"), F.col("t")], [F.col("ingest_seq")]).select("k", "t", _rank_points().alias("rank_score"))
    return x.select("ingest_seq", "k", "t").join(meta, ["k", "t"], "left").select("ingest_seq", F.coalesce("rank_score", F.lit(packs.UNRANKED + packs.LIST_BLANK)).alias("rank_score"))


_LINKED = f"""n AS (SELECT ingest_seq, {_URL} AS u, trim(regexp_replace({_KEY}, '[^a-z0-9\\x{{4e00}}-\\x{{9fff}} ]', '', 'g')) AS k FROM raw_items),
          hub AS (SELECT a.ingest_seq AS s, min(b.ingest_seq) AS t FROM n a JOIN n b ON a.u = b.u AND a.u <> '' GROUP BY 1 UNION ALL SELECT a.ingest_seq, min(b.ingest_seq) FROM n a JOIN n b ON a.k = b.k AND a.k <> '' GROUP BY 1),
          e AS (SELECT s, t FROM hub UNION SELECT t, s FROM hub),
          c(id, g) AS (SELECT ingest_seq, ingest_seq FROM n UNION SELECT e.t, c.g FROM c JOIN e ON e.s = c.id),
          lg AS (SELECT id AS ingest_seq, min(g) AS group_id FROM c GROUP BY 1)"""


def _groups(spark: SparkSession, d: str) -> DataFrame:
    x = _items(spark, d).select("ingest_seq", _url().alias("u"), text.title_key(text.missing_as_empty(F.col("title"))).alias("k"))
    return events.linked_groups(x, "ingest_seq", [F.col("u"), F.col("k")])


@query(f"""WITH RECURSIVE {_LINKED},
          v AS (SELECT lg.group_id, r.ingest_seq, {_PLATFORM} AS pl, least(25.0, (SELECT {_PLACE} FROM (SELECT r.rank_position AS p)) + (SELECT {_LIST} FROM (SELECT lower(trim(coalesce(r.rank_section, ''))) AS s)))::DOUBLE AS rk
                FROM lg JOIN raw_items r USING (ingest_seq) LEFT JOIN source_catalog c ON r.source_id = c.id)
          SELECT group_id, max(pl) AS platform_score, arg_min(ingest_seq, (-pl, ingest_seq)) AS platform_from, max(rk) AS rank_score, arg_min(ingest_seq, (-rk, ingest_seq)) AS rank_from, max(pl) + max(rk) AS total FROM v GROUP BY 1""")
def event_scores(spark: SparkSession, d: str) -> DataFrame:
    """Per group of linked items the best source and the best place, each with the first item that has it."""
    x = _platform(spark, d, _items(spark, d).select("ingest_seq", "source_id", "rank_position", "rank_section")).withColumn("rank_score", _rank_points())
    best = scoring.best_of_groups(x.join(_groups(spark, d), "ingest_seq"), "group_id", "ingest_seq", [], ["platform_score", "rank_score"])
    return best.select("group_id", "platform_score", F.col("platform_score_from").alias("platform_from"), "rank_score", F.col("rank_score_from").alias("rank_from"), (F.col("platform_score") + F.col("rank_score")).alias("total"))


_DIMENSIONS = {"energy": 0.5, "finance": 0.3, "policy": 0.2}
_TEXT = "lower(coalesce(title,'')||' '||coalesce(summary,''))"
_AGE = "CASE WHEN h <= 6 THEN 4.0 WHEN h <= 24 THEN 2.0 WHEN h <= 48 THEN -3.0 ELSE -8.0 END"
_SCORED = f"""t AS (SELECT r.ingest_seq, r.source_id, {_TEXT} AS x, {_PLATFORM} AS pl, coalesce(c.tier, 'T2') AS tier, coalesce(greatest(0, floor(epoch(g.generated_at - r.fetched_at) / 3600))::INT, 999) AS h
                FROM raw_items r LEFT JOIN source_catalog c ON r.source_id = c.id LEFT JOIN ingest_runs g ON r.run_id = g.run_id),
          b AS (SELECT *, {', '.join(f'({_hits_sql(v)}) AS {k}' for k, v in _BUCKETS.items())} FROM t),
          w AS (SELECT *, 30.0 + {' + '.join(f'{k} * 12.0 * {v}' for k, v in _DIMENSIONS.items())} + pl + {_AGE} AS raw FROM b),
          sc AS (SELECT *, greatest(0, least(100, round_even(CASE WHEN raw > 88 THEN 88 + (raw - 88) * 0.5 ELSE raw END, 0)::INT)) AS score FROM w)"""


def _scored(spark: SparkSession, d: str) -> DataFrame:
    """(ingest_seq, tier, score): dimensions from keyword hits by weight, the source's points and the age before the run."""
    x = _items(spark, d).select("ingest_seq", "source_id", "run_id", "fetched_at", F.concat(text.missing_as_empty(F.col("title")), F.lit(" "), text.missing_as_empty(F.col("summary"))).alias("x"))
    x = x.join(table(spark, d, "ingest_runs").select("run_id", "generated_at"), "run_id", "left")
    hours = times.hours_before(F.col("fetched_at").cast("timestamp"), F.col("generated_at").cast("timestamp"))
    x = _platform(spark, d, x.select("ingest_seq", "source_id", hours.alias("h"), *[text.keyword_hits(F.col("x"), v).alias(k) for k, v in _BUCKETS.items()]))
    raw = F.lit(30.0) + rules.weighted({k: 12.0 * w for k, w in _DIMENSIONS.items()}) + F.col("platform_score") + scoring.by_step(F.col("h"), packs.RECENCY_STEPS, packs.RECENCY_BEYOND, packs.RECENCY_BEYOND)
    return x.select("ingest_seq", "tier", rules.soft_capped(raw, packs.KNEE, packs.SLOPE).alias("score"))


@query(f"WITH {_SCORED} SELECT ingest_seq, score FROM sc")
def item_scores(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("ingest_seq", "score")


_THRESHOLDS = {"energy": 58, "finance": 56, "policy": 55, "other": 53}
_DELTA = {"T1": -2, "T1_5": 0, "T2": 5}
_CAPS = {"energy": 5, "finance": 6, "policy": 5, "other": 4}
_BUCKET = f"""SELECT ingest_seq, CASE WHEN greatest(e, f, p) = 0 THEN 'other' WHEN e = greatest(e, f, p) THEN 'energy' WHEN f = greatest(e, f, p) THEN 'finance' ELSE 'policy' END AS bucket
          FROM (SELECT ingest_seq, {_hits_sql(_BUCKETS['energy'])} AS e, {_hits_sql(_BUCKETS['finance'])} AS f, {_hits_sql(_BUCKETS['policy'])} AS p FROM (SELECT ingest_seq, {_TEXT} AS x FROM raw_items) t) u"""
_ADJUSTED = f"""WITH RECURSIVE {_LINKED}, {_SCORED}, bk AS ({_BUCKET}),
          m AS (SELECT lg.group_id, sc.ingest_seq, sc.score, sc.tier, bk.bucket, row_number() OVER (PARTITION BY lg.group_id ORDER BY sc.score DESC, sc.ingest_seq) AS place FROM lg JOIN sc USING (ingest_seq) JOIN bk USING (ingest_seq)),
          adj AS (SELECT *, CASE WHEN place = 1 THEN least(100, score + 4) ELSE greatest(0, score - 12) END AS final FROM m)"""


def _adjusted(spark: SparkSession, d: str) -> DataFrame:
    """Scores after grouping: the main report of each group gains, the others lose."""
    plain = rules.RulePack(buckets=_BUCKETS, default="other")
    bucket = rules.classified(_items(spark, d), "ingest_seq", ["title", "summary"], "source_id", "section", plain).select("ingest_seq", "bucket")
    x = _scored(spark, d).join(_groups(spark, d), "ingest_seq").join(bucket, "ingest_seq")
    main = scoring.best_of_groups(x, "group_id", "ingest_seq", [], ["score"]).select("group_id", F.col("score_from").alias("main_id"))
    x = x.join(main, "group_id").withColumn("is_main", F.col("ingest_seq") == F.col("main_id"))
    final = F.when(F.col("is_main"), F.least(F.lit(100), F.col("score") + packs.MAIN_BONUS)).otherwise(F.greatest(F.lit(0), F.col("score") + packs.RELATED_BONUS))
    return x.withColumn("final", final)


@query(f"{_ADJUSTED} SELECT ingest_seq, group_id, place = 1 AS is_main, final FROM adj")
def adjusted_scores(spark: SparkSession, d: str) -> DataFrame:
    return _adjusted(spark, d).select("ingest_seq", "group_id", "is_main", "final")


@query(f"""{_ADJUSTED}, ok AS (SELECT * FROM adj WHERE place = 1 AND final >= {_case('bucket', _THRESHOLDS, 65)} + {_case('tier', _DELTA, 0)} - 2),
          k AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY final DESC, ingest_seq) AS n FROM ok)
          SELECT ingest_seq, bucket, final, row_number() OVER (ORDER BY final DESC, ingest_seq) AS place FROM k WHERE n <= {_case('bucket', _CAPS, 99)} QUALIFY place <= 30""")
def selected_items(spark: SparkSession, d: str) -> DataFrame:
    """The main reports that reach their threshold, up to each bucket's cap, the thirty best."""
    main = _adjusted(spark, d).filter("is_main").select("ingest_seq", "bucket", "tier", "final")
    threshold = scoring.by_name(F.col("bucket"), _THRESHOLDS, 65) + scoring.by_name(F.col("tier"), _DELTA, 0) - 2
    return scoring.chosen(main, "final", threshold, F.col("bucket"), [F.col("ingest_seq")], _CAPS, 99, 30).select("ingest_seq", "bucket", "final", "place")


# --- signals and sections ---------------------------------------------------------------------

_SURFACE = "CASE " + " ".join(f"WHEN contains(x, '{k}') THEN '{k}'" for k in packs.SURFACE_WEIGHTS) + " WHEN coalesce(p, 0) <> 0 THEN 'ranked_list' ELSE 'feed' END"
_SIGNALS = f"""sg AS (SELECT r.ingest_seq, r.source_id, coalesce(c.tier, 'T2') AS tier, c.source_group AS grp, r.rank_position AS p, lower(coalesce(discovery_method,'')||' '||coalesce(rank_section,'')||' '||coalesce(section,'')) AS x,
                (epoch_us(g.generated_at) - epoch_us(r.fetched_at)) / 3600000000 AS h FROM raw_items r LEFT JOIN source_catalog c ON r.source_id = c.id LEFT JOIN ingest_runs g ON r.run_id = g.run_id),
          sf AS (SELECT *, {_SURFACE} AS surface FROM sg),
          si AS (SELECT *, floor(least(1.0::DOUBLE, {_case('tier', packs.TIER_WEIGHTS, 0.9)}::DOUBLE * {_case('surface', packs.SURFACE_WEIGHTS, 0.7)}::DOUBLE * CASE WHEN p > 0 THEN greatest(0.15::DOUBLE, 1.0::DOUBLE - (p - 1) * 0.075::DOUBLE) ELSE 0.55::DOUBLE END / 1.2::DOUBLE) * 1000 + 0.5) / 1000 AS signal,
                coalesce(floor(greatest(0.05::DOUBLE, 1.0::DOUBLE - greatest(0.0::DOUBLE, h) / 36.0::DOUBLE) * 1000 + 0.5) / 1000, 0.35) AS fresh FROM sf)"""


def _signals(spark: SparkSession, d: str) -> DataFrame:
    """(ingest_seq, source_id, tier, surface, signal, fresh): where an item was found and how high, and its age at the time of its run."""
    x = _items(spark, d).select("ingest_seq", "source_id", "run_id", "fetched_at", "rank_position", "section", "rank_section", "discovery_method", "summary")
    x = x.join(table(spark, d, "ingest_runs").select("run_id", "generated_at"), "run_id", "left")
    x = rel.lookup(x, table(spark, d, "source_catalog").select("id", "tier", "source_group"), "source_id", "id", {"tier": "T2"}).join(table(spark, d, "source_catalog").select(F.col("id").alias("source_id"), "source_group"), "source_id", "left")
    e, p = text.missing_as_empty, F.col("rank_position")
    found = F.concat(e(F.col("discovery_method")), F.lit(" "), e(F.col("rank_section")), F.lit(" "), e(F.col("section")))
    x = x.withColumn("surface", F.explode(F.array(scoring.first_part(found, packs.SURFACE_WEIGHTS, F.when(F.coalesce(p, F.lit(0)) != 0, "ranked_list").otherwise("feed")))))
    place = F.when(p > 0, F.greatest(F.lit(packs.LEAST_PLACE), 1.0 - (p - 1) * packs.PLACE_LOSS)).otherwise(packs.UNRANKED_PLACE)
    weight = scoring.by_name(F.col("tier"), packs.TIER_WEIGHTS, packs.OTHER_TIER_WEIGHT) * scoring.by_name(F.col("surface"), packs.SURFACE_WEIGHTS, packs.OTHER_SURFACE_WEIGHT)
    hours = (timestamps.utc_micros(x, "generated_at") - timestamps.utc_micros(x, "fetched_at")) / 3_600_000_000
    fresh = F.greatest(F.lit(packs.LEAST_FRESH), 1.0 - F.greatest(F.lit(0.0), hours) / packs.FRESH_HOURS)
    return x.select(
        "ingest_seq", "source_id", "tier", "source_group", "rank_position", "summary", "surface",
        scoring.thousandths(F.least(F.lit(1.0), weight * place / packs.SIGNAL_SCALE)).alias("signal"),
        F.coalesce(F.when(hours.isNotNull(), scoring.thousandths(fresh)), F.lit(packs.UNKNOWN_FRESH)).alias("fresh"),
    )


@query(f"WITH {_SIGNALS} SELECT ingest_seq, surface, signal, fresh FROM si")
def rank_signals(spark: SparkSession, d: str) -> DataFrame:
    return _signals(spark, d).select("ingest_seq", "surface", "signal", "fresh")


_EVENTS = f"""WITH RECURSIVE {_LINKED}, {_SIGNALS},
          mm AS (SELECT lg.group_id, si.*, length(coalesce(r.summary, '')) AS len FROM lg JOIN si USING (ingest_seq) JOIN raw_items r USING (ingest_seq)),
          ev AS (SELECT group_id, count(*) AS n_items, count(DISTINCT source_id) AS n_sources, max(signal) AS signal, max(fresh) AS fresh,
                arg_min(ingest_seq, ({_case('tier', packs.TIER_ORDER, 9)}, {_case("coalesce(grp, '')", packs.GROUP_ORDER, 8)}, CASE WHEN coalesce(p, 0) = 0 THEN 9999 ELSE p END, -signal, -fresh, -len, ingest_seq)) AS main_id,
                arg_min(tier, ({_case('tier', packs.TIER_ORDER, 9)}, {_case("coalesce(grp, '')", packs.GROUP_ORDER, 8)}, CASE WHEN coalesce(p, 0) = 0 THEN 9999 ELSE p END, -signal, -fresh, -len, ingest_seq)) AS main_tier FROM mm GROUP BY 1)"""


@query(f"""{_EVENTS} SELECT group_id, main_id, n_items, n_sources, floor(greatest(0.0::DOUBLE, least(1.0::DOUBLE, signal * 0.38::DOUBLE + fresh * 0.22::DOUBLE + least(0.25::DOUBLE, (n_sources - 1) * 0.06::DOUBLE) + least(0.12::DOUBLE, (n_items - 1) * 0.03::DOUBLE)
          + {_case('main_tier', packs.TIER_BONUS, 0.0)}::DOUBLE)) * 1000 + 0.5) / 1000 AS score FROM ev""")
def section_scores(spark: SparkSession, d: str) -> DataFrame:
    """Per group of linked items its main report (tier, group, place, signal, freshness, longest summary) and its score in a section."""
    x = _signals(spark, d).join(_groups(spark, d), "ingest_seq")
    place = F.when(F.coalesce("rank_position", F.lit(0)) == 0, 9999).otherwise(F.col("rank_position"))
    order = F.struct(
        scoring.by_name(F.col("tier"), packs.TIER_ORDER, packs.OTHER_TIER_ORDER).alias("a"), scoring.by_name(F.col("source_group"), packs.GROUP_ORDER, packs.OTHER_GROUP_ORDER).alias("b"), place.alias("c"),
        (-F.col("signal")).alias("d"), (-F.col("fresh")).alias("e"), (-F.length(text.missing_as_empty(F.col("summary")))).alias("f"), "ingest_seq",
    )
    g = x.groupBy("group_id").agg(F.min_by(F.struct("ingest_seq", "tier"), order).alias("m"), F.count("*").alias("n_items"), F.count_distinct("source_id").alias("n_sources"), F.max("signal").alias("signal"), F.max("fresh").alias("fresh"))
    score = (
        F.col("signal") * packs.SIGNAL_SHARE + F.col("fresh") * packs.FRESH_SHARE + F.least(F.lit(packs.SOURCE_BONUS_MOST), (F.col("n_sources") - 1) * packs.SOURCE_BONUS)
        + F.least(F.lit(packs.ITEM_BONUS_MOST), (F.col("n_items") - 1) * packs.ITEM_BONUS) + scoring.by_name(F.col("m.tier"), packs.TIER_BONUS, 0.0)
    )
    return g.select("group_id", F.col("m.ingest_seq").alias("main_id"), "n_items", "n_sources", scoring.thousandths(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))).alias("score"))


_TAGS = {"works": ["tunnel", "harbor", "bridge"], "state": ["senate", "treaty", "tribunal"], "trade": ["market", "lender", "insurer"]}


@query(f"""WITH RECURSIVE {_LINKED}, hh AS (SELECT lg.group_id, {', '.join('(' + ' + '.join(f"regexp_matches(x, '{chr(92)}b{k}{chr(92)}b')::INT" for k in v) + f') AS {t}' for t, v in _TAGS.items())}
            FROM (SELECT ingest_seq, lower(coalesce(title, '')) AS x FROM raw_items) q JOIN lg USING (ingest_seq)),
          tv AS (SELECT group_id, t, sum(CASE WHEN n > 0 THEN floor(least(1.0, 0.35 + 0.18 * n) * 1000 + 0.5)::BIGINT ELSE 0 END)::BIGINT AS score FROM (UNPIVOT hh ON {', '.join(_TAGS)} INTO NAME t VALUE n) u GROUP BY 1, 2)
          SELECT group_id, CASE WHEN max(score) = 0 THEN 'uncategorized' ELSE arg_min(t, (-score, t)) END AS section FROM tv GROUP BY 1""")
def event_sections(spark: SparkSession, d: str) -> DataFrame:
    """The section most soft tags of a group's titles vote for, the lesser name on a tie."""
    x = _items(spark, d).select("ingest_seq", rules.soft_tags(text.missing_as_empty(F.col("title")), _TAGS).alias("tags"))
    groups = _groups(spark, d)
    votes = x.select("ingest_seq", F.explode("tags").alias("t")).select("ingest_seq", F.col("t.tag").alias("tag"), F.round(F.col("t.score") * 1000).cast("long").alias("w"))
    best = rel.voted(votes.join(groups, "ingest_seq"), ["group_id"], "tag", "w")
    return groups.select("group_id").distinct().join(best, "group_id", "left").select("group_id", F.coalesce("tag", F.lit("uncategorized")).alias("section"))


# --- events by a cascade of rules -------------------------------------------------------------

STORIES = stories.StoryRules(
    stop=["a", "an", "and", "as", "at", "by", "for", "from", "in", "into", "of", "on", "the", "to", "with", "its"],
    generic=["another", "every", "its", "one", "trust", "holdings"],
    anchors=["treaty", "reactor", "refinery", "ballot", "ferry"],
    broad=["ballot", "energy", "motors"],
    families={"build": ["opened", "reopened", "upgraded"], "stop": ["halted", "blocked", "rejected"], "ask": ["questioned", "sued", "probed"]},
    shared=["sued", "treaty", "halted"],
    roundups=["morning overview", "live updates"],
)


def _stories(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(features, nodes, members) of the reports; nodes know the report before them, so features are shuffled only to meet their nodes and their cells."""
    title, g = text.missing_as_empty(F.col("title")), text.missing_as_empty(F.col("section"))
    keyed = _items(spark, d).select("ingest_seq", title.alias("title"), g.alias("section"), "fetched_at", F.xxhash64(g).alias("gh"), stories.event_key(text.word_array(title, 2, STORIES.stop)).alias("key"))
    nodes, members = events.title_spans(keyed, "ingest_seq", "title", "section", "fetched_at", 36, ["gh", "key"])
    nodes = pin_table(stories.followed(nodes, STORIES.hours).select("node", "t0", "t1", "before"))
    x = _items(spark, d).select(F.col("ingest_seq").alias("node"), g.alias("g"), "title", "summary", F.col("source_id").alias("source"))
    catalog = table(spark, d, "source_catalog").select(F.col("id").alias("source"), "source_group")
    f = stories.features(nodes.join(x, "node").join(catalog, "source", "left"), "title", "summary", STORIES).drop("title", "summary")
    return f, nodes, members


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]::VARCHAR[]"


_W = "list_distinct(list_filter(string_split(trim(regexp_replace(lower({0}), '[^a-z0-9\\x{{4e00}}-\\x{{9fff}}]+', ' ', 'g')), ' '), lambda w: length(w) >= 2 AND NOT list_contains(" + _list(STORIES.stop) + ", w)))"
_ACTIONS = ", ".join(f"CASE WHEN list_has_any(tw, {_list(v)}) THEN '{k}' END" for k, v in STORIES.families.items())


_CASCADE = f"""{_NODES},
          f0 AS (SELECT n.node, n.g, n.t0, n.t1, r.source_id AS src, c.source_group AS grp, coalesce(r.title,'') AS ti, coalesce(r.title,'')||' '||coalesce(r.summary,'') AS bo FROM n JOIN raw_items r ON r.ingest_seq = n.node LEFT JOIN source_catalog c ON r.source_id = c.id),
          f1 AS (SELECT *, {_W.format('bo')} AS ws, list_filter(regexp_split_to_array(trim(regexp_replace(lower(ti), '[^a-z0-9\\x{{4e00}}-\\x{{9fff}}]+', ' ', 'g')), ' '), lambda w: length(w) >= 2 AND NOT list_contains({_list(STORIES.stop)}, w)) AS tw,
                list_distinct(list_filter(list_transform(list_filter(regexp_split_to_array(bo, '[^\\p{{L}}\\p{{N}}&.\\-]+'), lambda w: regexp_full_match(w, '[A-Z][A-Za-z0-9&.\\-]+')), lambda w: trim(regexp_replace(lower(w), '[^a-z0-9]+', ' ', 'g'))), lambda w: w <> '' AND NOT list_contains({_list([*STORIES.stop, *STORIES.generic])}, w))) AS na FROM f0),
          f2 AS (SELECT *, list_distinct(list_concat(list_intersect(ws, {_list(STORIES.anchors)}), list_filter(na, lambda w: length(w) >= 3))) AS an, list_filter([{_ACTIONS}], lambda v: v IS NOT NULL) AS ac,
                (regexp_matches(trim(regexp_replace(lower(ti), '[^a-z0-9\\x{{4e00}}-\\x{{9fff}}]+', ' ', 'g')), '{'|'.join(STORIES.roundups)}')) AS ro,
                coalesce(nullif(array_to_string(list_filter(tw, lambda w, i: i = list_position(tw, w))[1:6], '-'), ''), 'misc-event') AS ky FROM f1),
          fl AS (SELECT node, lag(node) OVER w AS b4, t0 - lag(t1) OVER w AS dt FROM f2 WINDOW w AS (PARTITION BY g, ky ORDER BY t0, node)),
          ch AS (SELECT least(node, b4) AS a, greatest(node, b4) AS b FROM fl WHERE dt <= 36 * 3600000000),
          uw AS (SELECT node, g, unnest(ws) AS x FROM f2),
          pw AS (SELECT DISTINCT p.node AS a, q.node AS b FROM uw p JOIN uw q ON p.x = q.x AND p.g = q.g AND p.node < q.node),
          cp AS (SELECT p.node AS a, q.node AS b, len(list_intersect(p.ws, q.ws)) AS sw, len(list_intersect(p.ws, q.ws)) / len(list_distinct(list_concat(p.ws, q.ws))) AS sim, len(list_intersect(p.na, q.na)) AS nm, len(list_intersect(p.an, q.an)) AS ao,
                len(list_filter(list_intersect(p.an, q.an), lambda w: NOT list_contains({_list(STORIES.broad)}, w))) AS fm, len(p.an) > 0 AND len(q.an) > 0 AS bt, len(list_intersect(p.ac, q.ac)) AS act, greatest(0, q.t0 - p.t1, p.t0 - q.t1) / 3600000000 AS gap,
                p.ky = q.ky AS sk, coalesce(p.src = q.src, false) AND (p.ro OR q.ro) AS rg, list_has_any(list_intersect(p.ws, q.ws), {_list(STORIES.shared)}) AS sh, p.grp IS NOT DISTINCT FROM q.grp AS fam, ch.a IS NOT NULL AS fo
                FROM pw JOIN f2 p ON pw.a = p.node JOIN f2 q ON pw.b = q.node LEFT JOIN ch ON ch.a = pw.a AND ch.b = pw.b),
          ok AS (SELECT *, bt AND fm >= 2 AND sw >= 3 AND gap <= 24 AS firmly FROM cp WHERE gap <= 36 AND (sim >= 0.2 - 1e-9 OR fm >= 2 OR fo)),
          de AS (SELECT *, CASE WHEN sk THEN 'same_event_key' WHEN rg AND sim < 0.45 THEN 'generic_roundup_guard' WHEN bt AND ao = 0 AND sim < 0.55 THEN 'distinct_anchor_sets' WHEN bt AND ao > 0 AND fm = 0 AND sim < 0.2 AND NOT sh THEN 'broad_anchor_only'
                WHEN firmly AND sim < 0.18 AND act = 0 THEN 'meaningful_anchor_without_action' WHEN firmly THEN 'meaningful_anchor_overlap' WHEN sim >= 0.6 THEN 'high_token_similarity' WHEN sw >= 5 AND sim >= 0.25 AND gap <= 12 THEN 'shared_tokens_recent'
                WHEN nm >= 2 AND sim >= 0.28 THEN 'entity_overlap' WHEN nm >= 1 AND sim >= 0.42 THEN 'entity_similarity_overlap' WHEN nm >= 2 AND sw >= 5 AND sim >= 0.2 AND gap <= 12 THEN 'entities_and_recent_tokens' WHEN fam AND sim >= 0.5 THEN 'same_source_family_similarity' ELSE 'insufficient_overlap' END AS reason FROM ok)"""
_REFUSED = "('generic_roundup_guard', 'distinct_anchor_sets', 'broad_anchor_only', 'meaningful_anchor_without_action', 'insufficient_overlap')"


@query(f"""WITH {_CASCADE}
          SELECT a, b, reason NOT IN {_REFUSED} AS merges, reason,
          floor(CASE reason WHEN 'same_event_key' THEN 1.0 WHEN 'meaningful_anchor_overlap' THEN least(0.92::DOUBLE, 0.62::DOUBLE + sim + fm * 0.04::DOUBLE) WHEN 'high_token_similarity' THEN sim WHEN 'same_source_family_similarity' THEN sim
            WHEN 'shared_tokens_recent' THEN least(0.86::DOUBLE, 0.48::DOUBLE + sim + sw * 0.025::DOUBLE) WHEN 'entity_overlap' THEN least(0.9::DOUBLE, 0.55::DOUBLE + sim + nm * 0.04::DOUBLE) WHEN 'entity_similarity_overlap' THEN least(0.86::DOUBLE, 0.52::DOUBLE + sim + nm * 0.04::DOUBLE)
            WHEN 'entities_and_recent_tokens' THEN least(0.84::DOUBLE, 0.5::DOUBLE + sim + nm * 0.04::DOUBLE) ELSE 0.0 END * 1000 + 0.5) / 1000 AS confidence FROM de""")
def story_decisions(spark: SparkSession, d: str) -> DataFrame:
    """The rule that decides each pair of reports of a section."""
    return stories.decisions(_stories(spark, d)[0], STORIES)


@query(f"""WITH RECURSIVE {_CASCADE}, {_MEMBERS}, me AS (SELECT a, b FROM de WHERE reason NOT IN {_REFUSED}), {first_fit_sql('n', 'me', '-t1, node')} SELECT zm.ingest_seq, ff.bucket FROM zm JOIN ff USING (node)""")
def story_events(spark: SparkSession, d: str) -> DataFrame:
    """Events by the cascade: each report, the newest first, joins the oldest event that holds one it merges with."""
    f, nodes, members = _stories(spark, d)
    merged = stories.decisions(f, STORIES).filter("merges")
    found = events.first_fit(nodes.select("node", "t1"), merged, "node", [(-F.col("t1")).alias("age")])
    return members.join(found, "node").select(F.col("id").alias("ingest_seq"), "bucket")


@query(f"""WITH {_CASCADE}, {_MEMBERS}, me AS (SELECT a, b, reason FROM de WHERE reason NOT IN {_REFUSED}), bo AS (SELECT a AS node, reason FROM me UNION ALL SELECT b, reason FROM me)
          SELECT node, reason, count(*) AS n FROM bo GROUP BY 1, 2""")
def story_reasons(spark: SparkSession, d: str) -> DataFrame:
    """By which rules each report merges with others, and how often."""
    merged = stories.decisions(_stories(spark, d)[0], STORIES).filter("merges")
    return merged.select(F.explode(F.array("a", "b")).alias("node"), "reason").groupBy("node", "reason").agg(F.count("*").alias("n"))


# --- candidates and merges of a collection ----------------------------------------------------


@query(r"""WITH t AS (SELECT ingest_seq, regexp_replace(regexp_replace(regexp_replace(coalesce(title,''), 'https?://[^\s]+', ' ', 'g'), '\s+[-–—|]\s+[^-–—|]{2,40}$', ''), '^\s*(?:[-*•]+|[0-9]{1,3}[.)、])\s*', '') AS x,
            regexp_replace(regexp_replace(coalesce(source_url,''), '[?#].*$', ''), '/+$', '') AS u FROM raw_items)
          SELECT ingest_seq, trim(regexp_replace(lower(x), '[^a-z0-9\x{4e00}-\x{9fff}]+', ' ', 'g')) AS plain, lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/]*)', 1)) || substr(u, length(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/]*)', 1)) + 1) AS identity FROM t""")
def plain_forms(spark: SparkSession, d: str) -> DataFrame:
    """Titles and addresses in the forms reports are compared by."""
    e = text.missing_as_empty
    return _items(spark, d).select("ingest_seq", text.plain_title(e(F.col("title"))).alias("plain"), text.page_identity(e(F.col("source_url"))).alias("identity"))


ROUTED = rules.RulePack(
    buckets=_BUCKETS,
    source_boosts=[(["harbor-wire", "quillon-wire"], ["railway", "ferry"], "policy", 2)],
    context=["insurer", "regulator", "treaty"],
    routes=[("energy", ["reactor"], ["tunnel"]), ("finance", ["lender", "bond"], ["vaccine"])],
    priority=[("policy", ["senate", "tribunal"], 1), ("energy", ["pipeline"], 2)],
    default="other",
)


def _any_sql(words) -> str:
    return "(" + " OR ".join(f"({_hits_sql([w])}) > 0" for w in words) + ")"


@query(f"""WITH t AS (SELECT ingest_seq, source_id AS s, {_TEXT} AS x FROM raw_items),
          n AS (SELECT ingest_seq, s, x, {_hits_sql(_BUCKETS['energy'])} AS e, {_hits_sql(_BUCKETS['finance'])} AS f, {_hits_sql(_BUCKETS['policy'])} + CASE WHEN s IN ('harbor-wire', 'quillon-wire') AND {_any_sql(['railway', 'ferry'])} THEN 2 ELSE 0 END AS p,
                2 * ({_hits_sql(['reactor'])}) + {_hits_sql(['tunnel'])} AS re, {_any_sql(['reactor'])} AND {_any_sql(['insurer', 'regulator', 'treaty'])} AS he,
                2 * ({_hits_sql(['lender', 'bond'])}) + {_hits_sql(['vaccine'])} AS rf, {_any_sql(['lender', 'bond'])} AND {_any_sql(['insurer', 'regulator', 'treaty'])} AS hf,
                {_any_sql(['senate', 'tribunal'])} AS wp, {_any_sql(['pipeline'])} AS we FROM t)
          SELECT ingest_seq, CASE WHEN he AND (NOT hf OR re >= rf) THEN 'energy' WHEN hf THEN 'finance' WHEN wp AND p >= 1 THEN 'policy' WHEN we AND e >= 2 THEN 'energy' WHEN greatest(e, f, p) = 0 THEN 'other' WHEN e = greatest(e, f, p) THEN 'energy' WHEN f = greatest(e, f, p) THEN 'finance' ELSE 'policy' END AS bucket,
          CASE WHEN he OR hf THEN 'route' WHEN (wp AND p >= 1) OR (we AND e >= 2) THEN 'priority' WHEN greatest(e, f, p) > 0 THEN 'score' ELSE 'default' END AS decided_by FROM n""")
def routed_items(spark: SparkSession, d: str) -> DataFrame:
    """Classification with routes, priority rules and boosts of sources, and what decided."""
    return rules.classified(_items(spark, d), "ingest_seq", ["title", "summary"], "source_id", "section", ROUTED).select("ingest_seq", "bucket", "decided_by")


@query(f"""WITH RECURSIVE {_LINKED}, e AS (SELECT lg.group_id, ingest_seq, unnest(source_tags) AS t, generate_subscripts(source_tags, 1) AS i FROM raw_items JOIN lg USING (ingest_seq)),
          k AS (SELECT group_id, lower(t) AS k, count(*) AS n, arg_min(t, (ingest_seq, i)) AS entity FROM e WHERE t <> '' GROUP BY 1, 2)
          SELECT group_id, entity, n FROM k QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY n DESC, k) <= 10""".replace('), e AS (SELECT lg', '), en AS (SELECT lg').replace('FROM e WHERE', 'FROM en WHERE'))
def event_entities(spark: SparkSession, d: str) -> DataFrame:
    """The ten commonest tags of each group of linked items, case apart, as first written."""
    each = _items(spark, d).select("ingest_seq", F.posexplode("source_tags").alias("i", "t")).filter("t <> ''").join(_groups(spark, d), "ingest_seq")
    n = each.groupBy("group_id", F.lower("t").alias("k")).agg(F.count("*").alias("n"), F.min_by("t", F.struct("ingest_seq", "i")).alias("entity"))
    return rel.capped(n, [F.col("group_id")], [F.desc("n"), F.asc("k")], 10).select("group_id", "entity", "n")


@query()
def kept_candidates(spark: SparkSession, d: str) -> DataFrame:
    """What each source keeps of its deliveries: no noise, no address kept before, no title twice, up to its limit."""
    e = text.missing_as_empty
    x = _items(spark, d).filter((F.length(e(F.col("title"))) >= 8) & (_url() != "")).select("ingest_seq", "source_id", "title", "published_at", "rank_position", "canonical_url", "source_url")
    limits = table(spark, d, "source_summaries").groupBy(F.col("source_id").alias("source")).agg(F.max("requested_limit").alias("top_k"))
    place = F.when(F.coalesce("rank_position", F.lit(0)) == 0, 9999).otherwise(F.col("rank_position"))
    return stories.kept_candidates(x, limits, "ingest_seq", "source_id", _url(), text.title_key(e(F.col("title"))), [place.alias("p"), e(F.col("published_at")).alias("d")], 20)


@query()
def merge_decisions(spark: SparkSession, d: str) -> DataFrame:
    """The rule that decides each pair of reports with one address, one plain title, similar title words within reach, or anything else that merges them."""
    e = text.missing_as_empty
    tag = F.coalesce(F.get(rules.soft_tags(e(F.col("title")), _TAGS), F.lit(0))["tag"], F.lit(""))
    words = F.transform(text.word_array(F.concat(e(F.col("title")), F.lit(" "), e(F.col("summary"))), 3), lambda w: F.xxhash64(w))
    own = {
        "id": F.col("ingest_seq"), "source": F.col("source_id"), "url": text.page_identity(_url()), "plain": text.plain_title(e(F.col("title"))), "host": text.host(_url()), "tag": tag,
        "names": rules.entities(e(F.col("title"))), "words": F.when(tag != "", words), "at": F.col("fetched_at").cast("timestamp"),  # words count only beside a tag
    }
    x = pin_table(_items(spark, d).select(*(c.alias(n) for n, c in own.items())))
    alike, unlike = stories.met_by_key(x)
    told = unlike.union(_similar_pairs(spark, d)).withColumn("told", F.lit(True))
    pairs = pin_table(told.union(stories.may_merge(x).withColumn("told", F.lit(False))).groupBy("a", "b").agg(F.max("told").alias("told")))
    both = events.with_sides(pairs, x, "id", [n for n in own if n != "id"]).withColumnsRenamed({"p": "l", "q": "r"}).filter("l.plain <> r.plain")
    decided = stories.merges(both).filter("merges or told"), stories.merges(alike, sim=F.lit(1.0))
    return decided[0].select("a", "b", "merges", "reason", "confidence").union(decided[1].select("a", "b", "merges", "reason", "confidence"))


def _similar_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of reports of any section and source whose title words overlap by half within 48 hours, but for those of one plain title."""
    title, t = text.missing_as_empty(F.col("title")), F.unix_micros(F.col("fetched_at").cast("timestamp"))
    x = _items(spark, d).select(F.col("ingest_seq").alias("node"), F.lit("").alias("g"), text.word_array(title, 2).alias("w"), t.alias("t0"), t.alias("t1"), F.xxhash64(text.plain_title(title)).alias("s"))
    return events.similar_nodes(pin_table(x.filter((F.size("w") > 0) & F.col("t0").isNotNull())), 0.5, 48).select("a", "b")

"""Timestamps in many notations and clocks, brought to one instant each."""

from __future__ import annotations

import datetime as dt
import zoneinfo
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Month names in English, German, French, Spanish and Russian; a name also counts from its first three letters on where that is unambiguous.
MONTHS = """
1 january jan january januar jänner janvier janv enero ene января январь янв
2 february feb february februar février fevrier févr fevr febrero февраля февраль фев февр
3 march mar mars märz maerz mrz marzo марта март мар
4 april apr avril avr abril abr апреля апрель апр
5 may mai mayo мая май
6 june jun juni juin junio июня июнь июн
7 july jul juli juillet juil julio июля июль июл
8 august aug août aout agosto ago августа август авг
9 september sept sep septembre septiembre setiembre сентября сентябрь сен сент
10 october oct oktober okt octobre octubre октября октябрь окт
11 november nov novembre noviembre ноября ноябрь ноя нояб
12 december dec dezember dez décembre decembre déc diciembre dic декабря декабрь дек
"""
# Minutes east of UTC of abbreviations, used where the source's own zone does not know one.
ABBREVIATIONS = {"utc": 0, "gmt": 0, "z": 0, "ut": 0, "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420, "cet": 60, "cest": 120, "wet": 0, "west": 60, "eet": 120, "eest": 180, "bst": 60, "ist": 330, "msk": 180, "jst": 540, "kst": 540, "hkt": 480, "aest": 600, "aedt": 660, "acst": 570, "awst": 480, "nzst": 720, "nzdt": 780}

_UTC_NAMES = ("utc", "gmt", "z", "ut")
_TIME = r"(\d{1,2})[:h](\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?"
_OFFSET = r"(Z|z|[+-]\d{2}:?\d{2}|\p{Alpha}{2,5})"
_NAME = r"(\p{L}{3,})\.?"
# Each notation, and its parts in the order: kind|first|second|third|hour|minute|second|fraction|am/pm|offset|zone.
NOTATIONS = [
    (rf"^(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}})(?:(?:[Tt]|,? +){_TIME}(?: ?([AaPp][Mm]))?(?: ?{_OFFSET})?(?:\[([\w/+-]+)\])?)?$", "ymd|$1|$2|$3|$4|$5|$6|$7|$8|$9|$10"),
    (rf"^(\d{{4}})(\d{{2}})(\d{{2}})[Tt](\d{{2}})(\d{{2}})(?:(\d{{2}})(?:[.,](\d{{1,9}}))?)?{_OFFSET}?(?:\[([\w/+-]+)\])?$", "ymd|$1|$2|$3|$4|$5|$6|$7||$8|$9"),
    (r"^(\d{4})年(\d{1,2})月(\d{1,2})日?(?: ?(\d{1,2})[:：时](\d{1,2})(?:[:：分](\d{1,2}))?[分秒]?)?$", "ymd|$1|$2|$3|$4|$5|$6||||"),
    (rf"^(?:\p{{L}}{{2,}}\.?,? )?(\d{{1,2}})\.?(?: de)? {_NAME}(?: de)? (\d{{4}})(?: г\.?)?(?:,?(?: à| um| a las| в| at)? {_TIME}(?: ?([AaPp][Mm]))?(?: Uhr)?(?: ?{_OFFSET})?)?$", "dny|$1|$2|$3|$4|$5|$6|$7|$8|$9|"),
    (rf"^(?:\p{{L}}{{3,}}\.?,? )?{_NAME} (\d{{1,2}})(?:st|nd|rd|th)?,? (\d{{4}})(?:,?(?: at)? {_TIME}(?: ?([AaPp][Mm]))?(?: ?{_OFFSET})?)?$", "ndy|$1|$2|$3|$4|$5|$6|$7|$8|$9|"),
    (rf"^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}})(?:,? {_TIME}(?: ?([AaPp][Mm]))?(?: ?{_OFFSET})?)?$", "order|$1|$2|$3|$4|$5|$6|$7|$8|$9|"),
    (rf"^(\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}})(?:,? (?:um )?{_TIME}(?: Uhr)?(?: ?{_OFFSET})?)?$", "dmy|$1|$2|$3|$4|$5|$6|$7||$8|"),
]


@lru_cache(maxsize=1)
def _zones() -> list[str]:
    return sorted(z for z in zoneinfo.available_timezones() if z not in ("localtime", "Factory"))


@lru_cache(maxsize=1024)
def _abbreviations_of(zone_name: str) -> dict[str, int]:
    zone, seen = zoneinfo.ZoneInfo(zone_name), {}
    for quarter in range(4 * 68):
        at = dt.datetime(1970 + quarter // 4, 1 + quarter % 4 * 3, 15, tzinfo=dt.UTC).astimezone(zone)
        name = (at.tzname() or "").lower()
        if name.isalpha():
            seen[name] = int(at.utcoffset().total_seconds())
    return seen


def zone_abbreviations(spark: SparkSession, zones: list[str]) -> DataFrame:
    """(zone_name, abbr, seconds): the offsets each zone means by its abbreviations, the most recent one if it changed.

    Derived from the zone data, every quarter from 1970 on; a few rows for each of the given zones.
    """
    rows = [(z, a, s) for z in zones for a, s in _abbreviations_of(z).items()]
    return spark.createDataFrame(rows, "zone_name string, abbr string, seconds int")


def _months() -> Column:
    pairs = []
    for line in MONTHS.strip().splitlines():
        number, *names = line.split()
        for n in dict.fromkeys(names):
            pairs += [F.lit(n), F.lit(int(number))]
    return F.create_map(*pairs)


def _int(c: Column) -> Column:
    return c.try_cast("int")


def _settled(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column as a generated one, so that filters on it are not rewritten into copies of its long expression."""
    return df.withColumn(name, F.explode(F.array(value)))


def parse_notation(df: DataFrame, value_col: str, order_col: str) -> DataFrame:
    """Adds local_us, offset_s, abbr, zone and epoch_us of a timestamp's text; all null where it names no instant.

    local_us counts the wall clock as if it were UTC. A bare number is an instant: seconds below 10^11,
    milliseconds below 10^14, microseconds from there on.
    """
    df = _settled(df, "_v", F.trim(F.regexp_replace(value_col, r"(?U)\s+", " ")))
    v = F.col("_v")
    canon = F.lit(None).cast("string")
    for pattern, parts in reversed(NOTATIONS):
        canon = F.when(v.rlike(pattern), F.regexp_replace(v, pattern, parts)).otherwise(canon)
    df = _settled(df, "_p", F.split(canon, r"\|", -1))
    part = lambda i: F.get(F.col("_p"), i)
    month = lambda c: F.try_element_at(_months(), F.lower(c))
    kind = part(0)
    month_first = (kind == "order") & F.coalesce(F.col(order_col) == "mdy", F.lit(False))
    year = _int(F.when(kind == "ymd", part(1)).otherwise(part(3)))
    mon = F.coalesce(month(F.when(kind == "dny", part(2)).when(kind == "ndy", part(1))), _int(F.when(month_first, part(1)).otherwise(part(2))))
    day = _int(F.when(kind == "ymd", part(3)).when((kind == "ndy") | month_first, part(2)).otherwise(part(1)))
    ap = F.lower(part(8))
    hour = F.coalesce(_int(part(4)), F.lit(0))
    hour = F.when(ap == "", hour).when(hour <= 12, hour % 12 + F.when(ap == "pm", 12).otherwise(0))
    minute, second = F.coalesce(_int(part(5)), F.lit(0)), F.coalesce(_int(part(6)), F.lit(0))
    micros = F.coalesce(F.rpad(F.substring(part(7), 1, 6), 6, "0").try_cast("long"), F.lit(0))
    stamp = F.try_make_timestamp(year, mon, day, hour, minute, second.cast("decimal(8,6)"), F.lit("UTC"))
    mark = part(9)
    sign = F.when(mark.startswith("-"), -1).otherwise(1)
    digits = F.regexp_replace(mark, r"[^0-9]", "")
    offset = F.when(mark.rlike(r"^[+-]"), sign * (_int(F.substring(digits, 1, 2)) * 3600 + _int(F.substring(digits, 3, 2)) * 60))
    number = F.when(v.rlike(r"^\d{1,17}(\.\d{1,9})?$"), v.try_cast("decimal(30,9)"))
    epoch = F.when(number < 10**11, number * 1_000_000).when(number < 10**14, number * 1000).otherwise(number).try_cast("long")
    out = F.struct(
        F.when(second < 60, F.unix_micros(stamp) + micros).alias("local_us"),
        offset.alias("offset_s"),
        F.lower(F.when(mark.rlike(r"^\p{Alpha}"), mark)).alias("abbr"),
        F.nullif(part(10), F.lit("")).alias("zone"),
        epoch.alias("epoch_us"),
    )
    return _settled(df, "_r", out).select("*", "_r.*").drop("_v", "_p", "_r")


def utc_micros(df: DataFrame, col: str) -> Column:
    """Microseconds of a timestamp column; one without zone is meant as UTC whatever the session's zone."""
    if dict(df.dtypes)[col] == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(col))
    return F.unix_micros(F.col(col).cast("timestamp"))


def _instant(local_us: Column, zone: Column) -> Column:
    """Wall clock to instant: the earlier of two, and the offset before a gap where the time was skipped."""
    return F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(local_us), zone))


def estimate_zones(readings: DataFrame, candidates: list[str], tolerance: float = 0.01, least: int = 5) -> DataFrame:
    """(source, zone_name, violations, lag_s, n) for each source of readings(source, local_us, arrived_us, offset_s, abbr, zone).

    Every candidate's offset history turns the local times into instants. It is violated by a reading
    without zone whose instant lies after the arrival, and by one that states its offset from UTC (or an
    abbreviation, or a zone) where the history has another; UTC itself is written by clocks of all zones
    and tells nothing. Of the candidates within `tolerance` of the smallest share of violations the one
    with the least median lag is taken, that is the westernmost clock that still keeps to the order.
    Candidates that tie in all that are taken by name. Sources with fewer than `least` telling readings
    get no estimate; null times are no readings. Aggregated per source and candidate, so a source with a
    third of all rows costs one partial aggregate per partition.
    """
    spark = readings.sparkSession
    known = zone_abbreviations(spark, candidates or ["UTC"])
    offset, abbr, zone = F.col("offset_s"), F.col("abbr"), F.col("zone")
    neutral = (F.coalesce(offset, F.lit(1)) == 0) | F.coalesce(abbr.isin(*_UTC_NAMES), F.lit(False))
    bare = offset.isNull() & abbr.isNull() & zone.isNull()
    own = readings.filter("local_us is not null and arrived_us is not null").filter(~neutral | zone.isNotNull())
    own = own.select("source", "local_us", "arrived_us", "offset_s", "abbr", F.when(zone.isin(_zones()), zone).alias("zone"), bare.alias("bare"))
    own = own.filter("bare or offset_s is not null or abbr is not null or zone is not null")
    each = own.withColumn("zone_name", F.explode(F.array(*[F.lit(z) for z in candidates]))) if candidates else own.withColumn("zone_name", F.lit(None).cast("string")).limit(0)
    each = each.join(F.broadcast(known), ["zone_name", "abbr"], "left")  # a few rows for each candidate
    instant = _instant(F.col("local_us"), F.col("zone_name"))
    lag = F.when(F.col("bare"), (F.col("arrived_us") - instant) / 1e6)
    east = F.round((F.col("local_us") - instant) / 1e6)
    stated = F.coalesce("offset_s", "seconds", F.round((F.col("local_us") - _instant(F.col("local_us"), F.col("zone"))) / 1e6))
    wrong = F.when(F.col("bare"), F.col("lag") < 0).otherwise(F.coalesce(stated != east, F.lit(True)))
    cost = each.withColumn("lag", lag).groupBy("source", "zone_name").agg(
        F.avg(wrong.cast("double")).alias("violations"), F.percentile_approx("lag", 0.5, 1000).alias("lag_s"), F.count("*").alias("n")
    ).filter(F.col("n") >= least)
    best = cost.groupBy("source").agg(F.min("violations").alias("least"))
    near = cost.join(best, "source").filter(F.col("violations") <= F.col("least") + tolerance)
    pick = near.groupBy("source").agg(F.min_by(F.struct("zone_name", "violations", "lag_s", "n"), F.struct("lag_s", "zone_name")).alias("p"))
    return pick.select("source", "p.zone_name", "p.violations", "p.lag_s", "p.n")


def dateonly(local_us: Column, blank: Column) -> Column:
    """A local midnight without zone: most likely a date alone, which says nothing about the clock."""
    return blank & (F.pmod(local_us, F.lit(86_400_000_000)) == 0)


def to_instants(items: DataFrame, clocks: DataFrame, id_col: str = "ingest_seq", value_col: str = "published_at", source_col: str = "source_id", arrived_col: str = "fetched_at", use_clocks: bool = True) -> DataFrame:
    """(id, published_us, read_by): one instant per value that names one.

    clocks(source_id, zone_name, date_order) states the sources' own clocks. A zone, offset or
    abbreviation in the value holds first; then the stated clock; a source without one gets the zone
    `estimate_zones` finds from its arrivals, UTC if it has none. `read_by` tells which. Values that are
    null, empty, relative, impossible dates or in an unknown notation give no row; a repeated row gives
    its instant again; items without a source are read as UTC. Zone rules are Spark's own.
    """
    spark = items.sparkSession
    known = clocks.select(F.col("source_id").alias("_source"), F.col("zone_name").alias("_zone"), F.col("date_order").alias("_order")).filter("_source is not null").dropDuplicates(["_source"])
    names = sorted({r[0] for r in known.select("_zone").distinct().limit(len(_zones()) + 1).collect() if r[0] in set(_zones())})
    if not use_clocks:
        known = known.withColumn("_zone", F.lit(None).cast("string"))
    own = items.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), F.col(value_col).alias("_value"), utc_micros(items, arrived_col).alias("arrived_us")).filter("_value <> ''")
    read = parse_notation(own.join(known, "_source", "left"), "_value", "_order")
    read = read.filter("local_us is not null or epoch_us is not null")
    zone_ok = F.col("_zone").isin(_zones())
    blank = F.col("local_us").isNotNull() & F.col("offset_s").isNull() & F.col("abbr").isNull() & F.col("zone").isNull()
    unstated = read.filter(~F.coalesce(zone_ok, F.lit(False))).select(F.col("_source").alias("source"), "local_us", "arrived_us", "offset_s", "abbr", "zone", blank.alias("blank"))
    guessed = estimate_zones(unstated.filter(~dateonly(F.col("local_us"), F.col("blank"))), names)
    read = read.join(guessed.select(F.col("source").alias("_source"), F.col("zone_name").alias("_guess")), "_source", "left")
    abbr = zone_abbreviations(spark, names or ["UTC"]).withColumnsRenamed({"zone_name": "_zone"})
    clock = F.coalesce(F.when(zone_ok, F.col("_zone")), F.col("_guess"), F.lit("UTC"))
    read = read.withColumn("_zone", clock).join(abbr, ["_zone", "abbr"], "left")
    fixed = F.create_map(*[x for k, m in ABBREVIATIONS.items() for x in (F.lit(k), F.lit(m * 60))])
    offset = F.coalesce("offset_s", F.when(F.col("abbr").isin(*_UTC_NAMES), 0), F.col("seconds"), F.try_element_at(fixed, F.col("abbr")))
    named = F.when(F.col("zone").isin(_zones()), F.col("zone"))
    spoilt = (F.col("abbr").isNotNull() & offset.isNull() & named.isNull()) | (F.col("zone").isNotNull() & named.isNull())
    us = (
        F.when(F.col("epoch_us").isNotNull(), F.col("epoch_us"))
        .when(spoilt, None)
        .when(offset.isNotNull(), F.col("local_us") - offset.cast("long") * 1_000_000)
        .otherwise(_instant(F.col("local_us"), F.coalesce(named, F.col("_zone"))))
    )
    by = (
        F.when(F.col("epoch_us").isNotNull(), "epoch").when(F.col("offset_s").isNotNull(), "offset").when(F.col("abbr").isNotNull(), "abbreviation")
        .when(named.isNotNull(), "zone in value").when(zone_ok & F.col("_guess").isNull(), "clock").otherwise("estimate")
    )
    return read.select(F.col("_id").alias(id_col), us.alias("published_us"), by.alias("read_by")).filter("published_us is not null")

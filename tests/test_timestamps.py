import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsloom.operators import timestamps

UTC = dt.UTC
CLOCKS = [("ny", "America/New_York", "mdy"), ("de", "Europe/Berlin", "dmy"), ("in", "Asia/Kolkata", "dmy"), ("cn", "Asia/Shanghai", "dmy")]

CASES = [
    ("ny", "2025/01/16 02:29", "2025-01-16T07:29:00"),
    ("ny", "2025-03-09 02:30:00", "2025-03-09T07:30:00"),  # skipped: the offset before the gap
    ("ny", "2025-11-02 01:30:00", "2025-11-02T05:30:00"),  # twice: the earlier
    ("ny", "01/02/2025 9:05 PM", "2025-01-03T02:05:00"),
    ("de", "01/02/2025 9:05 PM", "2025-02-01T20:05:00"),
    ("ny", "Wed, 15 Jan 2025 23:33:51 EST", "2025-01-16T04:33:51"),
    ("in", "Thu, 16 Jan 2025 07:06:05 IST", "2025-01-16T01:36:05"),
    ("cn", "16 Jan 2025 07:06:05 CST", "2025-01-15T23:06:05"),
    ("de", "2025-01-15T11:24:33.158937+00:00", "2025-01-15T11:24:33.158937"),
    ("de", "2025-01-16T15:15:05[Australia/Sydney]", "2025-01-16T04:15:05"),
    ("de", "20250116T071752Z", "2025-01-16T07:17:52"),
    ("de", "2025-01-16t04:55:15z", "2025-01-16T04:55:15"),
    ("de", "16.01.2025, 06:02 Uhr", "2025-01-16T05:02:00"),
    ("de", "16 de enero de 2025, 03:23", "2025-01-16T02:23:00"),
    ("de", "15 janvier 2025 à 02h16", "2025-01-15T01:16:00"),
    ("de", "15 января 2025, 02:16", "2025-01-15T01:16:00"),
    ("cn", "2025年1月16日 14:22", "2025-01-16T06:22:00"),
    ("ny", "Jan 18, 2025 11:37 PM +0100", "2025-01-18T22:37:00"),
    ("ny", "February 1, 2025", "2025-02-01T05:00:00"),
    ("ny", "2025-02-01", "2025-02-01T05:00:00"),
    ("ny", "1736989395", "2025-01-16T01:03:15"),
    ("ny", "1737003702.08", "2025-01-16T05:01:42.080000"),
    ("ny", "1737239227035", "2025-01-18T22:27:07.035000"),
    ("ny", "1736991995945976", "2025-01-16T01:46:35.945976"),
    ("none", "2025-01-16 10:00:00", "2025-01-16T10:00:00"),
    *[("ny", x, None) for x in ("", None, "yesterday", "3 hours ago", "2025-02-30T10:00:00Z", "2025-13-04 08:00:00", "25:61", "-", "n/a", "0000-00-00 00:00:00", "13/13/2025 10:00", "x" * 5000)],
]


def test_notations(spark):
    rows = [(i, s, v, dt.datetime(2025, 12, 1), "clash") for i, (s, v, _) in enumerate(CASES)]
    items = spark.createDataFrame(rows, "ingest_seq bigint, source_id string, published_at string, fetched_at timestamp_ntz, zone string")
    clocks = spark.createDataFrame(CLOCKS, "source_id string, zone_name string, date_order string")
    got = {r["ingest_seq"]: r["published_us"] for r in timestamps.to_instants(items, clocks).collect()}
    for i, (_, v, want) in enumerate(CASES):
        us = None if want is None else int((dt.datetime.fromisoformat(want).replace(tzinfo=UTC) - dt.datetime(1970, 1, 1, tzinfo=UTC)) / dt.timedelta(microseconds=1))
        assert got.get(i) == us, (v, want, got.get(i))


def test_empty_and_repeated(spark):
    clocks = spark.createDataFrame(CLOCKS, "source_id string, zone_name string, date_order string")
    schema = "ingest_seq bigint, source_id string, published_at string, fetched_at timestamp"
    assert timestamps.to_instants(spark.createDataFrame([], schema), clocks).count() == 0
    two = spark.createDataFrame([(1, "ny", "1736989395", None), (1, "ny", "1736989395", None)], schema)
    assert timestamps.to_instants(two, clocks).count() == 2
    none = spark.createDataFrame([(1, None, "2025-01-16 10:00:00", None)], schema)
    assert [r["published_us"] for r in timestamps.to_instants(none, clocks.limit(0)).collect()] == [1737021600000000]


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/New_York", "Asia/Kolkata"])
def test_zone_estimate(spark, zone):
    import random
    import zoneinfo

    random.seed(3)
    rows = []
    for i in range(300):
        arrived = dt.datetime(2025, 1, 1, tzinfo=UTC) + dt.timedelta(hours=29 * i)
        published = arrived - dt.timedelta(minutes=random.randint(1, 600))
        rows.append((i, "quiet", published.astimezone(zoneinfo.ZoneInfo(zone)).strftime("%Y-%m-%d %H:%M:%S"), arrived.replace(tzinfo=None)))
    items = spark.createDataFrame(rows, "ingest_seq bigint, source_id string, published_at string, fetched_at timestamp_ntz")
    known = [(f"s{k}", z, "dmy") for k, z in enumerate(["Asia/Tokyo", "America/New_York", "Asia/Kolkata", "Europe/Berlin", "UTC"])]
    out = timestamps.to_instants(items, spark.createDataFrame(known, "source_id string, zone_name string, date_order string"))
    want = {i: int(dt.datetime.strptime(v, "%Y-%m-%d %H:%M:%S").replace(tzinfo=zoneinfo.ZoneInfo(zone)).timestamp() * 1e6) for i, _, v, _ in rows}
    assert {r["ingest_seq"]: r["published_us"] for r in out.collect()} == want
    assert {r["read_by"] for r in out.collect()} == {"estimate"}


def test_stated_offsets_decide_where_arrivals_cannot(spark):
    """Slow arrivals fit clocks further west as well; the source's own offsets, one per season, name the history."""
    rows = [(i, "s", f"2025-{m:02d}-10 0{i % 10}:15", "2025-12-30 00:00:00", "x") for i, m in enumerate([1, 2, 3, 6, 7, 8] * 2)]
    rows += [(100, "s", "2025-01-05T10:00:00+01:00", "2025-12-30 00:00:00", "x"), (101, "s", "2025-07-05T10:00:00+02:00", "2025-12-30 00:00:00", "x"), (102, "s", "2025-07-05T10:00:00Z", "2025-12-30 00:00:00", "x")]
    df = spark.createDataFrame(rows, "ingest_seq bigint, source_id string, published_at string, fetched_at string, zone string").withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))
    clocks = spark.createDataFrame([("s", "Europe/Berlin", "dmy"), ("u", "UTC", "dmy"), ("v", "Africa/Lagos", "dmy"), ("w", "America/New_York", "mdy")], "source_id string, zone_name string, date_order string")
    sure = {r["ingest_seq"]: r["published_us"] for r in timestamps.to_instants(df, clocks).collect()}
    guess = {r["ingest_seq"]: r["published_us"] for r in timestamps.to_instants(df, clocks, use_clocks=False).collect()}
    assert sure == guess and len(sure) == 15

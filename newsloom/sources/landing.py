"""Landing of raw payloads: a Python data source with one partition per source, and item tables in JSON and Parquet."""

from __future__ import annotations

import concurrent.futures
import glob
import json
import os
import time
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from newsloom.sources import feeds

SCHEMA = "source_id string, protocol string, location string, payload string, status string, error string"


class _Source(InputPartition):
    def __init__(self, spec: dict):
        self.spec = spec


class PayloadReader(DataSourceReader):
    """Reads each source in its own task; a failure or timeout becomes a row with its status, not a failed job."""

    def __init__(self, options: dict):
        self.specs = json.loads(options["specs"])
        self.timeout = float(options.get("timeout", "20"))

    def partitions(self):
        return [_Source(s) for s in self.specs]

    def read(self, partition) -> Iterator[tuple]:
        s = partition.spec
        places = [s["location"]] if _is_web(s["location"]) else sorted(glob.glob(s["location"])) or [s["location"]]
        for place in places:
            pool = concurrent.futures.ThreadPoolExecutor(1)
            try:
                payload = pool.submit(_fetch, place, s, self.timeout).result(timeout=self.timeout)
                yield s["source_id"], s.get("protocol", ""), place, payload, "ok", None
            except concurrent.futures.TimeoutError:
                yield s["source_id"], s.get("protocol", ""), place, None, "timeout", f"no answer in {self.timeout:g} s"
            except Exception as e:
                yield s["source_id"], s.get("protocol", ""), place, None, "failed", f"{type(e).__name__}: {e}"
            finally:
                pool.shutdown(wait=False)


def _is_web(place: str) -> bool:
    return place.startswith(("http://", "https://"))


def _fetch(place: str, spec: dict, timeout: float) -> str:
    """The text of a file or web address, undecodable bytes replaced.

    A spec may give `headers`, and with `form` or `json` the body of a POST. `jsonp` True unwraps callback(...).
    """
    if spec.get("delay"):
        time.sleep(float(spec["delay"]))
    if _is_web(place):
        headers = {"User-Agent": "newsloom", **spec.get("headers", {})}
        body = None
        if "json" in spec:
            body, headers["Content-Type"] = json.dumps(spec["json"]).encode(), "application/json"
        elif "form" in spec:
            body = urllib.parse.urlencode(spec["form"]).encode()
        with urllib.request.urlopen(urllib.request.Request(place, data=body, headers=headers), timeout=timeout) as answer:
            found = answer.read().decode("utf-8", "replace")
        return found[found.index("(") + 1 : found.rindex(")")] if spec.get("jsonp") and "(" in found else found
    with open(place.removeprefix("file://"), encoding="utf-8", errors="replace") as f:
        return f.read()


class PayloadSource(DataSource):
    @classmethod
    def name(cls):
        return "news_payloads"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return PayloadReader(self.options)


def read_payloads(spark: SparkSession, specs: list[dict], timeout: float = 20) -> DataFrame:
    """Payloads of specs {source_id, protocol, location}; location is a web address, or a file or pattern in storage the executors share."""
    spark.dataSource.register(PayloadSource)
    return spark.read.format("news_payloads").option("specs", json.dumps(specs)).option("timeout", str(timeout)).load()


def source_specs(text: str, default_limit: int = 20) -> list[dict]:
    """'id:limit, id2' as specs; a bad or missing limit is the default, the least is 1."""
    out = []
    for part in filter(None, (p.strip() for p in text.split(","))):
        name, _, limit = part.partition(":")
        out.append({"id": name.strip(), "limit": max(1, int(limit)) if limit.strip().lstrip("-").isdigit() else default_limit})
    return out


def requested(specs: list[dict], presets: dict[str, list[dict]], preset: str | None) -> list[dict]:
    """Specs given by hand, else those of the preset; an unknown preset is an error."""
    if specs:
        return specs
    if preset not in presets:
        raise ValueError(f"unknown preset {preset!r}; known: {', '.join(sorted(presets))}")
    return presets[preset]


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Ingested items from Parquet, JSON lines or one JSON array, completed to the item columns."""
    if path.endswith(".parquet") or os.path.isdir(path):
        raw = spark.read.parquet(path)
    else:
        raw = spark.read.option("multiLine", "true").json(path)
    return feeds.as_items(raw)


def write_items(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """Items by source, for pruning by source_id later; JSON as lines, one file per task."""
    writer = df.write.mode("overwrite")
    writer.partitionBy("source_id").parquet(path) if kind == "parquet" else writer.json(path)


def write_document(df: DataFrame, path: str, meta: dict, most: int = 10_000) -> None:
    """One JSON document {meta, rows} for a reader; `most` rows at most, more are an error, not cut."""
    rows = df.limit(most + 1).toJSON().collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows; write a table instead")
    with open(path, "w", encoding="utf-8") as f:
        json.dump({"meta": meta, "rows": [json.loads(r) for r in rows]}, f, ensure_ascii=False, indent=2)


def within_lookback(items: DataFrame, instant, as_of, hours) -> DataFrame:
    """Items no older than `hours` (a number or a column) before `as_of`; without an instant they are left out."""
    return items.filter(instant >= as_of - F.make_dt_interval(hours=hours if isinstance(hours, Column) else F.lit(hours)))

"""Top N rows of every group by secondary sort."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _starts(batch: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """True where a row's key differs from the row before it; null equals null. The first row is left False."""
    n = batch.num_rows
    new = np.zeros(n, dtype=bool)
    for k in keys:
        c = batch.column(batch.schema.get_field_index(k))
        a, b = c.slice(0, n - 1), c.slice(1)
        differ = pc.fill_null(pc.not_equal(a, b), False)
        one_null = pc.xor(pc.is_null(a), pc.is_null(b))
        new[1:] |= np.asarray(pc.or_(differ, one_null).to_numpy(zero_copy_only=False), dtype=bool)
    return new


def _first_n(keys: Sequence[str], n: int):
    """Streams sorted Arrow batches; state is the last key and how many of its rows have passed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None
        passed = 0
        for batch in batches:
            rows = batch.num_rows
            if rows == 0:
                continue
            new = _starts(batch, keys)
            first = tuple(batch.column(batch.schema.get_field_index(k))[0].as_py() for k in keys)
            carried = passed if first == last else 0
            at = np.arange(rows)
            begin = np.maximum.accumulate(np.where(new, at, 0))
            place = at - begin + np.where(begin == 0, carried, 0)
            # a group that begins at row 0 is the carried one, unless a new start sits there
            last = tuple(batch.column(batch.schema.get_field_index(k))[rows - 1].as_py() for k in keys)
            passed = int(place[-1]) + 1
            keep = place < n
            if keep.any():
                yield batch.filter(pa.array(keep))

    return run


def top_n_per_group(
    df: DataFrame,
    group_cols: Sequence[str],
    order: Sequence[Column],
    n: int,
    carry: Sequence[str],
) -> DataFrame:
    """The first `n` rows of each group under `order`, with the columns `group_cols + carry`.

    Method: secondary sort. Each input partition is sorted by (group, order) and streamed, emitting at
    most `n` rows a group; only those travel, hash-partitioned by group, and the same sort and stream run
    once more. A group with a third of all rows therefore shuffles at most n rows per input partition,
    and no task ever buffers a group.

    `order` must end in a unique key, else ties are broken arbitrarily but still exactly `n` rows leave.
    Null group keys form a group of their own; null order values sort as the given Column says. Repeated
    rows count each. `n` < 1 or an empty input gives no rows. Extra input columns are dropped first, so
    their names cannot clash; names in both lists appear once.
    """
    cols = list(dict.fromkeys([*group_cols, *carry]))
    if n < 1:
        return df.select(*cols).limit(0)
    keyed = df.select(*cols)
    sort = [*[F.col(c).asc_nulls_first() for c in group_cols], *order]
    step = _first_n(list(group_cols), n)
    local = keyed.sortWithinPartitions(*sort).mapInArrow(step, keyed.schema)
    spread = local.repartition(*[F.col(c) for c in group_cols])
    return spread.sortWithinPartitions(*sort).mapInArrow(step, keyed.schema)


def best_ranked(raw_items: DataFrame, n: int = 5) -> DataFrame:
    """The `n` best rows of each ranking list (source_id, rank_section) of raw_items.

    Unranked rows (null, 0 or negative rank_position) and rows without a rank_section take no part.
    """
    ranked = raw_items.select("source_id", "rank_section", "rank_position", "fetched_at", "ingest_seq").filter(
        (F.col("rank_position") >= 1) & (F.col("rank_section") != "")
    )
    order = [F.col("rank_position").asc(), F.col("fetched_at").desc_nulls_last(), F.col("ingest_seq").asc()]
    return top_n_per_group(ranked, ["source_id", "rank_section"], order, n, ["rank_position", "fetched_at", "ingest_seq"])

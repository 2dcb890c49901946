"""Deduplication, ordering, caps, quotas and lookups over items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first under `order`; null keys form one group.

    A minimum of (order, row) per key, combined before the shuffle, so a key with a third of all rows
    sends one row per input partition.
    """
    row = F.struct(*df.columns)
    rank = F.struct(*order)
    best = df.groupBy(*[k.alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min_by(row, rank).alias("_r"))
    return best.select("_r.*")


def last_wins(df: DataFrame, keys: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    best = df.groupBy(*[k.alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_r"))
    return best.select("_r.*")


def listing_order(rank: Column, published: Column, title: Column) -> tuple[Column, list[Column]]:
    """(is unranked, order): ranked rows by rank, date and title upwards, then the unranked by date and title downwards."""
    ranked = F.coalesce(rank > 0, F.lit(False))
    up = [F.when(ranked, rank).asc_nulls_last(), F.when(ranked, published).asc_nulls_last(), F.when(ranked, title).asc_nulls_last()]
    down = [F.when(~ranked, published).desc_nulls_last(), F.when(~ranked, title).desc_nulls_last()]
    return ~ranked, [(~ranked).asc(), *up, *down]


def numbered(df: DataFrame, group: Sequence[Column], order: Sequence[Column], name: str = "place") -> DataFrame:
    return df.withColumn(name, F.row_number().over(W.partitionBy(*group).orderBy(*order)))


def capped(df: DataFrame, group: Sequence[Column], order: Sequence[Column], cap: int | Column, name: str = "place") -> DataFrame:
    """At most `cap` rows of each group. A constant cap is pushed below the shuffle (window group limit)."""
    return numbered(df, group, order, name).filter(F.col(name) <= cap)


def capped_then_ranked(df: DataFrame, group: Sequence[Column], order: Sequence[Column], per_group: int, total: int) -> DataFrame:
    """A cap per group, then the first `total` of what is left, numbered over all as `place`.

    The global part sorts by a top-k of each partition, never the whole table in one task.
    """
    kept = capped(df, group, order, per_group, "_g").drop("_g")
    top = kept.orderBy(*order).limit(total)
    return top.withColumn("place", F.row_number().over(W.orderBy(*order)))  # `total` rows


def quota_fill(df: DataFrame, section: Column, role: Column, order: Sequence[Column], role_limit: int, quotas: dict[str, int], address: Column) -> DataFrame:
    """Rows that fill each section's quota: the best per address, at most `role_limit` per role of a section, then the quota."""
    once = first_wins(df, [address], order)
    by_role = capped(once, [section, role], order, role_limit, "_role")
    quota = F.coalesce(F.try_element_at(F.create_map(*[x for k, v in quotas.items() for x in (F.lit(k), F.lit(v))]), section), F.lit(0))
    return capped(by_role, [section], order, quota, "_quota").drop("_role", "_quota")


def with_aliases(catalog: DataFrame, id_col: str, aliases_col: str) -> DataFrame:
    """(name, id): every id and alias of a catalog; an id wins over an alias of the same name, then the lesser id."""
    own = catalog.select(F.col(id_col).alias("name"), F.col(id_col).alias("id"), F.lit(0).alias("o"))
    other = catalog.select(F.explode(aliases_col).alias("name"), F.col(id_col).alias("id"), F.lit(1).alias("o"))
    return own.union(other).groupBy("name").agg(F.min_by("id", F.struct("o", "id")).alias("id"))


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, defaults: dict[str, object]) -> DataFrame:
    """Left join of a dimension with defaults where it has no row; Spark broadcasts it by its measured size."""
    fields = dim.select(F.col(dim_key).alias(key), *defaults)
    return df.join(fields, key, "left").withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def counted(df: DataFrame, column: Column, name: str, limit: int | None = None) -> DataFrame:
    """Values by count downwards, then value upwards."""
    out = df.groupBy(column.alias(name)).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(name))
    return out.limit(limit) if limit else out


def distributions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(dimension, value, n) of several columns in one pass (grouping sets)."""
    one = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in columns])).alias("d"))
    return one.groupBy("d.dimension", "d.value").agg(F.count("*").alias("n"))


def most_common(df: DataFrame, group: Sequence[str], value: str, order: str) -> DataFrame:
    """The most frequent value of each group; of equally frequent ones the one seen first."""
    n = df.groupBy(*group, value).agg(F.count("*").alias("n"), F.min(order).alias("seen"))
    return n.groupBy(*group).agg(F.min_by(value, F.struct((-F.col("n")).alias("n"), "seen")).alias(value), F.max("n").alias("n"))


def voted(df: DataFrame, group: Sequence[str], value: str, weight: str) -> DataFrame:
    """The value with the greatest summed weight of each group, the lesser value on a tie."""
    n = df.groupBy(*group, value).agg(F.sum(weight).alias("score"))
    return n.groupBy(*group).agg(F.min_by(value, F.struct((-F.col("score")).alias("s"), value)).alias(value), F.max("score").alias("score"))


def cache_misses(texts: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Distinct keys that the cache does not hold yet."""
    return texts.select(key).filter(F.col(key) != "").distinct().join(cache.select(key), key, "left_anti")


def sessions(df: DataFrame, user: str, at: str, gap_seconds: int) -> DataFrame:
    """Rows with a session number per user; a pause longer than the gap opens the next. Rows without a time are left out.

    Rows are first summed up per user and spell of the gap's length, inside which no pause can open a
    session; only the spells are put in order, so a user with a third of all rows is not sorted in one task.
    """
    width = gap_seconds * 1_000_000
    t = F.unix_micros(F.col(at).cast("timestamp"))
    marked = df.filter(F.col(at).isNotNull()).withColumns({"_t": t, "_spell": F.floor(t / width)})
    spells = marked.groupBy(user, "_spell").agg(F.min("_t").alias("t0"), F.max("_t").alias("t1"))
    order = W.partitionBy(user).orderBy("_spell")
    opens = F.coalesce((F.col("t0") - F.lag("t1").over(order) > width).cast("int"), F.lit(1))
    numbered_ = spells.withColumn("_new", opens).withColumn("session", F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    named = numbered_.select(F.col(user).alias("_u"), F.col("_spell").alias("_s"), "session")
    return marked.join(named, F.col(user).eqNullSafe(F.col("_u")) & (F.col("_spell") == F.col("_s"))).select(*df.columns, "session")


def as_of(left: DataFrame, right: DataFrame, by: Sequence[str], at: str, right_at: str, spell_seconds: int = 86_400) -> DataFrame:
    """Each left row with the latest right row of the same `by` at or before its time, as the struct `match`; null where there is none.

    Both sides are cut into spells of time. Inside a spell rows are put in order by themselves; what a spell
    starts with is the last right row of an earlier one, found over one row per spell. So a key with a
    third of all rows is spread over its spells. Of right rows of one time any may be taken, unless their columns order them: the greatest.
    """
    t = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    width = spell_seconds * 1_000_000
    key = [F.col(c) for c in by]
    payload = F.struct(*[c for c in right.columns if c not in by])
    r = right.filter(F.col(right_at).isNotNull()).select(*key, t(right_at).alias("_t"), F.lit(0).alias("_side"), payload.alias("_right"), F.lit(None).cast(_struct_type(left, ())).alias("_left"))
    x = left.select(*key, t(at).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(_struct_type(right, by)).alias("_right"), F.struct(*left.columns).alias("_left"))
    both = r.unionByName(x).withColumn("_spell", F.floor(F.col("_t") / width))
    last = both.groupBy(*by, "_spell").agg(F.max(F.when(F.col("_side") == 0, F.struct("_t", "_right"))).alias("_last"))
    before = W.partitionBy(*by).orderBy("_spell").rowsBetween(W.unboundedPreceding, -1)
    carried = last.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("_spell").alias("_s"), F.last("_last", ignorenulls=True).over(before)["_right"].alias("_carried"))
    order = W.partitionBy(*by, "_spell").orderBy("_t", "_side", "_right").rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = both.withColumn("_match", F.last("_right", ignorenulls=True).over(order)).filter("_side = 1")
    same = F.col("_spell").eqNullSafe(F.col("_s"))
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return inside.join(carried, same, "left").select("_left.*", F.coalesce("_match", "_carried").alias("match"))


def _struct_type(df: DataFrame, by: Sequence[str]):
    return df.select(F.struct(*[c for c in df.columns if c not in by]).alias("s")).schema["s"].dataType


def decided(pairs: DataFrame, rules: Sequence[tuple[str, Column, bool, Column | float]], otherwise: str = "no rule") -> DataFrame:
    """Adds merges, reason and confidence of the first rule that holds for each pair; one pass over the pairs.

    A rule is (reason, condition, merges, confidence). A condition that is null does not hold.
    """
    out = F.struct(F.lit(False).alias("merges"), F.lit(otherwise).alias("reason"), F.lit(0.0).alias("confidence"))
    for reason, condition, merges, confidence in reversed(list(rules)):
        c = confidence if isinstance(confidence, Column) else F.lit(float(confidence))
        out = F.when(condition, F.struct(F.lit(merges).alias("merges"), F.lit(reason).alias("reason"), c.cast("double").alias("confidence"))).otherwise(out)
    return pairs.withColumn("_d", F.explode(F.array(out))).select("*", "_d.*").drop("_d")


def with_cache(df: DataFrame, key: str, value: str, cache: DataFrame, compute) -> tuple[DataFrame, DataFrame]:
    """(df with `value`, new cache rows): values come from cache(key, value), the rest from `compute`.

    `compute` gets a DataFrame of the distinct missing keys and returns (key, value); keys it gives
    nothing for stay null. Null keys are not looked up.
    """
    misses = df.select(key).filter(F.col(key).isNotNull()).distinct().join(cache.select(key), key, "left_anti")
    new = compute(misses).select(key, value)
    known = cache.select(key, value).unionByName(new)
    return df.join(known, key, "left"), new

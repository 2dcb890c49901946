"""Points, scores and choices by tables a user brings along: expressions for items, aggregates for groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newsloom.operators import relational as rel


def by_name(name: Column, points: Mapping[str, float], otherwise: float) -> Column:
    """The points of a name; `otherwise` for null and unknown ones."""
    table = F.create_map(*[F.lit(x) for k, v in points.items() for x in (k, float(v))])
    return F.coalesce(F.try_element_at(table, name), F.lit(float(otherwise)))


def by_step(x: Column, steps: Sequence[tuple[float, float]], beyond: float, missing: float) -> Column:
    """The points of the first step (upper bound, points) that x does not exceed, `beyond` past them, `missing` for null."""
    out = F.when(x.isNull(), float(missing))
    for upto, points in steps:
        out = out.when(x <= upto, float(points))
    return out.otherwise(float(beyond))


def by_label(label: Column, exact: Sequence[tuple[float, Sequence[str]]], parts: Sequence[tuple[float, Sequence[str]]], blank: float, otherwise: float) -> Column:
    """The points of a label, whatever its case and outer blanks: by whole names, then by parts of names."""
    x = F.lower(F.trim(F.coalesce(label, F.lit(""))))
    out = F.when(x == "", float(blank))
    for points, names in exact:
        out = out.when(x.isin(list(names)), float(points))
    for points, words in parts:
        has = F.lit(False)
        for w in words:
            has = has | x.contains(w)
        out = out.when(has, float(points))
    return out.otherwise(float(otherwise))


def first_part(label: Column, weights: Mapping[str, float], otherwise: Column) -> Column:
    """The first of the names, in their order, that stands in the label."""
    return F.coalesce(*[F.when(F.lower(label).contains(k), k) for k in weights], otherwise)


def thousandths(x: Column) -> Column:
    """Rounded to three decimals, halves up, by the same arithmetic everywhere."""
    return F.floor(x * 1000 + 0.5) / 1000


def best_of_groups(members: DataFrame, group: str, id_col: str, order: Sequence[Column], scores: Sequence[str]) -> DataFrame:
    """Per group the greatest of each score and the member it comes from, the first under `order` where several have it.

    Partial maxima per input partition, so a group with a third of all members costs one row from each.
    """
    aggs = []
    for s in scores:
        first = F.struct((-F.col(s)).alias("s"), *order, F.col(id_col))
        aggs += [F.max(s).alias(s), F.min_by(id_col, first).alias(f"{s}_from")]
    return members.groupBy(group).agg(*aggs)


def chosen(scored: DataFrame, score: str, threshold: Column, category: Column, order: Sequence[Column], caps: Mapping[str, int], other_cap: int, total: int) -> DataFrame:
    """The rows whose score reaches their threshold, the best of each category up to its cap, of those the best `total`; numbered as `place`.

    Rows under their threshold do not count against a cap. Caps are pushed below the shuffle, the total
    is a top-k of every partition.
    """
    passing = scored.filter(F.col(score) >= threshold)
    best = [F.desc(score), *order]
    cap = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in caps.items() for x in kv]), category), F.lit(other_cap)) if caps else F.lit(other_cap)
    widest = max([*caps.values(), other_cap])
    kept = rel.capped(passing, [category], best, widest, "_in_category").filter(F.col("_in_category") <= cap).drop("_in_category")
    top = kept.orderBy(*best).limit(total)
    return top.withColumn("place", F.row_number().over(W.orderBy(*best)))  # `total` rows

"""Running sums along a value axis, distributed by value ranges.

The input is already collapsed to one row per distinct value, so ties and a value shared by most rows cost one row.
`by` holds names (of columns, splits, metrics), so it has few distinct values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugework.operators.ordered import place, range_buckets, split_points
from gaugework.operators.sizing import same_keys


def _join_small(df: DataFrame, side: DataFrame, keys: list[str]) -> DataFrame:
    """Broadcast join; the side has at most `range_buckets` rows per `by` name."""
    side = F.broadcast(side.withColumnsRenamed({k: "__side_" + k for k in keys}))
    return df.join(side, same_keys(df, keys, "__side_"), "left").drop(*["__side_" + k for k in keys])


def running_sums(counts: DataFrame, by: list[str], value: str, cols: list[str]) -> DataFrame:
    """Add `cum_<c>` (sum over values up to and including this one), `tot_<c>` and `next_<value>`."""
    extra = [] if by else ["__all"]
    work = counts if by else counts.withColumn("__all", F.lit(0))
    by = by or extra
    buckets = range_buckets(counts.sparkSession)
    splits = work.groupBy(*by).agg(split_points(value, buckets).alias("__splits"))
    placed = _join_small(work, splits, by)
    placed = placed.withColumn("__b", place(F.col(value), F.col("__splits"), buckets)).drop("__splits")
    totals = placed.groupBy(*by, "__b").agg(*[F.sum(c).alias(f"__s_{c}") for c in cols], F.min(value).alias("__min"))
    along = W.partitionBy(*by).orderBy("__b")
    earlier = along.rowsBetween(W.unboundedPreceding, -1)
    prefix = totals.select(
        *by,
        "__b",
        F.lead("__min").over(along).alias("__next"),
        *[F.coalesce(F.sum(f"__s_{c}").over(earlier), F.lit(0)).alias(f"__p_{c}") for c in cols],
        *[F.sum(f"__s_{c}").over(W.partitionBy(*by)).alias(f"tot_{c}") for c in cols],
    )
    inside = W.partitionBy(*by, "__b").orderBy(value)
    upto = inside.rowsBetween(W.unboundedPreceding, 0)
    out = _join_small(placed, prefix, [*by, "__b"]).withColumns(
        {
            f"next_{value}": F.coalesce(F.lead(value).over(inside), F.col("__next")),
            **{f"cum_{c}": F.col(f"__p_{c}") + F.sum(c).over(upto) for c in cols},
        }
    )
    return out.drop("__b", "__next", *[f"__p_{c}" for c in cols], *extra)


def quantiles(
    df: DataFrame, cols: list[str], shares: list[float], linear: bool = True, by: str | None = None, overall: str | None = None
) -> DataFrame:
    """Exact quantiles of several columns: one row per (column, share), of each group of `by` if it is given.

    Linear interpolation between order statistics, or the nearest one with `linear=False` (halves to even). With `overall`
    there is one more group of that name with all rows; it is added up from the counts of the groups, not from the rows.
    """
    names = [by] if by else []
    long = df.select(*names, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(names, cols, "column", "value")
    counts = long.filter(F.col("value").isNotNull()).groupBy(*names, "column", "value").agg(F.count(F.lit(1)).alias("n"))
    if by and overall is not None:
        whole = counts.groupBy("column", "value").agg(F.sum("n").alias("n")).withColumn(by, F.lit(overall))
        counts = counts.unionByName(whole)
    names.append("column")
    running = running_sums(counts, names, "value", ["n"])
    first, last = F.col("cum_n") - F.col("n"), F.col("cum_n") - 1

    def spot(share: float) -> tuple[Column, Column, Column]:
        h = F.lit(float(share)) * (F.col("tot_n") - 1)
        h = h if linear else F.bround(h)
        return F.floor(h), F.ceil(h), h

    hits = []
    for share in shares:
        below, above, h = spot(share)
        is_low, is_high = (first <= below) & (last >= below), (first <= above) & (last >= above)
        found = F.struct(
            F.lit(float(share)).alias("share"),
            F.when(is_low, F.col("value")).alias("low"),
            F.when(is_high, F.col("value")).alias("high"),
            (h - below).alias("part"),
        )
        hits.append(F.when(is_low | is_high, found))
    rows = running.select(*names, F.explode(F.array_compact(F.array(*hits))).alias("hit")).select(*names, "hit.*")
    low, high = F.max("low"), F.max("high")
    return rows.groupBy(*names, "share").agg((low + (high - low) * F.max("part")).alias("quantile"))

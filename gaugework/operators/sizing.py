"""Joins against derived side tables whose size is measured before a strategy is chosen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_kept: list[DataFrame] = []


def sized(side: DataFrame) -> tuple[DataFrame, int]:
    """Materialise an aggregated side table and count it.

    After the count the optimizer knows its exact bytes: below `spark.sql.autoBroadcastJoinThreshold` a join
    with it is a broadcast join, above it is a shuffle join that AQE splits on skewed keys. The lineage stays,
    so lost blocks are recomputed.
    """
    side = side.persist()
    rows = side.count()
    _kept.append(side)
    return side, rows


def release() -> None:
    """Drop every side table kept so far; results that are still in use recompute what they need."""
    while _kept:
        _kept.pop().unpersist()


def same_keys(left: DataFrame, keys: list[str], prefix: str) -> Column:
    """Null-safe equality of `keys` with their prefixed copies, so a null key is a group like any other."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys], F.lit(True))


def attach(df: DataFrame, side: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Add the columns of `side` (one row per key) to `df`."""
    prefix = "__side_"
    renamed = side.withColumnsRenamed({k: prefix + k for k in keys})
    joined = df.join(renamed, same_keys(df, keys, prefix), how)
    return joined.drop(*[prefix + k for k in keys])


def attach_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Add the columns of a one-row table (a global aggregate or a parameter row) to every row."""
    return df.crossJoin(F.broadcast(row))

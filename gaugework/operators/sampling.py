"""Splits and samples by md5 order of a unique key: exact in size, the same under any partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugework.functions.hashing import hash_bucket, hash_integer, hash_key
from gaugework.operators.ordered import (
    hash_buckets,
    hash_index,
    mark_first,
    place,
    range_buckets,
    split_points,
)
from gaugework.operators.sizing import attach, attach_row, sized


#: Buckets of the random order that draws are looked up in; one is a few rows of a small table, a sort in memory of a large.
DRAW_BUCKETS = 4096


def holdout(
    df: DataFrame, key: str | list[str], share: float = 0.2, by: list[str] | None = None, seed: int = 42,
    name: str = "is_test",
) -> DataFrame:
    """Mark ceil(share * n) rows, of every stratum when `by` is given."""
    digest = hash_key(key, seed)
    want = F.ceil(F.lit(share) * F.col("__total"))
    return mark_first(df, hash_bucket(digest, hash_buckets(df.sparkSession)), [digest], want, by or [], name)


def group_holdout(
    df: DataFrame, keys: list[str], share: float = 0.2, seed: int = 42, name: str = "is_test"
) -> DataFrame:
    """Mark all rows of ceil(share * groups) groups, so no group is on both sides."""
    groups, _ = sized(holdout(df.select(*keys).distinct(), keys, share, None, seed, name))
    return attach(df, groups, keys)


def folds(
    df: DataFrame, key: str | list[str], k: int = 5, by: list[str] | None = None, seed: int = 42, name: str = "fold"
) -> DataFrame:
    """Fold number 0..k-1; every stratum is dealt out evenly."""
    dealt = hash_index(df, key, seed, by, "__pos")
    return dealt.withColumn(name, F.pmod(F.col("__pos") - 1, F.lit(k)).cast("int")).drop("__pos")


def ordered_prefix(df: DataFrame, order: str, share: float = 0.8, name: str = "is_train") -> DataFrame:
    """Mark the first floor(share * n) rows along a unique numeric column."""
    buckets = range_buckets(df.sparkSession)
    splits = df.agg(split_points(order, buckets).alias("__splits"))
    placed = attach_row(df, splits).withColumn("__at", place(F.col(order), F.col("__splits"), buckets))
    want = F.floor(F.lit(share) * F.col("__total"))
    return mark_first(placed.drop("__splits"), F.col("__at"), [F.col(order)], want, [], name).drop("__at")


def capped_sample(
    df: DataFrame, key: str | list[str], by: list[str], cap: int = 500, seed: int = 42
) -> DataFrame:
    """At most `cap` rows of every stratum, however large the stratum.

    A small cap is a ranking whose limit Spark also applies before the shuffle; a large one is decided by buckets.
    """
    digest = hash_key(key, seed)
    if cap <= 1000:
        rank = F.row_number().over(W.partitionBy(*by).orderBy(digest))
        return df.withColumn("__rank", rank).filter(F.col("__rank") <= cap).drop("__rank")
    bucket = hash_bucket(digest, hash_buckets(df.sparkSession))
    want = F.least(F.lit(cap), F.col("__total"))
    return mark_first(df, bucket, [digest], want, by, "__in").filter("__in").drop("__in")


def sample_rows(df: DataFrame, key: str | list[str], n: int, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows; the table is not shuffled (see `mark_first`)."""
    digest = hash_key(key, seed)
    want = F.least(F.lit(n), F.col("__total"))
    marked = mark_first(df, hash_bucket(digest, hash_buckets(df.sparkSession)), [digest], want, [], "__in")
    return marked.filter("__in").drop("__in")


def one_per_band(df: DataFrame, band: str, key: str | list[str], seed: int = 42) -> DataFrame:
    return capped_sample(df.filter(F.col(band).isNotNull()), key, [band], 1, seed)


def draw_with_replacement(df: DataFrame, key: str | list[str], n: int, seed: int = 42) -> DataFrame:
    """`n` draws: each draw hashes to a position in the md5 order of the keys and takes the row there.

    Rows are counted by bucket of that order, the draws' positions are found in the running counts, and only the rows of
    buckets that were hit are put in order; the table itself is not shuffled.
    """
    keys = [key] if isinstance(key, str) else key
    spark = df.sparkSession
    digest = hash_key(key, seed)
    buckets = max(hash_buckets(spark), DRAW_BUCKETS)
    rows = df.withColumn("__d", digest).withColumn("__b", hash_bucket(F.col("__d"), buckets))
    along = W.orderBy("__b")
    counts = rows.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    counts, _ = sized(counts.withColumn("__upto", F.sum("__n").over(along)))
    total = counts.agg(F.coalesce(F.max("__upto"), F.lit(0)).alias("__total"))
    draws = attach_row(spark.range(1, n + 1).withColumnRenamed("id", "draw"), total).filter("__total > 0")
    draws = draws.withColumn("__want", hash_integer(hash_key("draw", seed)) % F.col("__total") + 1)
    inside = (F.col("__want") <= F.col("__upto")) & (F.col("__want") > F.col("__upto") - F.col("__n"))
    # a range join of the draws with at most `buckets` counts
    hits = draws.join(F.broadcast(counts), inside).select(
        "draw", "__b", (F.col("__want") - F.col("__upto") + F.col("__n")).alias("__rank")
    )
    hits, _ = sized(hits)
    few = rows.join(hits.select("__b").distinct(), "__b", "left_semi")
    ranked = few.withColumn("__rank", F.row_number().over(W.partitionBy("__b").orderBy("__d")))
    return ranked.join(hits, ["__b", "__rank"]).select("draw", *df.columns)

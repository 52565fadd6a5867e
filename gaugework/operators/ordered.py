"""Order-dependent work that never puts an unbounded group into one task.

Groups of up to `limit` rows are windowed as they are. A larger group is cut: its rows get their position by range
buckets over all the order columns, compared in their own types, and prefix sums of the bucket counts; then slices of `limit` positions are windowed apart, each with copies
of the neighbouring rows that its frames reach. The result is the same either way.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugework.functions.hashing import hash_bucket, hash_key
from gaugework.operators.sizing import attach, sized

ROWS_PER_SLICE = 200_000
#: Buckets only find the positions and their rows are sorted, which spills; smaller ones would only be more of them.
ROWS_PER_BUCKET = 50_000


def range_buckets(spark: SparkSession) -> int:
    """Power of two near the shuffle parallelism; the bucket tables have that many rows per group."""
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = 8
    while buckets < wanted:
        buckets *= 2
    return buckets


def hash_buckets(spark: SparkSession) -> int:
    return 64 * range_buckets(spark)


def split_points(value: str, buckets: int) -> Column:
    """Approximate quantiles that cut `value` into equally filled ranges."""
    shares = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    return F.percentile_approx(value, shares, F.lit(max(10000, 10 * buckets)))


def place(value: Column, splits: Column, buckets: int) -> Column:
    """Number of split points at or below the value, found by halving steps."""
    steps = []
    step = buckets // 2
    while step:
        steps.append(F.lit(step))
        step //= 2
    return F.aggregate(
        F.array(*steps),
        F.lit(0),
        lambda at, s: F.when(value >= F.element_at(splits, at + s), at + s).otherwise(at),
    )


SAMPLES_PER_BUCKET = 20
_HASHES = 1_000_003


def order_splits(df: DataFrame, keys: list[str], order: list[str], buckets: int) -> DataFrame:
    """Per group of `df`, whose size is `__n`: `__splits`, the values of the order columns that cut it into `buckets`
    about equal ranges. They come from a hash sample of SAMPLES_PER_BUCKET rows a bucket and keep their types, so any
    order that a window can have is cut the same way; the later columns split ties of the first."""
    share = F.least(F.lit(1.0), F.lit(float(SAMPLES_PER_BUCKET * buckets)) / F.col("__n"))
    some = df.filter(F.pmod(F.xxhash64(*order), F.lit(_HASHES)) < share * _HASHES)
    found = some.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order))).alias("__s"))
    every = F.transform(
        F.sequence(F.lit(1), F.lit(buckets - 1)),
        lambda i: F.element_at("__s", F.greatest(F.lit(1), F.ceil(i * F.size("__s") / F.lit(buckets)).cast("int"))),
    )
    return found.select(*keys, every.alias("__splits"))


def heavy_groups(df: DataFrame, keys: list[str], limit: int) -> DataFrame | None:
    """Groups of more than `limit` rows with their size; at most rows/limit of them, None when there are none."""
    found, rows = sized(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > limit))
    return found if rows else None


def _before(col: str, by: list[str], order: str) -> Column:
    """Sum over the earlier buckets; it runs on bucket tables, whose size does not depend on the rows."""
    w = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum(col).over(w), F.lit(0))


def _place_in_two(df: DataFrame, splits: DataFrame, keys: list[str], order: list[str], buckets: int) -> DataFrame:
    """Add `__b`, the row's bucket, and `__cut`, whether its group has splits (`__b` is 0 where it has none).

    A row meets every `fine`th split point first and then the points inside that stretch, so what it is joined to has about
    the root of the number of buckets and not their number.
    """
    fine = 1 << (buckets.bit_length() - 1) // 2
    coarse, value, points = buckets // fine, F.struct(*order), F.col("__splits")
    marks = F.transform(F.sequence(F.lit(1), F.lit(coarse - 1)), lambda i: F.element_at(points, i * fine))
    stretch = F.transform(
        F.sequence(F.lit(0), F.lit(coarse - 1)),
        lambda i: F.struct(i.alias("__b"), F.slice(points, i * fine + 1, fine - 1).alias("__points")),
    )
    far = attach(df, splits.select(*keys, marks.alias("__marks")), keys)
    mark = F.when(F.col("__marks").isNull(), 0).otherwise(place(value, F.col("__marks"), coarse))
    far = far.withColumns({"__cut": F.col("__marks").isNotNull(), "__b": mark})
    inside, _ = sized(splits.select(*keys, F.inline(stretch)))
    near = attach(far.drop("__marks"), inside, [*keys, "__b"])
    bucket = F.when(F.col("__cut"), F.col("__b") * fine + place(value, F.col("__points"), fine)).otherwise(0)
    return near.withColumn("__b", bucket).drop("__points")


def _index(df: DataFrame, keys: list[str], order: list[str], heavy: DataFrame | None, limit: int, pos: str):
    if heavy is None:
        return df.withColumn(pos, F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("long"))
    largest = heavy.agg(F.max("__n")).first()[0]
    buckets = 8
    while buckets * max(limit, ROWS_PER_BUCKET) < 2 * largest:  # the larger the group, the more buckets of about half that
        buckets *= 2
    splits, _ = sized(order_splits(attach(df, heavy, keys, "inner"), keys, order, buckets))
    placed = _place_in_two(df, splits, keys, order, buckets)
    counts = placed.filter("__cut").groupBy(*keys, "__b").agg(F.count(F.lit(1)).alias("__c"))
    offsets, _ = sized(counts.withColumn("__off", _before("__c", keys, "__b")).drop("__c"))
    local = F.row_number().over(W.partitionBy(*keys, "__b").orderBy(*order))
    ranked = attach(placed, offsets, [*keys, "__b"])
    ranked = ranked.withColumn(pos, (F.coalesce(F.col("__off"), F.lit(0)) + local).cast("long"))
    return ranked.drop("__b", "__cut", "__off")


def group_index(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    limit: int = ROWS_PER_SLICE,
    pos: str = "pos",
) -> DataFrame:
    """Position 1..n of every row in its group. `order` must be unique in the group; its columns may be of any type
    that can be ordered, nulls first. Without keys the whole table is one group."""
    extra = [] if keys else ["__all"]
    work = df if keys else df.withColumn("__all", F.lit(0))
    keys = keys or extra
    heavy = heavy_groups(work, keys, limit)
    return _index(work, keys, order, heavy, limit, pos).drop(*extra)


def _check_positions(df: DataFrame, keys: list[str], position: str) -> None:
    at = F.col(position).cast("decimal(38,0)")
    n = F.count(F.lit(1)).cast("decimal(38,0)")
    sums = df.groupBy(*keys).agg(n.alias("n"), F.min(at).alias("lo"), F.max(at).alias("hi"), F.sum(at).alias("s"), F.sum(at * at).alias("q"))
    right = "lo = 1 AND hi = n AND s * 2 = n * (n + 1) AND q * 6 = n * (n + 1) * (2 * n + 1)"
    if sums.filter(f"NOT coalesce({right}, false)").head(1):
        raise ValueError(f"{position} must count the rows of every group from 1 without gaps or repeats")


@dataclass
class Frame:
    """What a builder gets: the ordered window, the row's position in the whole group and the group's size."""

    window: WindowSpec
    pos: Column
    size: Column | None


def over_groups(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    build: Callable[[Frame], dict[str, Column]],
    before: int = 0,
    after: int = 0,
    limit: int = ROWS_PER_SLICE,
    finish: list[dict[str, Column]] | None = None,
    position: str | None = None,
    trusted: bool = False,
) -> DataFrame:
    """Add the window columns that `build` returns; they may reach `before` rows back and `after` rows ahead.

    `position` names a column that already counts the rows of each group 1..n: groups are then cut by it straight
    away, without a sort to find the places (and `Frame.size` is not available). One aggregation checks that it has no
    gaps or repeats, unless the caller has made it (`trusted`).
    Built columns whose names start with `__` feed the row-wise steps of `finish` and are dropped after them.
    """
    limit = max(limit, before, after, 1)
    extra = [] if keys else ["__all"]
    work = df if keys else df.withColumn("__all", F.lit(0))
    keys = keys or extra

    def run(rows: DataFrame, frame: Frame) -> DataFrame:
        columns = build(frame)
        out = rows.withColumns(columns)
        for step in finish or []:
            out = out.withColumns(step)
        return out.drop(*[name for name in columns if name.startswith("__")])

    if position is not None:
        if not trusted:
            _check_positions(work, keys, position)
        indexed = work.withColumns({"__pos": F.col(position).cast("long"), "__n": F.lit(None).cast("long")})
        cut = F.lit(True)
    else:
        heavy = heavy_groups(work, keys, limit)
        if heavy is None:
            w = W.partitionBy(*keys).orderBy(*order)
            size = F.count(F.lit(1)).over(W.partitionBy(*keys))
            return run(work, Frame(w, F.row_number().over(w), size)).drop(*extra)
        indexed = attach(_index(work, keys, order, heavy, limit, "__pos"), heavy, keys)
        cut = F.col("__n").isNotNull()
    home = F.when(cut, F.floor((F.col("__pos") - 1) / F.lit(limit))).otherwise(F.lit(0)).cast("long")
    inside = F.pmod(F.col("__pos") - 1, F.lit(limit))
    slices = F.array(
        F.col("__home"),
        F.when(cut & (inside >= limit - before), F.col("__home") + 1),
        F.when(cut & (inside < after) & (F.col("__home") > 0), F.col("__home") - 1),
    )
    sliced = indexed.withColumn("__home", home).withColumn("__slice", F.explode(F.array_compact(slices)))
    parts = [*keys, "__slice"]
    size = None if position else F.coalesce(F.col("__n"), F.count(F.lit(1)).over(W.partitionBy(*parts)))
    return run(sliced, Frame(W.partitionBy(*parts).orderBy(*order), F.col("__pos"), size)).filter(
        F.col("__slice") == F.col("__home")
    ).drop("__pos", "__n", "__home", "__slice", *extra)


def hash_index(df: DataFrame, key: str | list[str], seed: int = 42, by: list[str] | None = None, pos: str = "pos"):
    """Position 1..n of every row of its `by` group in md5 order; buckets are leading digits, so always balanced."""
    by = by or []
    buckets = hash_buckets(df.sparkSession)
    hashed = df.withColumn("__h", hash_key(key, seed)).withColumn("__b", hash_bucket(F.col("__h"), buckets))
    counts = hashed.groupBy(*by, "__b").agg(F.count(F.lit(1)).alias("__c"))
    offsets, _ = sized(counts.withColumn("__off", _before("__c", by, "__b")).drop("__c"))
    local = F.row_number().over(W.partitionBy(*by, "__b").orderBy("__h"))
    placed = attach(hashed, offsets, [*by, "__b"])
    return placed.withColumn(pos, (F.col("__off") + local).cast("long")).drop("__h", "__b", "__off")


def mark_first(df: DataFrame, bucket: Column, order: list[Column], want: Column, by: list[str], name: str) -> DataFrame:
    """Boolean column `name`: the row is among the first `want` rows of its `by` group.

    `bucket` must be an integer that never falls along `order`; `want` may use `__total`, the size of the group.
    Buckets that lie wholly inside or outside are decided from their counts; only the bucket that the cut runs
    through is sorted, so the table itself is not shuffled.
    """
    placed = df.withColumn("__b", bucket)
    counts = placed.groupBy(*by, "__b").agg(F.count(F.lit(1)).alias("__c"))
    cut = (
        counts.withColumns({"__start": _before("__c", by, "__b"), "__total": F.sum("__c").over(W.partitionBy(*by))})
        .withColumn("__need", want - F.col("__start"))
        .withColumn("__state", F.when(F.col("__need") >= F.col("__c"), 1).when(F.col("__need") <= 0, -1).otherwise(0))
    )
    table, _ = sized(cut.select(*by, "__b", "__need", "__state"))
    marked = attach(placed, table, [*by, "__b"])
    sure = marked.filter(F.col("__state") != 0).withColumn(name, F.col("__state") == 1)
    rank = F.row_number().over(W.partitionBy(*by, "__b").orderBy(*order))
    edge = marked.filter(F.col("__state") == 0).withColumn(name, rank <= F.col("__need"))
    return sure.unionByName(edge).drop("__b", "__need", "__state")

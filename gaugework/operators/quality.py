"""Contract checks, integrity profile and train/test validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.operators.cumulative import quantiles


def _count_if(cond: Column) -> Column:
    return F.coalesce(F.sum(cond.cast("long")), F.lit(0))


def contract_checks(
    df: DataFrame,
    required: list[str] | None = None,
    forbidden: list[str] | None = None,
    not_null: list[str] | None = None,
    ranges: dict[str, tuple[float | None, float | None]] | None = None,
    types: dict[str, str] | None = None,
) -> DataFrame:
    """Rows (check, passed, value): schema checks give 0/1 misses, data checks the number of offending rows.

    All data checks are one aggregation over the columns they name.
    """
    dtypes = dict(df.dtypes)
    checks = [(f"has_{c}", F.lit(int(c not in dtypes))) for c in required or []]
    checks += [(f"no_{c}", F.lit(int(c in dtypes))) for c in forbidden or []]
    checks += [(f"type_{c}", F.lit(int(dtypes.get(c) != t))) for c, t in (types or {}).items()]
    nulls = df.columns if not_null is None else not_null
    checks += [(f"nulls_{c}", _count_if(F.col(c).isNull())) for c in nulls]
    for c, (low, high) in (ranges or {}).items():
        bad = F.lit(False)
        if low is not None:
            bad = bad | (F.col(c) < low)
        if high is not None:
            bad = bad | (F.col(c) > high)
        checks.append((f"range_{c}", _count_if(F.coalesce(bad, F.lit(False)))))
    found = df.agg(*[v.cast("long").alias(name) for name, v in checks])
    return found.unpivot([], [name for name, _ in checks], "check", "value").select(
        "check", (F.col("value") == 0).alias("passed"), "value"
    )


def require(checks: DataFrame) -> None:
    """Raise when a contract is broken; the check table has one row per rule."""
    failed = [r["check"] for r in checks.filter(~F.col("passed")).select("check").collect()]
    if failed:
        raise ValueError("contract broken: " + ", ".join(sorted(failed)))


def column_profile(df: DataFrame, numeric: list[str], other: list[str] | None = None) -> DataFrame:
    """Per column: missing rows, distinct values, whether constant, and values beyond 1.5 quartile ranges.

    Columns are unpivoted and collapsed to distinct values first, so no distinct count runs over the rows.
    """
    numeric, other = list(numeric), list(other or [])
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in numeric]).unpivot([], numeric, "column", "value")
    counts = numbers.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    fences = (
        quantiles(df, numeric, [0.25, 0.75])
        .groupBy("column")
        .agg(
            F.max(F.when(F.col("share") == 0.25, F.col("quantile"))).alias("q1"),
            F.max(F.when(F.col("share") == 0.75, F.col("quantile"))).alias("q3"),
        )
        .withColumnRenamed("column", "__c")
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    beyond = (F.col("value") < F.col("q1") - reach) | (F.col("value") > F.col("q3") + reach)
    profile = (
        counts.join(F.broadcast(fences), F.col("column") == F.col("__c"), "left")
        .groupBy("column")
        .agg(
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
            F.count("value").alias("distinct_values"),
            F.coalesce(F.sum(F.when(beyond, F.col("n"))), F.lit(0)).alias("outliers"),
        )
    )
    if other:
        text = df.select(*[F.col(c).cast("string").alias(c) for c in other]).unpivot([], other, "column", "value")
        rest = (
            text.groupBy("column", "value")
            .agg(F.count(F.lit(1)).alias("n"))
            .groupBy("column")
            .agg(
                F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
                F.count("value").alias("distinct_values"),
                F.lit(0).cast("long").alias("outliers"),
            )
        )
        profile = profile.unionByName(rest)
    return profile.withColumn("is_constant", F.col("distinct_values") <= 1)


def duplicate_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows, surplus copies and groups that have copies; equal rows are counted before they are shuffled."""
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.sum("n").alias("rows"),
        F.sum(F.col("n") - 1).alias("duplicate_rows"),
        _count_if(F.col("n") > 1).alias("duplicated_groups"),
    )


def conflicting_labels(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Rows whose features occur with more than one label."""
    groups = df.groupBy(*features).agg(
        F.count(F.lit(1)).alias("n"), F.min(label).alias("lo"), F.max(label).alias("hi")
    )
    clash = F.col("lo") != F.col("hi")
    return groups.agg(
        F.coalesce(F.sum(F.when(clash, F.col("n"))), F.lit(0)).alias("conflicting_rows"),
        _count_if(clash).alias("conflicting_groups"),
    )


def row_overlap(df: DataFrame, cols: list[str], is_test: str = "is_test") -> DataFrame:
    """Test rows that also occur in the training rows; copies are counted before they are shuffled."""
    test = F.col(is_test)
    groups = df.groupBy(*cols).agg(_count_if(test).alias("t"), _count_if(~test).alias("r"))
    shared = F.coalesce(F.sum(F.when(F.col("r") > 0, F.col("t"))), F.lit(0))
    return groups.agg(
        F.sum("r").alias("train_rows"), F.sum("t").alias("test_rows"), shared.alias("test_rows_in_train")
    )


def group_leakage(df: DataFrame, keys: list[str], is_test: str = "is_test") -> DataFrame:
    """Groups with rows on both sides."""
    groups = df.groupBy(*keys).agg(F.max(is_test).alias("hi"), F.min(is_test).alias("lo"))
    return groups.agg(F.count(F.lit(1)).alias("groups"), _count_if(F.col("hi") != F.col("lo")).alias("leaking_groups"))


def range_shift(df: DataFrame, cols: list[str], is_test: str = "is_test") -> DataFrame:
    """Per column: range in training and test rows, and test rows outside the training range."""
    long = df.select(is_test, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [is_test], cols, "column", "value"
    )
    test = F.col(is_test)
    ends = long.groupBy("column").agg(
        F.min(F.when(~test, F.col("value"))).alias("train_min"),
        F.max(F.when(~test, F.col("value"))).alias("train_max"),
        F.min(F.when(test, F.col("value"))).alias("test_min"),
        F.max(F.when(test, F.col("value"))).alias("test_max"),
    )
    joined = long.filter(test).join(F.broadcast(ends.withColumnRenamed("column", "__c")), F.col("column") == F.col("__c"))
    outside = _count_if((F.col("value") < F.col("train_min")) | (F.col("value") > F.col("train_max")))
    return joined.groupBy("column", "train_min", "train_max", "test_min", "test_max").agg(outside.alias("test_outside"))


def label_shift(df: DataFrame, label: str, is_test: str = "is_test") -> DataFrame:
    """Share of every label in training and test rows and their difference."""
    test = F.col(is_test)
    counts = df.groupBy(F.col(label).alias("label")).agg(_count_if(~test).alias("r"), _count_if(test).alias("t"))
    totals = counts.agg(F.sum("r").alias("__r"), F.sum("t").alias("__t"))
    train, held = F.try_divide("r", "__r"), F.try_divide("t", "__t")
    return counts.crossJoin(F.broadcast(totals)).select(
        "label", train.alias("train_share"), held.alias("test_share"), (held - train).alias("shift")
    )

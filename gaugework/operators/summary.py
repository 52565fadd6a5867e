"""Aggregated views of scored machines and engines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugework.functions.machine import MODE_COLUMNS
from gaugework.operators.cumulative import quantiles
from gaugework.operators.sizing import attach, attach_row


def _count_if(cond: Column) -> Column:
    return F.coalesce(F.sum(cond.cast("long")), F.lit(0))


def group_counts(df: DataFrame, by: list[str], name: str = "rows") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name)).orderBy(*by)


def fleet_profile(df: DataFrame, dataset: str = "dataset_id", unit: str = "unit", critical: float = 20) -> DataFrame:
    """Per data set and overall: engines, rows, mean, smallest and largest remaining life, critical rows.

    Engines are collapsed first, so nothing is counted distinct over the rows. Rows without a life count as rows only; a
    null data set is a group of its own.
    """
    engines = df.groupBy(dataset, unit).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("rul").alias("s"),
        F.count("rul").alias("k"),
        F.min("rul").alias("lo"),
        F.max("rul").alias("hi"),
        _count_if(F.col("rul") < critical).alias("c"),
    )
    profile = engines.rollup(dataset).agg(
        F.count(F.lit(1)).alias("engines"),
        F.sum("n").alias("rows"),
        F.try_divide(F.sum("s"), F.sum("k")).alias("mean_rul"),
        F.min("lo").alias("min_rul"),
        F.max("hi").alias("max_rul"),
        F.sum("c").alias("critical_count"),
        F.grouping(dataset).alias("__all"),
    )
    return profile.withColumn(dataset, F.when(F.col("__all") == 1, F.lit("all")).otherwise(F.col(dataset))).drop("__all")


def fleet_statistics(df: DataFrame, dataset: str = "dataset_id", rul: str = "rul", stress: str = "thermal_stress") -> DataFrame:
    """Per data set and overall (`all`): median remaining life, and mean, sample spread, 90 and 95 percent point of the stress.

    The median lies between two rows where it has to; the percent points are values of the nearest row. Nulls are left out;
    a data set without values has null statistics.
    """
    moments = df.rollup(dataset).agg(
        F.avg(stress).alias("mean_stress"), F.stddev_samp(stress).alias("std_stress"), F.grouping(dataset).alias("__all")
    )
    named = F.when(F.col("__all") == 1, F.lit("all")).otherwise(F.col(dataset))
    moments = moments.withColumn(dataset, named).drop("__all")
    middle = quantiles(df, [rul], [0.5], by=dataset, overall="all").select(dataset, F.col("quantile").alias("median_rul"))
    high = quantiles(df, [stress], [0.9, 0.95], linear=False, by=dataset, overall="all")
    point = lambda share, name: F.max(F.when(F.col("share") == share, F.col("quantile"))).alias(name)
    high = high.groupBy(dataset).agg(point(0.9, "p90_stress"), point(0.95, "p95_stress"))
    for side in (middle, high):
        moments = attach(moments, side, [dataset])
    return moments.select(dataset, "median_rul", "mean_stress", "std_stress", "p90_stress", "p95_stress")


def anomaly_summary(
    df: DataFrame, failure: str = "failure", flag: str = "is_anomaly", prob: str = "failure_prob",
    modes: list[str] = MODE_COLUMNS, high: float = 0.5,
) -> DataFrame:
    """Totals, rates in percent, mean probability, high-risk rows and the count of every failure mode."""
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("total_samples"),
        F.sum(failure).alias("failure_count"),
        (F.sum(failure) / total * 100).alias("failure_rate_pct"),
        F.sum(flag).alias("anomaly_count"),
        (F.sum(flag) / total * 100).alias("anomaly_rate_pct"),
        F.avg(prob).alias("avg_failure_prob"),
        _count_if(F.col(prob) > high).alias("high_risk_count"),
        *[F.sum(m).alias(m) for m in modes if m in df.columns],
    )


def overlap(df: DataFrame, failure: str = "failure", flag: str = "is_anomaly") -> DataFrame:
    f, a = F.col(failure) == 1, F.col(flag) == 1
    return df.agg(
        _count_if(a & f).alias("anomaly_vs_failure_overlap"),
        _count_if(a & (F.col(failure) == 0)).alias("anomaly_without_failure"),
        _count_if((F.col(flag) == 0) & f).alias("failure_without_anomaly"),
    )


def mode_breakdown(df: DataFrame, modes: list[str] = MODE_COLUMNS, failure: str = "failure") -> DataFrame:
    """One row per failure mode with its count and the failures in total."""
    sums = df.agg(*[F.sum(m).alias(m) for m in modes], F.sum(failure).alias("total_failures"))
    return sums.unpivot(["total_failures"], modes, "mode", "failures").select("mode", "failures", "total_failures")


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    return group_counts(df, [label])


def binned_mean(df: DataFrame, x: str, y: str, bins: int = 29) -> DataFrame:
    """Mean of `y` in equal half-open bins over the range of `x`; the largest `x` itself falls in no bin."""
    ends = df.agg(F.min(x).cast("double").alias("__lo"), F.max(x).cast("double").alias("__hi"))
    width = (F.col("__hi") - F.col("__lo")) / bins
    wide = attach_row(df.select(x, y), ends).filter((F.col(x) < F.col("__hi")) & (F.col("__hi") > F.col("__lo")))
    slot = F.floor((F.col(x) - F.col("__lo")) / width).cast("int")
    return (
        wide.withColumn("bin", F.least(slot, F.lit(bins - 1)))
        .groupBy("bin", "__lo", "__hi")
        .agg(F.avg(y).alias("mean"), F.count(F.lit(1)).alias("rows"))
        .select("bin", (F.col("__lo") + (F.col("bin") + 0.5) * width).alias("center"), "mean", "rows")
    )


def stage_rates(
    df: DataFrame, x: str, event: str, edges: tuple[float, ...] = (0, 50, 100, 150, 200, 240)
) -> DataFrame:
    """Event rate in percent per fixed stage, empty stages 0, values outside the edges dropped, with a severity."""
    bands = list(zip(edges, edges[1:]))
    sums = df.agg(
        *[F.sum(F.when((F.col(x) >= lo) & (F.col(x) < hi), F.col(event))).alias(f"e{i}") for i, (lo, hi) in enumerate(bands)],
        *[_count_if((F.col(x) >= lo) & (F.col(x) < hi)).alias(f"n{i}") for i, (lo, hi) in enumerate(bands)],
    )
    stages = F.array(
        *[
            F.struct(
                F.lit(i).alias("stage"),
                F.lit(f"{lo:g}-{hi:g}").alias("label"),
                F.col(f"n{i}").alias("rows"),
                F.coalesce(F.try_divide(F.col(f"e{i}") * 100.0, F.col(f"n{i}")), F.lit(0.0)).alias("rate_pct"),
            )
            for i, (lo, hi) in enumerate(bands)
        ]
    )
    severity = F.when(F.col("rate_pct") < 2, "normal").when(F.col("rate_pct") < 8, "warning").otherwise("critical")
    return sums.select(F.inline(stages)).withColumn("severity", severity)


def error_histogram(df: DataFrame, actual: str, predicted: str, bins: int = 40) -> DataFrame:
    """Counts of prediction errors in equal bins over their range; the last bin is closed, empty bins are kept
    and missing errors left out."""
    err = df.select((F.col(predicted) - F.col(actual)).alias("e")).filter("e is not null")
    ends = err.agg(F.min("e").alias("__lo"), F.max("e").alias("__hi"))
    width = (F.col("__hi") - F.col("__lo")) / bins
    slot = F.coalesce(F.floor(F.try_divide(F.col("e") - F.col("__lo"), width)), F.lit(0))
    counts = (
        attach_row(err, ends)
        .groupBy(F.least(slot, F.lit(bins - 1)).cast("int").alias("__bin"))
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    grid = ends.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "__lo", "__hi")
    return grid.join(F.broadcast(counts), F.col("bin") == F.col("__bin"), "left").select(
        "bin",
        (F.col("__lo") + F.col("bin") * width).alias("low"),
        (F.col("__lo") + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce(F.col("__n"), F.lit(0)).alias("rows"),
    )


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column with its nulls."""
    sums = df.agg(*[_count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return sums.unpivot([], df.columns, "column", "nulls")


def importance_report(df: DataFrame, families: Column, n: int = 10) -> DataFrame:
    """Top `n` of (feature, importance) with the share of the top's sum; `families` tags a feature name."""
    top = df.orderBy(F.desc("importance"), "feature").limit(n)
    total = F.sum("importance").over(W.partitionBy())
    share = F.when(total > 0, F.col("importance") / total * 100).otherwise(F.col("importance") * 100)
    return top.select("feature", "importance", share.alias("share_pct"), families.alias("family"))


def engine_family(feature: str = "feature") -> Column:
    name = F.col(feature)
    return F.when(name.contains("_trend"), "trend").when(name.contains("_velocity"), "velocity").otherwise("raw")


# Fixed lists behind the feature families of the machine model.
PHYSICS_FEATURES = ["power_w", "stress_index", "overstrain_margin", "temp_delta", "power_w_smooth"]
SENSOR_FEATURES = ["rpm", "torque", "tool_wear", "air_temp_c", "proc_temp_c"]


def machine_family(feature: str = "feature") -> Column:
    name = F.col(feature)
    return F.when(name.isin(PHYSICS_FEATURES), "physics").when(name.isin(SENSOR_FEATURES), "sensor").otherwise("smoothed")


def feasibility(df: DataFrame, status: str = "status") -> DataFrame:
    ok = _count_if(F.col(status).isin("OPTIMAL", "FEASIBLE"))
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("total_scenarios"),
        ok.alias("feasible_count"),
        (total - ok).alias("infeasible_count"),
        (F.try_divide(ok, total) * 100).alias("feasibility_rate"),
    )


def first_at_or_below(value: str, at: str, level: float = 50) -> Column:
    return F.min(F.when(F.col(value) <= level, F.col(at)))


def last_value(value: str, at: str) -> Column:
    return F.max_by(value, at)

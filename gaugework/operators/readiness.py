"""Metric gates and the headline record."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed thresholds: check -> (metric, comparison, bound).
GATES = {
    "r2_above_0.7": ("r2", ">=", 0.7),
    "rmse_below_25": ("rmse", "<", 25.0),
    "f1_above_0.6": ("f1", ">=", 0.6),
    "precision_above_0.8": ("precision", ">=", 0.8),
    "comparison_significant": ("significant", ">=", 1.0),
}


def gate_checks(metrics: DataFrame) -> DataFrame:
    """One row per gate from rows (metric, value); a missing metric fails its gate, of a repeated one the largest value counts.

    Only the metrics that gates ask for are gathered, one column each.
    """
    names = list(dict.fromkeys(m for m, _, _ in GATES.values()))
    values = wide(metrics.select("metric", F.col("value").cast("double").alias("value")), names)
    gates = F.array(
        *[
            F.struct(F.lit(name).alias("check"), F.lit(m).alias("metric"), F.col(m).alias("value"), F.lit(op).alias("op"), F.lit(b).alias("bound"))
            for name, (m, op, b) in GATES.items()
        ]
    )
    rows = values.select(F.inline(gates))
    passed = F.when(F.col("op") == "<", F.col("value") < F.col("bound")).otherwise(F.col("value") >= F.col("bound"))
    return rows.select("check", "metric", "value", F.coalesce(passed, F.lit(False)).alias("passed"))


def readiness(metrics: DataFrame, inputs: dict[str, bool]) -> DataFrame:
    """One row: are all inputs present, do all gates pass, and is the system ready."""
    present = all(inputs.values())
    gates = gate_checks(metrics).agg(
        F.bool_and("passed").alias("all_metrics_pass"), F.sum(F.col("passed").cast("long")).alias("gates_passed")
    )
    return gates.select(
        F.lit(present).alias("all_inputs_present"),
        "all_metrics_pass",
        "gates_passed",
        (F.lit(present) & F.col("all_metrics_pass")).alias("ready"),
    )


def wide(metrics: DataFrame, names: list[str]) -> DataFrame:
    """Rows (metric, value) as one row; an absent metric is null."""
    return metrics.agg(*[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in names])


def compile_record(parts: dict[str, DataFrame]) -> DataFrame:
    """One nested record from one-row results; every part becomes a struct column."""
    rows = [df.select(F.struct(*df.columns).alias(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), rows)

"""Survival curves and group comparison of lifetimes."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from gaugework.operators.cumulative import running_sums
from gaugework.operators.sizing import attach_row, sized
from gaugework.operators.summary import first_at_or_below, last_value


@F.pandas_udf(DoubleType())
def _upper_tail(z: pd.Series) -> pd.Series:
    return z.map(lambda x: 0.5 * math.erfc(x / math.sqrt(2.0)), na_action="ignore")


def survival_curve(df: DataFrame, group: str, lifetime: str = "lifetime", censored: str = "censored") -> DataFrame:
    """Active units per group and cycle, from 0 to the longest lifetime.

    A unit is active while the cycle is below its lifetime, and at its lifetime only when it is censored.

    Counts run over the distinct lifetimes only; every one of them then fills the cycles up to the next, so the work of a
    long grid is spread over the lifetimes of a group.
    """
    ends = df.groupBy(group, F.col(lifetime).cast("long").alias("cycle")).agg(
        F.count(F.lit(1)).alias("ended"), F.sum(F.col(censored).cast("long")).alias("kept")
    )
    ends, _ = sized(ends)  # one row per distinct lifetime, read for the groups, the end of the grid and the counts
    none = F.lit(0).cast("long")
    starts = ends.select(group).distinct().select(group, F.lit(-1).cast("long").alias("cycle"), none.alias("ended"), none.alias("kept"))
    steps = running_sums(ends.unionByName(starts), [group], "cycle", ["ended"])
    steps = attach_row(steps, ends.agg(F.max("cycle").alias("__last")))
    first = F.greatest(F.col("cycle"), none)
    until = F.coalesce(F.col("next_cycle") - 1, F.col("__last"))
    filled = steps.filter(first <= until).select(
        group, F.explode(F.sequence(first, until)).alias("at"), "cycle", "kept", "tot_ended", "cum_ended"
    )
    kept = F.when(F.col("at") == F.col("cycle"), F.col("kept")).otherwise(0)
    active = F.col("tot_ended") - F.col("cum_ended") + kept
    return filled.select(
        group, F.col("at").alias("cycle"), active.alias("active"), (active / F.col("tot_ended") * 100).alias("survival_pct")
    )


def survival_summary(curve: DataFrame, group: str) -> DataFrame:
    """Half-life (first cycle at or below 50 percent, null if never), last cycle and final survival."""
    return curve.groupBy(group).agg(
        F.max("cycle").alias("total_cycles"),
        first_at_or_below("survival_pct", "cycle", 50).alias("half_life_cycle"),
        last_value("survival_pct", "cycle").alias("final_survival_pct"),
    )


def lifetime_summary(df: DataFrame, group: str, lifetime: str = "lifetime") -> DataFrame:
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("units"),
        F.avg(lifetime).alias("mean_cycles"),
        F.stddev_pop(lifetime).alias("std_cycles"),
        F.min(lifetime).alias("min_cycles"),
        F.max(lifetime).alias("max_cycles"),
    )


def life_extension(df: DataFrame, group: str, treated: str, control: str, lifetime: str = "lifetime") -> DataFrame:
    """Gain of the treated group's mean lifetime over the control's, in percent."""
    means = df.agg(
        F.avg(F.when(F.col(group) == treated, F.col(lifetime))).alias("treated_mean"),
        F.avg(F.when(F.col(group) == control, F.col(lifetime))).alias("control_mean"),
    )
    gain = F.try_divide(F.col("treated_mean") - F.col("control_mean"), F.col("control_mean")) * 100
    return means.withColumn("life_extension_pct", gain)


def mann_whitney(df: DataFrame, group: str, first: str, second: str, value: str, alpha: float = 0.05) -> DataFrame:
    """One-sided test that `first` tends to be larger: U, tie-corrected z with continuity correction, p.

    Rows are collapsed to distinct values before anything is ranked.
    """
    sides = df.filter(F.col(group).isin(first, second) & F.col(value).isNotNull())
    counts = sides.groupBy(F.col(value).alias("value")).agg(
        F.sum((F.col(group) == first).cast("long")).alias("a"), F.count(F.lit(1)).alias("n")
    )
    ranks = running_sums(counts, [], "value", ["a", "n"])
    n = F.col("n").cast("double")
    sums = ranks.agg(
        F.max("tot_a").cast("double").alias("na"),
        (F.max("tot_n") - F.max("tot_a")).cast("double").alias("nb"),
        F.sum(F.col("a") * (F.col("cum_n") - n + (n + 1) / 2)).alias("r"),
        F.sum(n * n * n - n).alias("ties"),
    )
    na, nb, total = F.col("na"), F.col("nb"), F.col("na") + F.col("nb")
    spread = F.sqrt(na * nb / 12 * (total + 1 - F.try_divide(F.col("ties"), total * (total - 1))))
    u = F.col("r") - na * (na + 1) / 2
    out = sums.select(na.alias("n_first"), nb.alias("n_second"), u.alias("u"), (na * nb / 2).alias("mid"), spread.alias("sd"))
    out = out.withColumn("z", F.try_divide(F.col("u") - F.col("mid") - 0.5, F.col("sd")))
    out = out.withColumn("p_value", _upper_tail("z")).withColumn("significant", F.col("p_value") < alpha)
    return out.drop("mid", "sd")

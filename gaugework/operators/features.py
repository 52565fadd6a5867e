"""Derived columns that need the neighbours, the group or the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugework.functions import engine, machine
from gaugework.operators.columns import MACHINE_NAMES, fill_null, select_features
from gaugework.operators.cumulative import running_sums
from gaugework.operators.ordered import ROWS_PER_SLICE, over_groups
from gaugework.operators.sizing import attach, attach_row, sized
from gaugework.operators.smoothing import savgol
from gaugework.sources.tables import write_table

ENGINE_KEYS = ["dataset_id", "unit"]
MACHINE_SENSORS = ["air_temp_c", "proc_temp_c", "rpm", "torque", "tool_wear", "power_w"]
MACHINE_TARGETS = ["failure", *machine.MODE_COLUMNS]


def clean_machines(raw: DataFrame) -> DataFrame:
    """Renamed, encoded and converted machine rows. `UDI` stays: it is the only row order there is."""
    return (
        raw.withColumnsRenamed(MACHINE_NAMES)
        .withColumns(
            {
                "prod_type": machine.encode("prod_type", machine.TYPE_CODES),
                "air_temp_c": machine.celsius("air_temp_k"),
                "proc_temp_c": machine.celsius("proc_temp_k"),
                "power_w": machine.power_w(),
            }
        )
        .drop("Product ID", "air_temp_k", "proc_temp_k")
    )


def machine_physics(df: DataFrame, torque_max: float | None = None, rpm_max: float | None = None) -> DataFrame:
    """`temp_delta`, `stress_index`, `overstrain_margin`; the maxima come from the data unless given."""
    out = df
    if torque_max is None or rpm_max is None:
        out = attach_row(df, df.agg(F.max("torque").alias("__torque"), F.max("rpm").alias("__rpm")))
        top_torque, top_rpm = F.col("__torque"), F.col("__rpm")
    else:
        top_torque, top_rpm = F.lit(torque_max), F.lit(rpm_max)
    stress = F.try_divide(F.col("torque"), top_torque) * F.try_divide(F.col("rpm"), top_rpm)
    return out.withColumns(
        {
            "temp_delta": F.col("proc_temp_c") - F.col("air_temp_c"),
            "stress_index": stress,
            "overstrain_margin": machine.overstrain_margin(),
        }
    ).drop("__torque", "__rpm")


def machine_features(
    clean: DataFrame, order: str = "UDI", keys: list[str] | None = None, store: str | None = None
) -> DataFrame:
    """Physics, smoothing and min-max scaling of the clean machine table.

    The scaling reads its input twice; with a `store` path that is a stored table instead of the windows over again.
    """
    df = savgol(machine_physics(clean), MACHINE_SENSORS, keys or [], [order])
    df = write_table(df, store) if store else df
    exclude = [*MACHINE_TARGETS, "prod_type", order, *(keys or [])]
    return minmax(df, select_features(df, exclude, ("double", "bigint", "int")))


def engine_physics(df: DataFrame) -> DataFrame:
    return df.withColumns(engine.physics())


def remaining_life(
    df: DataFrame, keys: list[str] = ENGINE_KEYS, cycle: str = "cycle", cap: float | None = None
) -> DataFrame:
    """`rul`: cycles to the last one of the engine. One small row per engine is joined back, so an engine that
    holds much of the table is never gathered in one task."""
    last, _ = sized(df.groupBy(*keys).agg(F.max(cycle).alias("__last")))
    life = F.col("__last") - F.col(cycle)
    if cap is not None:
        life = F.least(life, F.lit(cap))
    return attach(df, last, keys).withColumn("rul", life).drop("__last")


def condition_clusters(
    df: DataFrame,
    setting: str = "op_set1",
    digits: int = 2,
    dataset: str = "dataset_id",
    only: list[str] | None = None,
    name: str = "condition_cluster",
) -> DataFrame:
    """Dense 0-based id of the rounded setting, numbered in each data set; 0 for data sets not in `only`; null where the
    setting of a numbered data set is missing."""
    rounded = F.round(F.col(setting).cast("double"), digits)
    key = rounded if only is None else F.when(F.col(dataset).isin(only), rounded)
    keyed = df.withColumn("__key", key)
    settings, found = sized(keyed.filter(F.col("__key").isNotNull()).select(dataset, "__key").distinct())
    if found <= ROWS_PER_SLICE:
        number = F.row_number().over(W.partitionBy(dataset).orderBy("__key")) - 1
    else:  # a setting with hardly any repeats: numbered by value ranges
        settings = running_sums(settings.withColumn("one", F.lit(1)), [dataset], "__key", ["one"])
        number = F.col("cum_one") - 1
    table = settings.select(dataset, "__key", number.cast("int").alias(name))
    numbered = F.lit(True) if only is None else F.col(dataset).isin(only)
    cluster = F.when(F.col(name).isNotNull(), F.col(name)).when(~F.coalesce(numbered, F.lit(False)), F.lit(0))
    return attach(keyed, table, [dataset, "__key"]).withColumn(name, cluster).drop("__key")


def group_zscore(df: DataFrame, cols: list[str], keys: list[str], eps: float = 1e-6) -> DataFrame:
    """(x - mean) / (sample std + eps) in each group; a group of one row gives null."""
    stats = df.groupBy(*keys).agg(
        *[F.avg(c).alias(f"__m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"__d_{c}") for c in cols]
    )
    stats, _ = sized(stats)
    scaled = {c: (F.col(c) - F.col(f"__m_{c}")) / (F.col(f"__d_{c}") + F.lit(eps)) for c in cols}
    return attach(df, stats, keys).withColumns(scaled).drop(*[f"__{p}_{c}" for c in cols for p in "md"])


def zscore(df: DataFrame, cols: list[str], eps: float = 1e-6) -> DataFrame:
    """The same over the whole table."""
    stats = df.agg(*[F.avg(c).alias(f"__m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"__d_{c}") for c in cols])
    scaled = {c: (F.col(c) - F.col(f"__m_{c}")) / (F.col(f"__d_{c}") + F.lit(eps)) for c in cols}
    return attach_row(df, stats).withColumns(scaled).drop(*[f"__{p}_{c}" for c in cols for p in "md"])


def value_ranges(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row with `<col>_min` and `<col>_max` of every column."""
    return df.agg(
        *[F.min(c).cast("double").alias(f"{c}_min") for c in cols],
        *[F.max(c).cast("double").alias(f"{c}_max") for c in cols],
    )


def minmax(df: DataFrame, cols: list[str], ranges: DataFrame | None = None, suffix: str = "") -> DataFrame:
    """Scale to [0, 1]; a constant column gives 0. Fitted `ranges` (see `value_ranges`) can be passed for scoring."""
    wide = attach_row(df, value_ranges(df, cols) if ranges is None else ranges)
    scaled = {}
    for c in cols:
        low, high = F.col(f"{c}_min"), F.col(f"{c}_max")
        share = (F.col(c).cast("double") - low) / F.nullif(high - low, F.lit(0.0))
        scaled[c + suffix] = F.when(high == low, F.lit(0.0)).otherwise(share)
    return wide.withColumns(scaled).drop(*[f"{c}_{e}" for c in cols for e in ("min", "max")])


def live_scale(col: str, low: float, high: float) -> Column:
    """Min-max with a fixed range, held inside [0, 1]."""
    if high <= low:
        return F.lit(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col(col) - F.lit(low)) / F.lit(high - low)))


def rolling_features(
    df: DataFrame,
    cols: list[str],
    keys: list[str] = ENGINE_KEYS,
    order: list[str] | None = None,
    rows: int = 10,
    velocity: bool = True,
    trend: bool = True,
    limit: int = ROWS_PER_SLICE,
    position: str | None = None,
    trusted: bool = False,
) -> DataFrame:
    """`<c>_velocity` (change since the row before) and `<c>_trend` (mean of `rows` rows, null until full).

    `position` may name a cycle column without gaps (see `over_groups`); `trusted` if the caller has just numbered it.
    """

    def build(frame):
        out = {}
        last = frame.window.rowsBetween(1 - rows, 0)
        for c in cols:
            if velocity:
                out[f"{c}_velocity"] = F.col(c) - F.lag(c, 1).over(frame.window)
            if trend:
                full = F.count(c).over(last) == rows
                out[f"{c}_trend"] = F.when(full, F.avg(c).over(last))
        return out

    return over_groups(df, keys, order or ["cycle"], build, before=max(rows - 1, 1), limit=limit, position=position, trusted=trusted)


def engineered_zscore(df: DataFrame, tags: list[str] = engine.ENGINEERED_TAGS) -> DataFrame:
    """Fill the gaps of all feature columns with 0, then z-score the engineered ones over the table."""
    filled = fill_null(df, select_features(df, engine.NOT_FEATURES, ("double",)), 0.0)
    return zscore(filled, select_features(filled, engine.NOT_FEATURES, ("double",), tags))

"""Projections: renames, casts, fills, clips, selection by schema, point lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of the machine columns in the raw file and here.
MACHINE_NAMES = {
    "Type": "prod_type",
    "Air temperature [K]": "air_temp_k",
    "Process temperature [K]": "proc_temp_k",
    "Rotational speed [rpm]": "rpm",
    "Torque [Nm]": "torque",
    "Tool wear [min]": "tool_wear",
    "Machine failure": "failure",
}


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop the named columns that are present."""
    return df.drop(*names)


def cast_all(df: DataFrame, dtype: str = "double", keep: list[str] | None = None) -> DataFrame:
    keep = keep or []
    return df.select(*[F.col(c) if c in keep else F.col(c).cast(dtype).alias(c) for c in df.columns])


def with_literal(df: DataFrame, name: str, value: object) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def clip(col: str | Column, low: float | None = None, high: float | None = None) -> Column:
    """Value held inside [low, high]; nulls stay null."""
    col = F.col(col) if isinstance(col, str) else col
    out = col
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(col.isNotNull(), out)


def fill_null(df: DataFrame, cols: list[str], value: float = 0.0) -> DataFrame:
    return df.fillna(value, subset=cols)


def ensure_columns(df: DataFrame, names: list[str], value: float = 0.0) -> DataFrame:
    """Add absent columns with a default, so a short input can be scored."""
    return df.withColumns({n: F.lit(value) for n in names if n not in df.columns})


def select_features(
    df: DataFrame, exclude: list[str], dtypes: tuple[str, ...] | None = None, tags: list[str] | None = None
) -> list[str]:
    """Column names by exclusion list, type name and name part; a plan-time choice, no job."""
    chosen = []
    for name, dtype in df.dtypes:
        if name in exclude or (dtypes and dtype not in dtypes):
            continue
        if tags and not any(t in name for t in tags):
            continue
        chosen.append(name)
    return chosen


def global_unit(dataset: str = "dataset_id", unit: str = "unit") -> Column:
    """Engine id that is unique over all data sets."""
    return F.concat_ws("_", F.col(dataset), F.col(unit).cast("int").cast("string"))


def engine_state(df: DataFrame, dataset_id: str, unit: int, cycle: int) -> DataFrame:
    return df.filter((F.col("dataset_id") == dataset_id) & (F.col("unit") == unit) & (F.col("cycle") == cycle))


def engine_list(df: DataFrame, dataset_id: str) -> DataFrame:
    """Engines of a data set with their last cycle."""
    return df.filter(F.col("dataset_id") == dataset_id).groupBy("unit").agg(F.max("cycle").alias("max_cycle"))


def union_parts(parts: list[DataFrame]) -> DataFrame:
    """Stack tables by column name; a column that a part lacks is null there."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out

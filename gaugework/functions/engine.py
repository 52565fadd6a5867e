"""Column expressions for engine cycles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the engine data set: sensors without information, and the ones that are kept.
CONSTANT_SENSORS = ["s1", "s5", "s6", "s10", "s16", "s18", "s19"]
SENSORS = ["s2", "s3", "s4", "s7", "s8", "s9", "s11", "s12", "s13", "s14", "s15", "s17", "s20", "s21"]
RAW_COLUMNS = ["unit", "cycle", "op_set1", "op_set2", "op_set3"] + [f"s{i}" for i in range(1, 22)]
MULTI_CONDITION = ["FD002", "FD004"]
# The number of each data set, the name parts of engineered columns, the columns that are no features.
DATASET_CODES = {"FD001": 0, "FD002": 1, "FD003": 2, "FD004": 3}
ENGINEERED_TAGS = ["velocity", "trend", "thermal", "pressure", "efficiency", "compressor"]
NOT_FEATURES = ["unit", "cycle", "dataset_id", "condition_cluster", "rul"]
RUL_CAP = 125


def dataset_code(column: str = "dataset_id") -> Column:
    """Number of the data set; an unknown or missing one is 0."""
    codes = F.create_map(*(F.lit(x) for pair in DATASET_CODES.items() for x in pair))
    return F.coalesce(F.try_element_at(codes, F.col(column)), F.lit(0))


def physics() -> dict[str, Column]:
    """Interaction features of the temperature, pressure and speed sensors."""
    return {
        "thermal_stress": F.col("s11") * F.col("s15"),
        "pressure_heat_index": F.col("s4") * F.col("s11"),
        "efficiency_proxy": F.col("s9") / (F.col("s8") + F.lit(1e-6)),
        "compressor_delta": F.col("s3") - F.col("s2"),
    }

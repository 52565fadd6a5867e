"""Files in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugework.functions.engine import RAW_COLUMNS

MACHINE_SCHEMA = T.StructType(
    [
        T.StructField("UDI", T.LongType()),
        T.StructField("Product ID", T.StringType()),
        T.StructField("Type", T.StringType()),
        T.StructField("Air temperature [K]", T.DoubleType()),
        T.StructField("Process temperature [K]", T.DoubleType()),
        T.StructField("Rotational speed [rpm]", T.LongType()),
        T.StructField("Torque [Nm]", T.DoubleType()),
        T.StructField("Tool wear [min]", T.LongType()),
        T.StructField("Machine failure", T.LongType()),
        *[T.StructField(m, T.LongType()) for m in ("TWF", "HDF", "PWF", "OSF", "RNF")],
    ]
)


def _fields(text: str) -> Column:
    return F.split(F.regexp_replace(F.col(text), r"^\s+|\s+$", ""), r"\s+")


def bad_lines(lines: DataFrame, columns: list[str] = RAW_COLUMNS, text: str = "value") -> DataFrame:
    """One row: lines, those with too few fields, and those with a field that is no number."""
    fields = lines.select(_fields(text).alias("p"))
    short = F.size("p") < len(columns)
    odd = F.exists(F.slice("p", 1, len(columns)), lambda x: x.try_cast("double").isNull())
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    return fields.agg(F.count(F.lit(1)).alias("lines"), count(short).alias("short"), count(~short & odd).alias("odd"))


def parse_cycles(lines: DataFrame, columns: list[str] = RAW_COLUMNS, text: str = "value") -> DataFrame:
    """Blank-separated numbers to columns; shorter lines are dropped, surplus fields ignored. Engine and cycle
    numbers become longs; what is no number becomes null (`bad_lines` counts such lines)."""
    parts = lines.select(_fields(text).alias("p")).filter(F.size("p") >= len(columns))
    cells = [F.element_at("p", i + 1).try_cast("double") for i in range(len(columns))]
    return parts.select(
        *[(c.cast("long") if name in ("unit", "cycle") else c).alias(name) for name, c in zip(columns, cells)]
    )


def read_cycles(spark: SparkSession, path: str, columns: list[str] = RAW_COLUMNS) -> DataFrame:
    return parse_cycles(spark.read.text(path), columns)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def read_machines(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, MACHINE_SCHEMA)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Overwrite a Parquet table and return it as read back, so that what follows starts from the stored rows."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_report(df: DataFrame, path: str) -> None:
    """Nested record(s) as JSON lines."""
    df.write.mode("overwrite").json(path)


def read_report(
    spark: SparkSession, path: str, schema: str, defaults: dict[str, object] | None = None, multi_line: bool = True
) -> DataFrame:
    """JSON report with a fixed schema; absent fields take their default. Keys of `defaults` are field paths.

    `multi_line` is for one pretty-printed document per file, its opposite for what `write_report` stores.
    """
    raw = spark.read.json(path, schema=schema, multiLine=multi_line)
    return with_defaults(raw, defaults or {})


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """One column per field path (dots become underscores), null replaced by the default."""
    return df.withColumns({p.replace(".", "_"): F.coalesce(F.col(p), F.lit(v)) for p, v in defaults.items()})


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def present_inputs(spark: SparkSession, paths: dict[str, str]) -> dict[str, bool]:
    return {name: path_exists(spark, path) for name, path in paths.items()}


def read_parts(spark: SparkSession, paths: list[str], on_missing: str = "skip") -> DataFrame:
    """Parquet parts stacked by column name. Missing ones are skipped (or raise); none at all raises."""
    found = [p for p in paths if path_exists(spark, p)]
    if not found or (on_missing == "raise" and len(found) < len(paths)):
        raise FileNotFoundError(f"missing parts: {sorted(set(paths) - set(found))}")
    out = spark.read.parquet(found[0])
    for p in found[1:]:
        out = out.unionByName(spark.read.parquet(p), allowMissingColumns=True)
    return out

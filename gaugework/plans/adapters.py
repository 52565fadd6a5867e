"""Views that give the driver's tables the shape of machine and engine cycles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugework.operators.ordered import group_index


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series of cycles per user of `events`; unit numbers restart in each of the four data sets."""
    ev = table(spark, sf_dir, "events")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("double")
    value = F.col("value")
    shaped = ev.select(
        "event_id",
        "ts",
        F.concat(F.lit("FD00"), (F.col("user_id") % 4 + 1).cast("string")).alias("dataset_id"),
        F.floor(F.col("user_id") / 4).cast("long").alias("unit"),
        ((F.col("event_id") % 6) * 7.0 + (F.col("event_id") % 3) * 0.001).alias("op_set1"),
        value.alias("s2"),
        (value * 1.5 + k).alias("s3"),
        k.alias("s4"),
        (k % 7 + 1.0).alias("s8"),
        (value + k * 2.0).alias("s9"),
        (value / (k + 1.37)).alias("s11"),
        (k / 100.0 + 0.5).alias("s15"),
        (F.col("event_type") == "error").cast("int").alias("label"),
    )
    return group_index(shaped, ["dataset_id", "unit"], ["ts", "event_id"], pos="cycle").drop("ts")


def machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Machine readings from `lineitem`; it has no unique row key."""
    wear = F.col("l_partkey") % 254
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
        .cast("long").alias("prod_type"),
        (F.lit(3.8) + F.col("l_quantity")).alias("torque"),
        (F.lit(1168) + F.floor(F.col("l_extendedprice")) % 1700).cast("long").alias("rpm"),
        wear.alias("tool_wear"),
        (F.lit(23.0) + F.col("l_discount") * 50).alias("air_temp_c"),
        (F.lit(31.5) + F.col("l_discount") * 50 + F.col("l_tax") * 40).alias("proc_temp_c"),
        ((F.col("l_linestatus") == "F") & (wear > 100)).cast("long").alias("failure"),
    )


def machine_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw machine table with its row id from `orders`, in the column names of the source file."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    cents = F.floor(F.col("o_totalprice"))
    fail = F.col("o_orderstatus") == "P"
    return o.select(
        key.alias("UDI"),
        F.concat(F.lit("M"), key.cast("string")).alias("Product ID"),
        F.when(key % 3 == 0, "L").when(key % 3 == 1, "M").otherwise("H").alias("Type"),
        (F.lit(295.5) + (cents % 70) / 10.0).alias("Air temperature [K]"),
        (F.lit(305.75) + (cents % 65) / 10.0).alias("Process temperature [K]"),
        (F.lit(1168) + cents % 1700).cast("long").alias("Rotational speed [rpm]"),
        (F.lit(4.25) + (F.col("o_custkey") % 70)).alias("Torque [Nm]"),
        (key % 254).alias("Tool wear [min]"),
        fail.cast("long").alias("Machine failure"),
        (fail & (key % 254 > 200)).cast("long").alias("TWF"),
        (fail & (key % 5 == 1)).cast("long").alias("HDF"),
        (fail & (key % 5 == 2)).cast("long").alias("PWF"),
        (fail & (key % 5 == 3)).cast("long").alias("OSF"),
        (fail & (key % 50 == 7)).cast("long").alias("RNF"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores, labels and flags per event."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        (F.col("value") / (F.col("value") + 1.0)).alias("score"),
        (F.col("event_type") == "error").cast("int").alias("label"),
        (F.col("value") > 60).cast("int").alias("flag"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("double").alias("k"),
        F.hour("ts").cast("double").alias("hour"),
    )


def lifetimes(cyc: DataFrame) -> DataFrame:
    """Lifetime of each unit and its fleet: units with an even number are managed, every seventh is censored."""
    managed = F.col("unit") % 2 == 0
    last = F.max("cycle")
    return cyc.groupBy("dataset_id", "unit").agg(last.alias("last")).select(
        "dataset_id",
        "unit",
        F.when(managed, "managed").otherwise("unmanaged").alias("fleet"),
        F.when(managed, F.col("last") + F.floor(F.col("last") / 10)).otherwise(F.col("last")).alias("lifetime"),
        (F.col("unit") % 7 == 0).alias("censored"),
    )

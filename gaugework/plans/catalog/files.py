"""Readers and writers, run through files in the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugework.operators import features as X
from gaugework.operators import summary as S
from gaugework.operators import survival as V
from gaugework.plans import adapters as A
from gaugework.plans.catalog.registry import oracle, r, register, tidy
from gaugework.plans.catalog.rules import LIVE_SQL, live_output
from gaugework.plans.catalog.summaries import CURVE
from gaugework.session import scratch_path
from gaugework.sources import tables as IO
from gaugework.streaming.live import run_stream, stream_table

FIELDS = ["unit", "cycle", "op_set1", "s2", "s3", "s4"]


def _lines(spark, sf_dir):
    """Cycles as text lines with ragged blanks; every tenth line lacks its last field."""
    cells = [F.col(c).cast("string") for c in FIELDS]
    whole = F.concat(F.lit("  "), F.concat_ws("   ", *cells), F.lit(" 7.5  "))
    short = F.concat_ws(" ", *cells[:-1])
    return A.cycles(spark, sf_dir).select(F.when(F.col("event_id") % 10 == 0, short).otherwise(whole).alias("value"))


PARSED = oracle(
    f"SELECT unit, cycle, {r('op_set1')} AS op_set1, {r('s2')} AS s2, {r('s3')} AS s3, {r('s4')} AS s4 FROM cycles WHERE event_id % 10 <> 0",
    "cycles",
)


@register("parse_cycles", PARSED)
def parse_cycles(spark, sf_dir):
    return tidy(IO.parse_cycles(_lines(spark, sf_dir), FIELDS))


@register("text_scan", PARSED)
def text_scan(spark, sf_dir):
    path = scratch_path(spark, "cycles-text")
    _lines(spark, sf_dir).write.text(path)
    return tidy(IO.read_cycles(spark, path, FIELDS))


@register(
    "machine_csv",
    oracle(
        f"""SELECT udi AS "UDI", type_code AS "Type", {r("air_temp_k")} AS air_temp_k, rpm, {r("torque")} AS torque, tool_wear, failure,
  TWF AS "TWF", RNF AS "RNF" FROM machine_log""",
        "machine_log",
    ),
)
def machine_csv(spark, sf_dir):
    path = scratch_path(spark, "machines-csv")
    IO.write_csv(A.machine_log(spark, sf_dir), path)
    df = IO.read_machines(spark, path)
    return tidy(
        df.select(
            "UDI", "Type", F.col("Air temperature [K]").alias("air_temp_k"), F.col("Rotational speed [rpm]").alias("rpm"),
            F.col("Torque [Nm]").alias("torque"), F.col("Tool wear [min]").alias("tool_wear"),
            F.col("Machine failure").alias("failure"), "TWF", "RNF",
        )
    )


@register(
    "partitioned_table",
    oracle(f"SELECT event_id, dataset_id, {r('s2')} AS s2 FROM cycles WHERE dataset_id = 'FD003'", "cycles"),
)
def partitioned_table(spark, sf_dir):
    """Overwrite a table partitioned by data set, then read one partition of it."""
    stored = IO.write_table(A.cycles(spark, sf_dir), scratch_path(spark, "cycles"), ["dataset_id"])
    return tidy(stored.filter(F.col("dataset_id") == "FD003").select("event_id", "dataset_id", "s2"))


@register(
    "read_parts",
    oracle("SELECT dataset_id, count(*) AS \"rows\" FROM cycles WHERE dataset_id <> 'FD002' GROUP BY 1", "cycles"),
)
def read_parts(spark, sf_dir):
    """Merge the stored parts; the second one was never written and is skipped."""
    base = scratch_path(spark, "parts")
    df = A.cycles(spark, sf_dir)
    for name in ("FD001", "FD003", "FD004"):
        IO.write_table(df.filter(F.col("dataset_id") == name).select("dataset_id", "s2"), f"{base}/{name}")
    merged = IO.read_parts(spark, [f"{base}/{name}" for name in ("FD001", "FD002", "FD003", "FD004")])
    return S.group_counts(merged, ["dataset_id"])


@register(
    "result_csv",
    oracle(f"SELECT fleet, cycle, active, {r('pct')} AS survival_pct FROM curve", "lifetimes", ctes=CURVE),
)
def result_csv(spark, sf_dir):
    path = scratch_path(spark, "survival-csv")
    IO.write_csv(V.survival_curve(A.lifetimes(A.cycles(spark, sf_dir)), "fleet"), path)
    return tidy(IO.read_csv(spark, path, "fleet string, cycle long, active long, survival_pct double"))


@register(
    "report_defaults",
    oracle(
        f"""SELECT event_type, {r("coalesce(CASE WHEN n % 2 = 0 THEN m END, -1)")} AS effect_coefficient,
  coalesce(CASE WHEN n % 2 = 0 THEN true END, false) AS effect_reliable, 200.0::DOUBLE AS effect_danger, n AS "rows"
FROM (SELECT event_type, avg(value) AS m, count(*) AS n FROM scored GROUP BY 1)""",
        "scored",
    ),
)
def report_defaults(spark, sf_dir):
    """Nested reports where some lack their effect, and none has the danger field."""
    path = scratch_path(spark, "reports")
    sums = A.scored(spark, sf_dir).groupBy("event_type").agg(F.avg("value").alias("m"), F.count(F.lit(1)).alias("rows"))
    effect = F.struct(F.col("m").alias("coefficient"), F.lit(True).alias("reliable"))
    IO.write_report(sums.select("event_type", "rows", F.when(F.col("rows") % 2 == 0, effect).alias("effect")), path)
    schema = "event_type string, rows long, effect struct<coefficient: double, reliable: boolean, danger: double>"
    defaults = {"effect.coefficient": -1.0, "effect.reliable": False, "effect.danger": 200.0}
    df = IO.read_report(spark, path, schema, defaults, multi_line=False)
    return tidy(df.drop("effect"))


@register("live_stream", LIVE_SQL)
def live_stream(spark, sf_dir):
    """The live readings as a stream over the stored table, run until its input is used up."""
    source = scratch_path(spark, "stream-in")
    IO.write_table(A.machines(spark, sf_dir), source)
    out = scratch_path(spark, "stream-out")
    schema = A.machines(spark, sf_dir).schema
    run_stream(stream_table(spark, source, schema), live_output, out, scratch_path(spark, "stream-state")).awaitTermination()
    return IO.read_table(spark, out)


@register(
    "clean_table",
    oracle(
        f"SELECT prod_type, count(*) AS \"rows\", {r('avg(power_w)', 4)} AS mean_power FROM clean_log GROUP BY 1",
        "clean_log",
    ),
)
def clean_table(spark, sf_dir):
    """CSV in, clean Parquet out, read again for a summary: the first stage from end to end."""
    path = scratch_path(spark, "raw-csv")
    IO.write_csv(A.machine_log(spark, sf_dir), path)
    stored = IO.write_table(X.clean_machines(IO.read_machines(spark, path)), scratch_path(spark, "clean"))
    return tidy(stored.groupBy("prod_type").agg(F.count(F.lit(1)).alias("rows"), F.avg("power_w").alias("mean_power")), 4)

"""Files, defaults, missing parts, and the stream."""

import json

import pytest
from pyspark.sql import functions as F

from gaugework.operators.columns import engine_list, engine_state
from gaugework.plans.engines import build_engine_table
from gaugework.sources import tables as IO
from gaugework.streaming.live import run_stream, score_readings, stream_table


def line(unit, cycle, n=26):
    return "  " + "   ".join([f"{unit}", f"{cycle}"] + [f"{(unit * 7 + cycle * 3 + i) % 11}.5" for i in range(n - 2)]) + "  "


def test_cycles_text(spark, tmp_path):
    path = tmp_path / "train.txt"
    path.write_text("\n".join([line(1, 1), line(1, 2, 25), line(2, 1, 28), "", line(2, 2)]) + "\n")
    df = IO.read_cycles(spark, str(path))
    assert df.count() == 3 and len(df.columns) == 26
    assert dict(df.dtypes)["unit"] == "bigint" and dict(df.dtypes)["s21"] == "double"


def test_raw_files_to_feature_table(spark, tmp_path):
    paths = {}
    for name in ("FD001", "FD002"):
        file = tmp_path / f"{name}.txt"
        file.write_text("\n".join(line(u, c) for u in (1, 2, 3) for c in range(1, 26)) + "\n")
        paths[name] = str(file)
    out = build_engine_table(spark, paths, str(tmp_path / "out"))
    assert out.count() == 150 and len(out.columns) == 54
    assert engine_list(out, "FD002").count() == 3
    assert engine_state(out, "FD001", 2, 5).count() == 1


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(0, 50, 99.5)], "cycle long, active long, pct double")
    IO.write_csv(df, str(tmp_path / "c"))
    assert IO.read_csv(spark, str(tmp_path / "c"), df.schema).collect() == df.collect()


def test_report_defaults(spark, tmp_path):
    file = tmp_path / "causal.json"
    file.write_text(json.dumps({"tool_wear_effect": {"effect_per_10_minutes_pct": 0.31}}, indent=2))
    schema = "tool_wear_effect struct<effect_per_10_minutes_pct: double, danger_threshold_minutes: double>"
    defaults = {"tool_wear_effect.effect_per_10_minutes_pct": 0.305, "tool_wear_effect.danger_threshold_minutes": 200.0}
    row = IO.read_report(spark, str(file), schema, defaults).first()
    assert row["tool_wear_effect_effect_per_10_minutes_pct"] == 0.31
    assert row["tool_wear_effect_danger_threshold_minutes"] == 200.0


def test_nested_report_round_trip(spark, tmp_path):
    df = spark.range(1).select(F.struct(F.lit(1.5).alias("coefficient"), F.struct(F.lit(True).alias("passed")).alias("placebo")).alias("effect"))
    IO.write_report(df, str(tmp_path / "r"))
    back = IO.read_report(spark, str(tmp_path / "r"), "effect struct<coefficient: double, placebo: struct<passed: boolean>>", multi_line=False)
    assert back.select("effect.placebo.passed").first()[0] is True


def test_missing_parts(spark, tmp_path):
    IO.write_table(spark.createDataFrame([("FD001", 1)], "dataset_id string, a int"), str(tmp_path / "p1"))
    IO.write_table(spark.createDataFrame([("FD003", 2.0)], "dataset_id string, b double"), str(tmp_path / "p3"))
    paths = [str(tmp_path / p) for p in ("p1", "p2", "p3")]
    merged = IO.read_parts(spark, paths)
    assert merged.count() == 2 and set(merged.columns) == {"dataset_id", "a", "b"}
    with pytest.raises(FileNotFoundError):
        IO.read_parts(spark, paths, "raise")
    with pytest.raises(FileNotFoundError):
        IO.read_parts(spark, paths[1:2])


def test_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    IO.write_table(spark.range(5), path)
    assert IO.write_table(spark.range(2), path).count() == 2


def test_stream_equals_batch(spark, tmp_path):
    df = spark.createDataFrame(
        [(0, 40.0, 1500, 100, 25.0, 33.0, 0), (2, 60.0, 2800, 210, 25.0, 36.0, 1)],
        "prod_type long, torque double, rpm long, tool_wear long, air_temp_c double, proc_temp_c double, failure long",
    )
    IO.write_table(df, str(tmp_path / "in"))
    query = run_stream(stream_table(spark, str(tmp_path / "in"), df.schema), score_readings, str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out")).orderBy("rpm").collect()
    batch = score_readings(df).orderBy("rpm").collect()
    assert [r.asDict() for r in streamed] == [r.asDict() for r in batch]
    assert batch[0]["heat_risk"] and not batch[1]["heat_risk"] and batch[1]["power_risk"]

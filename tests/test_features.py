"""Hand-computed features: order of filling and scaling, sample spreads, window edges, group boundaries."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugework.functions import machine
from gaugework.operators import features as X
from gaugework.operators.columns import clip, ensure_columns, select_features, union_parts
from gaugework.operators.smoothing import savgol, taps
from gaugework.plans.engines import clean_cycles, engine_features, feature_contract


def series(spark, values, ds="FD001", unit=1):
    return spark.createDataFrame([(ds, unit, i + 1, float(v)) for i, v in enumerate(values)], "dataset_id string, unit long, cycle long, s2 double")


def col(df, name, order="cycle"):
    return [r[name] for r in df.orderBy(order).collect()]


def test_units_with_the_same_number_do_not_share_a_window(spark):
    df = series(spark, [1, 2, 4]).unionByName(series(spark, [100, 200], "FD002"))
    out = X.rolling_features(df, ["s2"], rows=2)
    assert col(out.filter("dataset_id = 'FD002'"), "s2_velocity") == [None, 100.0]
    assert col(out.filter("dataset_id = 'FD002'"), "s2_trend") == [None, 150.0]


def test_trend_is_null_until_the_window_is_full_then_zero_is_filled_before_scaling(spark):
    df = series(spark, range(12)).withColumn("rul", F.lit(1))
    rolled = X.rolling_features(df, ["s2"])
    assert col(rolled, "s2_trend") == [None] * 9 + [4.5, 5.5, 6.5]
    scaled = X.engineered_zscore(rolled, ["trend"])
    filled = np.array([0.0] * 9 + [4.5, 5.5, 6.5])
    expected = (filled - filled.mean()) / (filled.std(ddof=1) + 1e-6)
    assert np.allclose(col(scaled, "s2_trend"), expected)
    assert abs(expected[0]) > 0.1


def test_order_is_the_cycle_and_not_the_file(spark):
    df = series(spark, [1, 2, 4, 8]).orderBy(F.desc("cycle"))
    assert col(X.rolling_features(df, ["s2"], trend=False), "s2_velocity") == [None, 1.0, 2.0, 4.0]


def test_group_zscore_uses_the_sample_spread_and_a_lone_row_gives_null(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 5.0)], "g int, x double")
    out = X.group_zscore(df, ["x"], ["g"]).orderBy("g", "x").collect()
    assert out[1]["x"] == pytest.approx(1 / (math.sqrt(2) + 1e-6))
    assert out[2]["x"] is None or math.isnan(out[2]["x"])


def test_null_key_is_a_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), (1, 5.0), (1, 9.0)], "g int, x double")
    assert X.group_zscore(df, ["x"], ["g"]).filter("x is null").count() == 0


def test_clusters_follow_the_rounded_setting_in_the_listed_data_sets(spark):
    rows = [("FD002", 0.001), ("FD002", 20.0), ("FD002", 10.004), ("FD002", 10.003), ("FD001", 33.0), ("FD004", 42.0)]
    df = spark.createDataFrame(rows, "dataset_id string, op_set1 double")
    out = X.condition_clusters(df, only=["FD002", "FD004"])
    got = {(r["dataset_id"], r["op_set1"]): r["condition_cluster"] for r in out.collect()}
    assert got == {
        ("FD002", 0.001): 0, ("FD002", 10.003): 1, ("FD002", 10.004): 1, ("FD002", 20.0): 2, ("FD001", 33.0): 0, ("FD004", 42.0): 0,
    }
    assert dict(out.dtypes)["condition_cluster"] == "int"


def test_remaining_life_and_cap(spark):
    assert col(X.remaining_life(series(spark, [0] * 4)), "rul") == [3, 2, 1, 0]
    assert col(X.remaining_life(series(spark, [0] * 4), cap=2), "rul") == [2, 2, 1, 0]


def test_minmax_constant_is_zero_and_targets_stay(spark):
    df = spark.createDataFrame([(1, 5.0, 0), (3, 5.0, 1)], "a long, b double, failure long")
    out = X.minmax(df, ["a", "b"]).orderBy("failure").collect()
    assert [(r["a"], r["b"], r["failure"]) for r in out] == [(0.0, 0.0, 0), (1.0, 0.0, 1)]


def test_minmax_with_fitted_ranges(spark):
    train = spark.createDataFrame([(0.0,), (10.0,)], "a double")
    new = spark.createDataFrame([(5.0,)], "a double")
    assert X.minmax(new, ["a"], X.value_ranges(train, ["a"])).first()["a"] == 0.5


def test_stress_index_by_data_or_fixed_maxima(spark):
    df = spark.createDataFrame([(0, 10.0, 1000, 5, 1.0, 2.0), (0, 20.0, 2000, 5, 1.0, 2.0)],
                               "prod_type long, torque double, rpm long, tool_wear long, air_temp_c double, proc_temp_c double")
    assert X.machine_physics(df).orderBy("rpm").first()["stress_index"] == 0.25
    assert X.machine_physics(df, 75.0, 2800.0).orderBy("rpm").first()["stress_index"] == pytest.approx(10 / 75 * 1000 / 2800)


def test_taps_reproduce_cubics():
    x = np.arange(11.0)
    cubic = 2 * x**3 - x**2 + 5
    assert np.allclose(taps(11, 3) @ cubic, cubic)
    assert np.allclose(taps(11, 3)[5] * 429, [-36, 9, 44, 69, 84, 89, 84, 69, 44, 9, -36])


def test_smoothing_edges_and_short_series(spark):
    x = [math.sin(i) * 10 + i for i in range(25)]
    out = col(savgol(series(spark, x), ["s2"], ["unit"], ["cycle"]), "s2_smooth")
    w = taps(11, 3)
    expected = [w[i] @ x[:11] for i in range(5)] + [w[5] @ x[i - 5 : i + 6] for i in range(5, 20)] + [w[6 + i] @ x[14:] for i in range(5)]
    assert np.allclose(out, expected)
    assert col(savgol(series(spark, x[:10]), ["s2"], ["unit"], ["cycle"]), "s2_smooth") == x[:10]


def test_clip_select_ensure_union(spark):
    df = spark.createDataFrame([(-3.0,), (None,), (200.0,)], "x double")
    assert [r[0] for r in df.select(clip("x", 0.0, 125.0)).collect()] == [0.0, None, 125.0]
    wide = spark.createDataFrame([(1, 2.0, "a", 3.0)], "id long, s2_trend double, t string, s2 double")
    assert select_features(wide, ["id"], ("double",)) == ["s2_trend", "s2"]
    assert select_features(wide, [], None, ["trend"]) == ["s2_trend"]
    assert ensure_columns(wide, ["s2", "s9"]).first()["s9"] == 0.0
    both = union_parts([wide, spark.createDataFrame([(2, 9)], "id long, extra int")]).orderBy("id").collect()
    assert both[0]["extra"] is None and both[1]["s2"] is None


def test_machine_expressions(spark):
    raw = spark.createDataFrame(
        [(1, "M1", "L", 298.15, 308.15, 1500, 40.0, 100, 0, 0, 0, 0, 0, 0)],
        "UDI long, `Product ID` string, Type string, `Air temperature [K]` double, `Process temperature [K]` double, "
        "`Rotational speed [rpm]` long, `Torque [Nm]` double, `Tool wear [min]` long, `Machine failure` long, "
        "TWF long, HDF long, PWF long, OSF long, RNF long",
    )
    clean = X.clean_machines(raw)
    row = clean.first()
    assert row["prod_type"] == 0 and row["air_temp_c"] == pytest.approx(25.0)
    assert row["power_w"] == pytest.approx(40 * 1500 * 2 * math.pi / 60)
    assert len(clean.columns) == 14  # the thirteen of the source and the row id
    margin = clean.select(machine.overstrain_margin().alias("m"), machine.overstrain_margin_pct().alias("p")).first()
    assert margin["m"] == 7000.0 and margin["p"] == pytest.approx((1 - 4000 / 11000) * 100)


def test_type_limits_follow_the_code(spark):
    df = spark.createDataFrame([(0,), (1,), (2,)], "prod_type long")
    assert [r[0] for r in df.select(machine.overstrain_limit()).collect()] == [11000, 12000, 13000]


def test_pipeline_contract(spark):
    rng = np.random.default_rng(1)
    rows = [
        (ds, u, c, float(rng.choice([0.0, 10.0, 20.0]) + rng.uniform(0, 0.003)), *map(float, rng.normal(size=14)))
        for ds in ("FD001", "FD002")
        for u in range(1, 4)
        for c in range(1, 31)
    ]
    sensors = ["s2", "s3", "s4", "s7", "s8", "s9", "s11", "s12", "s13", "s14", "s15", "s17", "s20", "s21"]
    df = spark.createDataFrame(rows, "dataset_id string, unit long, cycle long, op_set1 double, " + ", ".join(f"{s} double" for s in sensors))
    feats = engine_features(clean_cycles(df))
    assert len([c for c in feats.columns if c.endswith(("_velocity", "_trend"))]) == 28
    assert all(r["passed"] for r in feature_contract(feats).collect())
    stats = feats.agg(F.avg("thermal_stress"), F.stddev_samp("thermal_stress")).first()
    assert abs(stats[0]) < 1e-9 and stats[1] == pytest.approx(1.0, abs=1e-4)

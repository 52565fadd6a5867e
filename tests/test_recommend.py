"""Setpoints against worked-out values and brute force; interventions; causal arithmetic."""

import math

import pytest
from pyspark.sql import functions as F

from gaugework.functions import machine
from gaugework.operators import causal as K
from gaugework.operators import recommend as R

LIMITS = {0: 11000, 1: 12000, 2: 13000}
GOLDEN = [  # wear, target, types, danger, torque, lowest rpm, watts
    (0, 8000, "LMH", 240, 66, 1200, 8293.80),
    (100, 7500, "LMH", 240, 62, 1200, 7791.15),
    (180, 7000, "L", 240, 48, 1320, 6635.04),
    (180, 7000, "M", 240, 53, 1200, 6660.18),
    (180, 7000, "H", 240, 57, 1200, 7162.83),
    (210, 6000, "LMH", 240, 40, 1358, 5688.38),
    (235, 5000, "L", 240, 37, 1223, 4738.67),
    (235, 5000, "MH", 240, 40, 1200, 5026.55),
    (210, 6000, "LMH", 200, 35, 1551, 5684.71),
    (235, 5000, "LMH", 200, 35, 1293, 4739.09),
]


def test_golden_setpoints(spark):
    rows = [(w, "LMH".index(c), float(t), float(d), q, rpm, p) for w, t, cs, d, q, rpm, p in GOLDEN for c in cs]
    df = spark.createDataFrame(rows, "tool_wear long, prod_type long, target double, danger double, q int, r int, p double")
    out = R.setpoints(df, target="target", danger=F.col("danger")).collect()
    for r in out:
        assert (r["torque_nm"], r["setpoint_rpm"]) == (r["q"], r["r"]) and r["status"] == "OPTIMAL"
        assert round(r["setpoint_power_w"], 2) == r["p"]


def brute(wear, ptype, target, danger):
    """All integer pairs, first feasible target by 1000 W steps."""
    cap = max(10, min(75, int(LIMITS[ptype] * 0.8 / max(wear, 1))))
    cap = min(cap, 40 if wear >= 200 else 75, 35 if wear >= danger else 75)
    while True:
        product = int(target * 1000 / 105)
        slack = int(product * 0.05)
        best = None
        for q in range(cap, 9, -1):
            ok = [r for r in range(1200, 2801) if product - slack <= q * r <= product + slack and 3500000 <= q * r * 105 <= 9000000]
            if ok:
                best = (q, ok[0])
                break
        if best or target <= 4000:
            return best, target
        target -= 1000


def test_setpoints_match_brute_force(spark):
    asks = [(w, p, float(t), 200.0) for w in (0, 60, 130, 199, 200, 251, 900) for p in (0, 2) for t in (1500, 3400, 4000, 4500, 8999, 9420, 9480, 14250)]
    df = spark.createDataFrame(asks, "tool_wear long, prod_type long, target double, danger double")
    for r in R.setpoints(df, target="target", danger=F.col("danger")).collect():
        best, goal = brute(r["tool_wear"], r["prod_type"], r["target"], 200)
        assert r["target_power_w"] == goal
        if best is None:
            assert (r["status"], r["torque_nm"], r["setpoint_rpm"], r["urgency"]) == ("INFEASIBLE", 0, 0, "CRITICAL")
        else:
            assert (r["torque_nm"], r["setpoint_rpm"]) == best


def test_nearest_scenario_prefers_less_wear_on_ties(spark):
    df = spark.createDataFrame([(50,), (51,), (140,), (195,), (300,)], "tool_wear long")
    names = [r[0] for r in df.select(R.nearest_scenario()).collect()]
    assert names == ["New tool", "Mid-life tool", "Mid-life tool", "Approaching TWF onset", "Near end of life"]
    assert df.select(R.nearest_scenario(tolerance=10)).first()[0] is None


def test_interventions(spark):
    df = spark.createDataFrame([(10.0, 1.0), (45.0, 2.0), (70.0, 0.1), (100.0, 3.0), (60.0, -2.0)], "rul double, ts double")
    out = {r["rul"]: r for r in R.interventions(df, "ts", "rul", -8.6275, True).collect()}
    assert out[10.0]["best_stress"] == pytest.approx(0.6) and out[10.0]["causal_gain"] == pytest.approx(8.6275 * 0.4)
    assert out[45.0]["stress_reduction_pct"] == pytest.approx(30.0)
    assert {out[k]["status"] for k in (70.0, 100.0, 60.0)} == {"NO_INTERVENTION_NEEDED"}  # small or negative stress is left alone
    assert R.interventions(df, "ts", "rul", -8.6275).first()["status"] == "CAUSAL_UNRELIABLE"  # unproven by default
    text = R.interventions(df, "ts", "rul", -8.6275, True).select(R.intervention_text("rul")).first()[0]
    assert text.startswith("CRITICAL: take 40% off the thermal stress;")


def test_what_if_scales_by_the_root(spark):
    df = spark.createDataFrame([(2.0, 3.0, 6.0, 1.5)], "s11 double, s15 double, thermal_stress double, best_stress double")
    r = R.what_if_inputs(df).first()
    assert (r["s11"], r["s15"], r["thermal_stress"]) == (1.0, 1.5, 1.5)


def test_bands(spark):
    df = spark.createDataFrame([(19.9,), (20.0,), (50.0,), (80.0,)], "x double")
    assert [r[0] for r in df.select(machine.life_urgency("x")).collect()] == ["CRITICAL", "WARNING", "CAUTION", "NORMAL"]
    wear = spark.createDataFrame([(149,), (150,), (200,), (230,)], "w long")
    assert [r[0] for r in wear.select(machine.wear_urgency("w", F.lit(230))).collect()] == ["NORMAL", "CAUTION", "WARNING", "CRITICAL"]
    assert [r[0] for r in wear.select(machine.target_power("w")).collect()] == [7500.0, 7000.0, 6000.0, 5000.0]


def test_danger_threshold_clamps(spark):
    one = spark.range(1)
    cases = [(0.5, 0.05, 0.0, 200.0, 40.0), (-0.1, 0.05, 0.0, 200.0, 240.0), (0.01, 0.05, 0.0, 200.0, 200.0), (0.5, 0.3, 10.0, 200.0, 10.0)]
    for effect, base, low, high, want in cases:
        got = one.select(K.danger_threshold(F.lit(effect), F.lit(base), F.lit(low), F.lit(high))).first()[0]
        assert got == pytest.approx(want)


def test_effect_recovers_a_planted_coefficient_and_survives_redundant_confounders(spark):
    rows = [(float(i % 7), float(i % 5), float((i % 7) * 2)) for i in range(700)]
    df = spark.createDataFrame(rows, "t double, z double, t2 double").withColumn("y", 3 * F.col("t") - 4 * F.col("z") + 1)
    assert K.effect(df, "t", "y", ["z"]).first()["effect"] == pytest.approx(3.0)
    doubled = df.withColumns({"z2": F.col("z") * 2, "one": F.lit(1.0)})
    assert K.effect(doubled, "t", "y", ["z", "z2", "one"]).first()["effect"] == pytest.approx(3.0)
    assert K.effect(df, "t", "y", ["t2"]).first()["effect"] is None  # the treatment is its own confounder


def test_refutations_tell_a_real_effect(spark):
    df = spark.range(3000).withColumns({"t": F.rand(1), "z": F.rand(2)}).withColumn("y", 5 * F.col("t") + F.col("z") + F.rand(3))
    df = df.cache()
    report = K.refutation_report(df, "id", "t", "y", ["z"], reps=5).first()
    assert report["reliable"] and report["original_effect"] == pytest.approx(5.0, abs=0.1)


def test_setpoint_text_and_lookup(spark):
    df = spark.createDataFrame([(0, 1), (900, 0)], "tool_wear long, prod_type long")
    out = R.setpoints(df).withColumn("text", R.setpoint_text()).orderBy("tool_wear").collect()
    assert out[0]["text"] == "To reach 8000 W run at 1200 rpm and 66 Nm, which gives 8294 W and leaves 100.0% of the overstrain limit (NORMAL)."
    assert out[1]["status"] == "INFEASIBLE" and out[1]["text"].startswith("No speed and torque")
    grid = R.setpoints(R.scenario_table(spark.range(1)), target="target")
    assert grid.count() == 15 and grid.filter("status = 'OPTIMAL'").count() == 15
    asks = spark.createDataFrame([("m", 95), ("Q", 10)], "type_code string, tool_wear long")
    got = {r["type_code"]: r for r in R.lookup_setpoint(asks, grid).collect()}
    assert got["m"]["matched_scenario"] == "Mid-life tool" and got["m"]["torque_nm"] == 62
    assert got["Q"]["error"] == "unknown product type (known: L, M, H): Q" and got["Q"]["matched_scenario"] is None
    assert math.isclose(out[0]["setpoint_power_w"], 66 * 1200 * 2 * math.pi / 60)

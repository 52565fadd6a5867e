"""Survival, comparison, quality and drift on small tables by brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugework.operators import drift as D
from gaugework.operators import metrics as M
from gaugework.operators import quality as Q
from gaugework.operators import readiness as G
from gaugework.operators import summary as S
from gaugework.operators import survival as V


def test_survival_curve_and_half_life(spark):
    rows = [("a", 2, False), ("a", 4, True), ("b", 1, False), ("b", 2, False)]
    df = spark.createDataFrame(rows, "fleet string, lifetime long, censored boolean")
    curve = V.survival_curve(df, "fleet")
    got = {(r["fleet"], r["cycle"]): r["active"] for r in curve.collect()}
    assert [got["a", c] for c in range(5)] == [2, 2, 1, 1, 1]  # the censored unit is still active at its last cycle
    assert [got["b", c] for c in range(5)] == [2, 1, 0, 0, 0]
    summary = {r["fleet"]: r for r in V.survival_summary(curve, "fleet").collect()}
    assert summary["a"]["half_life_cycle"] == 2 and summary["b"]["half_life_cycle"] == 1
    assert summary["a"]["final_survival_pct"] == 50.0


def test_mann_whitney(spark):
    rng = random.Random(1)
    a, b = [rng.randint(3, 12) for _ in range(60)], [rng.randint(0, 10) for _ in range(45)]
    df = spark.createDataFrame([("a", v) for v in a] + [("b", v) for v in b], "g string, v int")
    out = V.mann_whitney(df, "g", "a", "b", "v").first()
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    ties = sum(n**3 - n for n in np.unique(a + b, return_counts=True)[1])
    sd = math.sqrt(60 * 45 / 12 * (106 - ties / (105 * 104)))
    z = (u - 60 * 45 / 2 - 0.5) / sd
    assert out["u"] == u and out["z"] == pytest.approx(z)
    assert out["p_value"] == pytest.approx(0.5 * math.erfc(z / math.sqrt(2))) and out["significant"]


def test_lifetime_summary_uses_the_population_spread(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3)], "g string, lifetime long")
    assert V.lifetime_summary(df, "g").first()["std_cycles"] == 1.0
    both = df.unionByName(spark.createDataFrame([("b", 1)], "g string, lifetime long"))
    assert V.life_extension(both, "g", "a", "b").first()["life_extension_pct"] == 100.0


def test_contracts(spark):
    df = spark.createDataFrame([(1, 130.0), (None, -1.0)], "a long, rul double")
    checks = {r["check"]: r for r in Q.contract_checks(df, ["a", "b"], ["rul"], None, {"rul": (0, 125)}, {"a": "bigint"}).collect()}
    assert not checks["has_b"]["passed"] and not checks["no_rul"]["passed"] and checks["type_a"]["passed"]
    assert checks["nulls_a"]["value"] == 1 and checks["range_rul"]["value"] == 2
    with pytest.raises(ValueError, match="has_b"):
        Q.require(Q.contract_checks(df, ["b"], not_null=[]))


def test_integrity(spark):
    df = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (1, 1, 1), (2, 5, 0)], "a int, b int, y int")
    assert Q.duplicate_rows(df, ["a", "b"]).first()[:] == (4, 2, 1)
    assert Q.conflicting_labels(df, ["a", "b"], "y").first()[:] == (3, 1)
    split = df.withColumn("is_test", F.col("y") == 0)
    assert Q.row_overlap(split, ["a", "b"]).first()[:] == (2, 2, 1)
    assert Q.group_leakage(split, ["a"]).first()[:] == (2, 1)


def test_drift_against_numpy(spark):
    rng = np.random.default_rng(4)
    r, c = rng.normal(size=500).round(1), rng.normal(0.3, 1.2, 400).round(1)
    ref = spark.createDataFrame([(float(v), 1.0) for v in r], "x double, one double")
    cur = spark.createDataFrame([(float(v), 1.0) for v in c], "x double, one double")
    out = {row["column"]: row for row in D.ks_and_wasserstein(ref, cur, ["x", "one"]).collect()}
    grid = np.unique(np.concatenate([r, c]))
    fr, fc = np.searchsorted(np.sort(r), grid, "right") / 500, np.searchsorted(np.sort(c), grid, "right") / 400
    assert out["x"]["ks"] == pytest.approx(np.abs(fr - fc).max())
    assert out["x"]["wasserstein"] == pytest.approx((np.abs(fr - fc)[:-1] * np.diff(grid)).sum())
    assert out["x"]["drifted"] and not out["one"]["drifted"] and out["one"]["wasserstein"] == 0.0
    same = D.ks_and_wasserstein(ref, ref, ["x"]).first()
    assert same["ks"] == 0.0 and D.psi(ref, ref, ["x", "one"]).agg(F.max(F.abs("psi"))).first()[0] < 1e-12
    total = D.dataset_drift(D.ks_and_wasserstein(ref, cur, ["x", "one"])).first()
    assert (total["drifted_columns"], total["drift_share"], total["dataset_drift"]) == (1, 0.5, True)


def test_label_drift(spark):
    a = spark.createDataFrame([(0,)] * 50 + [(1,)] * 50, "y int")
    b = spark.createDataFrame([(0,)] * 100, "y int")
    assert D.label_drift(a, a, "y").first()["js_distance"] == 0.0
    m = [0.75, 0.25]
    js = (0.5 * math.log2(0.5 / m[0]) + 0.5 * math.log2(0.5 / m[1]) + 1 * math.log2(1 / m[0])) / 2
    assert D.label_drift(a, b, "y").first()["js_distance"] == pytest.approx(math.sqrt(js))


def test_readiness(spark):
    good = [("r2", 0.8), ("rmse", 17.7), ("f1", 0.87), ("precision", 0.96), ("significant", 1.0)]
    metrics = spark.createDataFrame(good, "metric string, value double")
    assert G.readiness(metrics, {"a": True}).first()["ready"]
    assert not G.readiness(metrics, {"a": False}).first()["ready"]
    assert not G.readiness(metrics.filter("metric <> 'r2'"), {"a": True}).first()["ready"]


def test_binned_mean_and_stages(spark):
    df = spark.createDataFrame([(float(i), float(i % 2)) for i in range(0, 241, 10)], "x double, y double")
    bins = S.binned_mean(df, "x", "y", 24)
    assert bins.count() == 24 and bins.agg(F.sum("rows")).first()[0] == 24  # the top edge falls in no bin
    stages = {r["label"]: r for r in S.stage_rates(df.filter("x < 100 or x >= 240"), "x", "y").collect()}
    assert stages["100-150"]["rate_pct"] == 0.0 and stages["0-50"]["rows"] == 5 and stages["200-240"]["rows"] == 0


def test_confusion_without_positives(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    row = M.confusion(df, "y", "p").first()
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_importance_report(spark):
    df = spark.createDataFrame([("s2_trend", 6.0), ("s3_velocity", 3.0), ("s4", 1.0)], "feature string, importance double")
    out = {r["feature"]: (r["share_pct"], r["family"]) for r in S.importance_report(df, S.engine_family()).collect()}
    assert out == {"s2_trend": (60.0, "trend"), "s3_velocity": (30.0, "velocity"), "s4": (10.0, "raw")}

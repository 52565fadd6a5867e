"""Fits find planted signals."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugework.operators import iforest
from gaugework.operators import models as L
from gaugework.operators import recommend as R
from gaugework.operators.iforest import _grow, average_path, fit_isolation_forest
from gaugework.operators.metrics import auc, confusion, regression_metrics
from gaugework.operators.sampling import folds
from gaugework.operators.sizing import release
from gaugework.plans.machines import machine_table


@pytest.fixture(scope="module")
def machines(spark):
    rng = np.random.default_rng(7)
    x = rng.uniform(size=(1500, 3))
    fails = (x[:, 0] > 0.9) & (x[:, 1] > 0.3)
    rows = [(i, *map(float, r), int(f)) for i, (r, f) in enumerate(zip(x, fails))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, failure long").cache()


def test_classifier(machines):
    model = L.fit_failure_classifier(machines, ["a", "b", "c"], trees=10, depth=5)
    scored = L.score_failures(model, machines)
    assert confusion(scored, "failure", "failure_pred").first()["f1"] > 0.9
    assert auc(scored, "failure", "failure_prob").first()["auc"] > 0.97
    names = list(L.importances(model, ["a", "b", "c"]))
    assert names[0] == "a" and names[-1] == "c"
    with pytest.raises(ValueError, match="zz"):
        L.fit_failure_classifier(machines, ["zz"])


def test_life_regressor_and_what_if(spark):
    df = spark.range(800).withColumns({"s11": F.rand(1) * 2 + 0.5, "s15": F.rand(2) + 0.5})
    df = df.withColumn("thermal_stress", F.col("s11") * F.col("s15")).withColumn("rul", 100 - 30 * F.col("thermal_stress")).cache()
    cols = ["s11", "s15", "thermal_stress"]
    model = L.fit_life_regressor(df, cols, maxIter=10, maxDepth=4)
    scored = L.score_life(model, df)
    assert regression_metrics(scored, "rul", "predicted_rul").first()["r2"] > 0.95
    out = L.what_if(model, R.interventions(scored, "thermal_stress", "predicted_rul", -30.0, True))
    acted = out.filter("status = 'SUCCESS'")
    assert acted.count() > 0 and acted.filter("model_gain < 0").count() == 0
    assert acted.agg(F.avg("model_gain")).first()[0] > 1.0
    idle = out.filter("status <> 'SUCCESS'")
    assert idle.agg(F.max("model_gain")).first()[0] < 1e-9


def test_isolation_forest_puts_planted_outliers_first(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(size=(1200, 2)), rng.normal(0, 0.1, size=(12, 2)) + [6, -6]])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double").repartition(6)
    forest = fit_isolation_forest(df, ["a", "b"], "id", trees=40)
    out = forest.transform(df)
    worst = {r["id"] for r in out.orderBy("anomaly_score").limit(12).collect()}
    assert worst == set(range(1200, 1212))
    flagged = out.filter("is_anomaly = 1").count()
    assert abs(flagged - 0.034 * 1212) < 3
    again = fit_isolation_forest(df.repartition(2), ["a", "b"], "id", trees=40)
    assert again.offset == pytest.approx(forest.offset)
    assert average_path(256) == pytest.approx(10.24, abs=0.01)


@pytest.mark.parametrize(
    "low, high", [(1.0, np.nextafter(1.0, 2.0)), (0.0, 5e-324), (-np.inf, 1.0), (1e308, np.inf), (-np.inf, np.inf), (-1.7e308, 1.7e308)]
)
def test_every_cut_leaves_rows_on_both_sides(low, high):
    points = np.array([[low, 0.0], [high, 0.0], [low, 1.0]])
    for tree in range(60):
        nodes = {n[1]: n for n in _grow(points, 42, tree)}
        assert sum(n[2] < 0 for n in nodes.values()) == 3
        for _, _, feature, cut, left, right, _ in nodes.values():
            if feature == 0:
                assert low <= cut < high


def test_forest_scores_equal_a_walk_from_node_to_node(spark, monkeypatch):
    monkeypatch.setattr(iforest, "ROWS_AT_ONCE", 7)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 3))
    x[3, 1], x[4, 0], x[5, 2], x[6] = np.nan, np.inf, -np.inf, np.nan
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double").coalesce(1)
    forest = fit_isolation_forest(df.filter("id > 6"), ["a", "b", "c"], "id", trees=9)

    def depth(tree, row):
        node = 0
        while (f := forest.feature[tree, node]) >= 0:
            node = (forest.left if row[f] <= forest.cut[tree, node] else forest.right)[tree, node]
        return forest.path[tree, node]

    got = {r["id"]: r["s"] for r in df.select("id", forest.raw_score().alias("s")).collect()}
    for i, row in enumerate(x):
        assert got[i] == pytest.approx(-(2.0 ** (-np.mean([depth(t, row) for t in range(9)]) / forest.norm)), rel=1e-12)


def test_stored_machine_features_run_the_windows_once(spark, tmp_path):
    raw = spark.range(40).select(
        F.col("id").alias("UDI"), F.lit("M1").alias("Product ID"), F.lit("L").alias("Type"),
        (F.lit(295.0) + F.col("id") % 7).alias("Air temperature [K]"), (F.lit(305.0) + F.col("id") % 5).alias("Process temperature [K]"),
        (F.lit(1200) + F.col("id") % 11).alias("Rotational speed [rpm]"), (F.lit(20.0) + F.col("id") % 13).alias("Torque [Nm]"),
        (F.col("id") % 17).alias("Tool wear [min]"),
        *[(F.col("id") % 9 == 0).cast("long").alias(c) for c in ("Machine failure", "TWF", "HDF", "PWF", "OSF", "RNF")],
    )
    stored = machine_table(raw, store=str(tmp_path / "smooth"))
    assert "Window" not in stored._jdf.queryExecution().optimizedPlan().toString()
    plain = machine_table(raw)
    assert stored.columns == plain.columns and sorted(map(str, stored.collect())) == sorted(map(str, plain.collect()))


def test_search_and_cross_validation(spark, machines):
    df = spark.range(300).withColumns({"unit": F.col("id") % 10, "x": F.rand(4)}).withColumn("rul", 50 * F.col("x")).cache()
    best, rmse = L.search_life_params(
        df, ["x"], ["unit"], trials=2, draw=lambda rng: {"maxIter": rng.choice([1, 8]), "maxDepth": 3, "stepSize": 0.3}
    )
    assert rmse < 10 and set(best) == {"maxIter", "maxDepth", "stepSize"}
    cv = L.cross_validate(machines, ["a", "b", "c"], "id", k=3, trees=5, depth=4).first()
    assert cv["cv_f1_mean"] > 0.8 and cv["cv_f1_std"] < 0.2


def _persisted(spark):
    return set(spark.sparkContext._jsc.getPersistentRDDs())


def test_all_folds_and_draws_read_vectors_made_once(spark, machines, monkeypatch):
    made = []
    vectors = L._vectors
    monkeypatch.setattr(L, "_vectors", lambda cols: made.append(cols) or vectors(cols))
    cols = ["a", "b", "c"]
    machines.count()
    before = _persisted(spark)
    cv = L.cross_validate(machines, cols, "id", k=3, trees=5, depth=4).first()
    assert len(made) == 1
    dealt = folds(machines, "id", 3, ["failure"], 42)
    scores = []
    for i in range(3):
        model = L.fit_failure_classifier(dealt.filter(F.col("fold") != i), cols, trees=5, depth=4)
        scores.append(confusion(L.score_failures(model, dealt.filter(F.col("fold") == i)), "failure", "failure_pred").first()["f1"])
    assert cv["cv_f1_mean"] == pytest.approx(np.mean(scores), abs=0.1)
    made.clear()
    df = spark.range(300).withColumns({"unit": F.col("id") % 10, "x": F.rand(4)}).withColumn("rul", 50 * F.col("x")).cache()
    df.count()
    before |= _persisted(spark)
    draw = lambda rng: {"maxIter": rng.choice([1, 4]), "maxDepth": 3, "stepSize": 0.3}
    best, rmse = L.search_life_params(df, ["x"], ["unit"], trials=4, draw=draw, rounds=[1, 4])
    assert len(made) == 1
    monkeypatch.setattr(L, "ROWS_SIDE_BY_SIDE", 1)
    assert L.search_life_params(df, ["x"], ["unit"], trials=4, draw=draw, rounds=[1, 4]) == (best, pytest.approx(rmse, rel=1e-9))
    release()
    assert _persisted(spark) <= before


def test_rounds_of_a_draw_count_and_the_best_is_fitted_with_all_of_them(spark, monkeypatch):
    asked = []
    fit = L._fit_boosting
    monkeypatch.setattr(L, "_fit_boosting", lambda points, *a, **p: asked.append(p["maxIter"]) or fit(points, *a, **p))
    df = spark.range(300).withColumns({"unit": F.col("id") % 10, "x": F.rand(4)}).withColumn("rul", 50 * F.col("x")).coalesce(1).cache()
    own = iter([4, 5])
    draw = lambda rng: {"maxIter": next(own), "maxDepth": 2, "stepSize": 0.1}
    best, rmse = L.search_life_params(df, ["x"], ["unit"], trials=2, draw=draw, rounds=[1, 2])
    assert sorted(asked) == [1, 1, 2, best["maxIter"]]
    # by parts of its own rounds the longer fit is ahead from the first step on
    assert L.PARTS_OF_ROUNDS[-1] == 1
    monkeypatch.setattr(L, "PARTS_OF_ROUNDS", [3, 1])
    asked.clear()
    own = iter([3, 6])
    best, rmse = L.search_life_params(df, ["x"], ["unit"], trials=2, draw=draw)
    assert best["maxIter"] == 6 and sorted(asked) == [1, 2, 6]
    split = L.group_holdout(df, ["unit"], 0.2, 42, "held").cache()
    model = L.fit_life_regressor(split.filter("not held"), ["x"], maxDepth=2, stepSize=0.1, maxIter=6)
    full = regression_metrics(L.score_life(model, split.filter("held"), None), "rul", "predicted_rul").first()["rmse"]
    assert rmse == pytest.approx(full, rel=1e-6)


def test_search_reads_even_parts_from_disk(spark, monkeypatch):
    monkeypatch.setattr(L, "ROWS_A_TASK", (50, 10))
    df = spark.range(300).withColumns({"unit": F.least("id", F.lit(9)), "x": F.rand(4)}).withColumn("rul", 50 * F.col("x")).coalesce(1).cache()
    df.count()
    before = _persisted(spark)
    seen = []
    fit = L._fit_boosting

    def watched(points, *args, **params):
        made = spark.sparkContext._jsc.getPersistentRDDs()
        levels = [made[i].getStorageLevel() for i in set(made) - before]
        seen.append((points.rdd.glom().map(len).collect(), any(x.useDisk() and not x.useMemory() for x in levels)))
        return fit(points, *args, **params)

    monkeypatch.setattr(L, "_fit_boosting", watched)
    draw = lambda rng: {"maxIter": 1, "maxDepth": 2, "subsamplingRate": 0.7}
    first = L.search_life_params(df, ["x"], ["unit"], trials=1, draw=draw, rounds=[1])
    (sizes, on_disk), = seen
    assert on_disk and max(sizes) <= 50 and len(sizes) == 8
    assert L.search_life_params(df, ["x"], ["unit"], trials=1, draw=draw, rounds=[1]) == first
    monkeypatch.setattr(L, "ROWS_A_TASK", (1000, 400))
    L.search_life_params(df, ["x"], ["unit"], trials=1, draw=draw, rounds=[1])
    assert len(seen[-1][0]) == 1


def test_audit(spark):
    df = spark.createDataFrame([(29.0, 0, 0.1), (250.0, 0, 0.2), (100.0, 1, -0.1)], "predicted_rul double, is_anomaly int, anomaly_score double")
    rows = L.audit(df).collect()
    assert [r["status"] for r in rows] == ["CRITICAL", "STABLE", "CRITICAL"]
    assert [r["life_bar_pct"] for r in rows] == pytest.approx([14.5, 100.0, 50.0])

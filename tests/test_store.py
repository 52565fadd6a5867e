"""Stored models, early stopping, successive halving and refutations of several effects at once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugework.functions.engine import dataset_code
from gaugework.operators import causal as K
from gaugework.operators import models as L
from gaugework.operators.iforest import IsolationForest, fit_isolation_forest
from gaugework.operators.store import ModelStore, table_digest
from gaugework.sources.tables import path_exists


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(900, 3))
    y = 3 * x[:, 0] - x[:, 1] + rng.normal(0, 0.1, 900)
    made = [(i, i % 30, *map(float, r), float(v), int(v > 2)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(made, "id long, unit long, a double, b double, c double, rul double, failure long").cache()


def test_digest_knows_rows_types_and_names_but_no_order(rows):
    first = table_digest(rows)
    assert table_digest(rows.repartition(7).orderBy(F.col("a").desc())) == first
    assert table_digest(rows.filter("id <> 5")) != first
    assert table_digest(rows.withColumn("unit", F.when(F.col("id") == 5, 31).otherwise(F.col("unit")))) != first
    assert table_digest(rows.withColumnRenamed("a", "z")) != first
    assert table_digest(rows.withColumn("unit", F.col("unit").cast("int"))) != first
    assert table_digest(rows.unionByName(rows)) != first
    assert table_digest(rows.limit(0)) == table_digest(rows.filter("id < 0")) != first


def test_one_fit_serves_every_consumer(spark, rows, tmp_path):
    store = ModelStore(spark, str(tmp_path))
    fits = []

    def fit(df):
        fits.append(1)
        return L.fit_failure_classifier(df, ["a", "b", "c"], trees=5, depth=4)

    score = lambda model: L.score_failures(model, rows).select("id", "failure_prob", "failure_pred").orderBy("id").collect()
    fresh = score(L.fit_failure_classifier(rows, ["a", "b", "c"], trees=5, depth=4))
    for _ in range(3):
        assert score(store.fitted("classifier", rows, {"trees": 5}, fit)) == fresh
    assert len(fits) == 1
    store.fitted("classifier", rows, {"trees": 6}, fit)
    store.fitted("classifier", rows.filter("id > 0"), {"trees": 5}, fit)
    store.fitted("other", rows, {"trees": 5}, fit)
    assert len(fits) == 4
    assert len([p for p in tmp_path.iterdir() if "." not in p.name]) == 4


def test_a_fit_that_fails_leaves_no_model(spark, rows, tmp_path):
    store = ModelStore(spark, str(tmp_path))

    def broken(model, path):
        spark.range(3).write.parquet(f"{path}/part")
        raise OSError("lost")

    with pytest.raises(OSError, match="lost"):
        store.fitted("m", rows, {}, lambda df: 1, broken, lambda path: 2)
    assert not path_exists(spark, store.path("m", rows, {}))
    assert store.fitted("m", rows, {}, lambda df: 1, lambda m, path: spark.range(3).write.parquet(path), lambda path: path) == store.path("m", rows, {})


def test_forest_round_trip(spark, rows, tmp_path):
    forest = fit_isolation_forest(rows, ["a", "b", "c"], "id", trees=20)
    forest.save(spark, str(tmp_path / "forest"))
    again = IsolationForest.load(spark, str(tmp_path / "forest"))
    both = [f.transform(rows).select("id", "anomaly_score", "is_anomaly").orderBy("id").collect() for f in (forest, again)]
    assert both[0] == both[1] and again.cols == ["a", "b", "c"] and again.offset == forest.offset


def test_boosting_stops_when_the_rows_held_out_say_so(rows):
    marked = rows.withColumn("stop", F.col("unit") % 5 == 0)
    model = L.fit_life_regressor(marked, ["a", "b", "c"], stop="stop", maxIter=60, maxDepth=3, stepSize=0.5, validationTol=0.05)
    kept = model.stages[-1].getNumTrees
    assert 1 <= kept < 60
    none = L.fit_life_regressor(rows, ["a", "b", "c"], maxIter=8, maxDepth=3)
    assert none.stages[-1].getNumTrees == 8


def test_the_best_of_all_draws_survives():
    settings = [{"s": i} for i in range(30)]
    asked = []

    def judge(params, n):
        asked.append((params["s"], n))
        return abs(params["s"] - 17) + 1 / n

    best, error, steps = L.successive_halving(settings, judge, [3, 9, 27])
    assert best == {"s": 17} and error == 1 / 27
    assert steps[0] == list(range(30)) and [len(s) for s in steps] == [30, 10, 4] and all(17 in s for s in steps)
    assert len(asked) == 44
    assert L.successive_halving(settings, lambda p, n: 0.0, [1, 2])[0] == {"s": 0}


def test_search_keeps_the_best_draw_on_a_small_table(rows):
    draws = iter([1, 2, 6, 1, 2, 1])

    def draw(rng):
        return {"maxIter": 12, "maxDepth": next(draws), "stepSize": 0.3}

    best, rmse = L.search_life_params(rows, ["a", "b", "c"], ["unit"], trials=6, draw=draw, rounds=[2, 12])
    assert best["maxDepth"] == 6 and rmse < 1.5


def test_several_effects_equal_those_found_alone(rows):
    specs = [("a", "rul", ["b", "c"]), ("b", "rul", ["a"]), ("a", "failure", ["c"])]
    got = {(r.treatment, r.outcome): r.effect for r in K.effects(rows, specs).collect()}
    for t, y, zs in specs:
        assert got[t, y] == pytest.approx(K.effect(rows, t, y, zs).first()["effect"], rel=1e-9)
    reports = {(r.treatment, r.outcome): r for r in K.refutations(rows, "id", specs, reps=4).collect()}
    assert len(reports) == 3
    for t, y, zs in specs:
        alone = K.refutation_report(rows, "id", t, y, zs, reps=4).first()
        for name in ("original_effect", "placebo_effect", "random_cause_effect"):
            assert reports[t, y][name] == pytest.approx(alone[name], rel=1e-9, abs=1e-12)
        assert reports[t, y].reliable == alone["reliable"]
    assert reports["a", "rul"].reliable


def test_refutations_of_nulls_and_constant_treatments(spark, rows):
    odd = rows.withColumns({"k": F.lit(1.0), "b": F.when(F.col("id") % 7 > 0, F.col("b"))})
    (r,) = K.refutations(odd, "id", [("k", "rul", ["b"])]).collect()
    assert r.original_effect is None and not r.reliable
    alone = K.effect(odd, "a", "rul", ["b"]).first()["effect"]
    assert K.refutations(odd, "id", [("a", "rul", ["b"])]).first().original_effect == pytest.approx(alone)


def test_dataset_code(spark):
    df = spark.createDataFrame([("FD001",), ("FD004",), ("FD009",), (None,)], "dataset_id string")
    assert [r[0] for r in df.select(dataset_code()).collect()] == [0, 3, 0, 0]

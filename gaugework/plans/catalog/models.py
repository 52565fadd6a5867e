"""Model fits and scores; other libraries' trees differ, so these are checked by rows and by quality tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugework.operators import models as L
from gaugework.operators import recommend as R
from gaugework.operators.metrics import regression_metrics
from gaugework.operators.sampling import group_holdout
from gaugework.operators.sizing import attach_row
from gaugework.operators.store import ModelStore
from gaugework.operators.summary import engine_family, importance_report, machine_family
from gaugework.plans import adapters as A
from gaugework.plans.catalog.causal import stress_effect
from gaugework.plans.catalog.features import features
from gaugework.plans.catalog.registry import register, tidy
from gaugework.plans.engines import engine_feature_columns
from gaugework.plans.machines import fit_machines, machine_table, stored_forest, train_and_score
from gaugework.session import scratch_path
from gaugework.sources.tables import write_table

# The classifier is smaller than the library's default (200 trees of depth 15, which the README has a time for), so that a
# smoke run stays short; all rows are used. Everything else is fitted in full.
CLASSIFIER = {"trees": 20, "depth": 5}
LIFE = {"maxIter": 500, "maxDepth": 4, "seed": 42}


def _machines(spark, sf_dir):
    """Stored feature table: a fit reads its rows many times."""
    table = machine_table(A.machine_log(spark, sf_dir), store=scratch_path(spark, "machine-smooth"))
    return write_table(table, scratch_path(spark, "machine-features"))


def _engines(spark, sf_dir):
    return write_table(features(spark, sf_dir), scratch_path(spark, "engine-features"))


def _machine_scores(spark, sf_dir):
    """(scored rows, evaluation): the models are fitted by the first query that asks for them."""
    return train_and_score(_machines(spark, sf_dir), store=ModelStore(spark), **CLASSIFIER)


@register("rf_scores")
def rf_scores(spark, sf_dir):
    scored, _ = _machine_scores(spark, sf_dir)
    return tidy(scored.select("UDI", "failure", "is_test", "failure_prob", "failure_pred"))


@register("rf_importances")
def rf_importances(spark, sf_dir):
    _, model, _ = fit_machines(_machines(spark, sf_dir), store=ModelStore(spark), **CLASSIFIER)
    return tidy(importance_report(L.importance_table(model, L.MACHINE_FEATURES, spark), machine_family()))


@register("cv_f1")
def cv_f1(spark, sf_dir):
    return tidy(L.cross_validate(_machines(spark, sf_dir), L.MACHINE_FEATURES, "UDI", k=5, **CLASSIFIER))


@register("iforest_scores")
def iforest_scores(spark, sf_dir):
    df = _machines(spark, sf_dir)
    forest = stored_forest(ModelStore(spark), df.filter(F.col("failure") == 0), L.MACHINE_FEATURES, "UDI")
    return tidy(forest.transform(df).select("UDI", "failure", "anomaly_score", "is_anomaly"))


@register("scored_machines")
def scored_machines(spark, sf_dir):
    scored, _ = _machine_scores(spark, sf_dir)
    return tidy(scored.select("UDI", "failure", "is_test", "failure_prob", "failure_pred", "anomaly_score", "is_anomaly"))


@register("classifier_report")
def classifier_report(spark, sf_dir):
    """Hold-out figures of the classifier, and of the forest's flags against the failures of all rows."""
    _, report = _machine_scores(spark, sf_dir)
    return tidy(report)


def _life(spark, sf_dir):
    """(scored engine cycles, life model, its columns).

    A fifth of the engines is held out for the report. Of the others another fifth tells boosting when to stop.
    """
    groups = ["dataset_id", "unit"]
    split = write_table(group_holdout(_engines(spark, sf_dir), groups), scratch_path(spark, "engine-split"))
    cols = engine_feature_columns(split)
    train = group_holdout(split.filter(~F.col("is_test")), groups, seed=43, name="is_stop").select(*cols, "rul", "is_stop")
    train = write_table(train, scratch_path(spark, "life-train"))
    model = ModelStore(spark).fitted("life", train, LIFE, lambda df: L.fit_life_regressor(df, cols, stop="is_stop", **LIFE))
    return L.score_life(model, split), model, cols


@register("gbt_rul")
def gbt_rul(spark, sf_dir):
    scored, _, _ = _life(spark, sf_dir)
    return tidy(scored.select("event_id", "dataset_id", "unit", "cycle", "rul", "is_test", "predicted_rul"))


@register("gbt_report")
def gbt_report(spark, sf_dir):
    """Errors on the engines held out and on the others, and the boosting rounds that were kept."""
    scored, model, _ = _life(spark, sf_dir)
    report = regression_metrics(scored, "rul", "predicted_rul", ["is_test"])
    return tidy(report.withColumn("rounds", F.lit(model.stages[-1].getNumTrees)))


@register("gbt_importances")
def gbt_importances(spark, sf_dir):
    _, model, cols = _life(spark, sf_dir)
    return tidy(importance_report(L.importance_table(model, cols, spark), engine_family()))


@register("life_search")
def life_search(spark, sf_dir):
    """The best of 30 draws of the six settings, by successive halving; the last draws have all their boosting rounds."""
    df = _engines(spark, sf_dir)
    best, rmse = L.search_life_params(df, engine_feature_columns(df), ["dataset_id", "unit"])
    rows = [(name, float(value)) for name, value in sorted({**best, "rmse": rmse}.items())]
    return spark.createDataFrame(rows, "setting string, value double")


@register("what_if")
def what_if(spark, sf_dir):
    """Predictions before and after the interventions; effect and reliability are those estimated from the same engines."""
    scored, model, _ = _life(spark, sf_dir)
    wide = attach_row(scored, stress_effect(scored, key="event_id"))
    planned = R.interventions(wide, "thermal_stress", "predicted_rul", F.col("effect"), F.col("reliable"))
    cols = ["event_id", "status", "urgency", "rul_before", "rul_after", "model_gain", "causal_gain"]
    return tidy(L.what_if(model, planned).select(*cols))


@register("machine_audit")
def machine_audit(spark, sf_dir):
    """Life and anomaly scores joined into one status row per engine cycle."""
    scored, _, cols = _life(spark, sf_dir)
    forest = stored_forest(ModelStore(spark), scored, cols, "event_id")
    audited = L.audit(forest.transform(scored))
    return tidy(audited.select("event_id", "status", "predicted_rul", "life_bar_pct", "anomaly_detected", "health_score"))

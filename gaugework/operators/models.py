"""Failure classifier, life regressor, search, cross-validation and fleet scoring with Spark ML."""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.functions import machine
from gaugework.operators.columns import clip
from gaugework.operators.metrics import class_weights, confusion, fold_summary, regression_metrics
from gaugework.operators.recommend import what_if_inputs
from gaugework.operators.sampling import folds, group_holdout
from gaugework.session import scratch_path
from gaugework.sources.tables import write_table

# Fixed feature list of the failure model.
MACHINE_FEATURES = [
    "rpm", "torque", "tool_wear", "air_temp_c", "proc_temp_c", "power_w",
    "temp_delta", "stress_index", "overstrain_margin",
    "air_temp_c_smooth", "proc_temp_c_smooth", "rpm_smooth",
    "torque_smooth", "tool_wear_smooth", "power_w_smooth",
]


#: Fits of up to so many rows each run side by side. One of more rows fills the cluster and its memory alone.
ROWS_SIDE_BY_SIDE = 10_000_000
#: Rows of a task of the search: no more than the first number, as a fit holds them as objects and writes and reads them as one
#: block, and no fewer than the second, where a task would cost more than its rows.
ROWS_A_TASK = (250_000, 25_000)
#: Steps of the search: a draw is judged after a 27th of its own boosting rounds, a ninth, a third and all of them.
PARTS_OF_ROUNDS = [27, 9, 3, 1]


def _vectors(cols: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=cols, outputCol="__features", handleInvalid="keep")


def _points(df: DataFrame, cols: list[str], *more: str, level: StorageLevel = StorageLevel.MEMORY_AND_DISK_DESER) -> DataFrame:
    """The rows as vectors of `cols` with the columns `more`, persisted; the caller unpersists them.

    A fit goes over its input three times before it has its own form of it, and boosting that watches held-out rows once more
    in every round. Putting a vector together costs more than such a pass, so it is done once for all passes and all fits.
    """
    return _vectors(cols).transform(df).select("__features", *more).persist(level)


def _evenly(df: DataFrame, rows: int) -> DataFrame:
    """The `rows` rows of a table in parts of one size, within ROWS_A_TASK. What a file or a key holds does not matter, and the
    order inside a part is that of the values, so that the draws of a fit are the same every time."""
    most, least = ROWS_A_TASK
    parts = max(1, -(-rows // most), min(df.sparkSession.sparkContext.defaultParallelism, rows // least))
    return df.repartition(parts).sortWithinPartitions(*df.columns)


def _side_by_side(rows: int, parallel: int) -> int:
    """How many fits of so many rows run at a time."""
    return parallel if rows <= ROWS_SIDE_BY_SIDE else 1


def _fit_forest(points: DataFrame, label: str, trees: int = 200, depth: int = 15, min_rows: int = 3, seed: int = 42):
    forest = RandomForestClassifier(
        featuresCol="__features", labelCol="__label", weightCol="__weight", predictionCol="__pred",
        probabilityCol="__prob", rawPredictionCol="__raw", numTrees=trees, maxDepth=depth,
        minInstancesPerNode=min_rows, seed=seed,
    )
    train = class_weights(points, label, "__weight").withColumn("__label", F.col(label).cast("double"))
    return forest.fit(train.select("__features", "__label", "__weight"))


def fit_failure_classifier(
    df: DataFrame, cols: list[str], label: str = "failure", trees: int = 200, depth: int = 15, min_rows: int = 3,
    seed: int = 42,
) -> PipelineModel:
    """Random forest with balanced class weights."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")
    points = _points(df, cols, label)
    try:
        return PipelineModel([_vectors(cols), _fit_forest(points, label, trees, depth, min_rows, seed)])
    finally:
        points.unpersist()


def score_failures(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add `failure_prob` and `failure_pred`."""
    return _probabilities(model.transform(df))


def _probabilities(out: DataFrame) -> DataFrame:
    return out.withColumns(
        {"failure_prob": vector_to_array("__prob")[1], "failure_pred": F.col("__pred").cast("int")}
    ).drop("__features", "__raw", "__prob", "__pred")


def fit_life_regressor(
    df: DataFrame, cols: list[str], label: str = "rul", seed: int = 42, stop: str | None = None, **params
) -> PipelineModel:
    """Gradient-boosted trees on remaining life; `params` are GBTRegressor settings.

    With `stop`, a boolean column, the rows where it is true are held out of the fit, and boosting ends when a round no
    longer lowers their error by `validationTol` of it; `maxIter` is then the most rounds there may be.
    """
    train = df.withColumn("__label", F.col(label).cast("double"))
    points = _points(train, cols, "__label", *([stop] if stop else []))
    try:
        return PipelineModel([_vectors(cols), _fit_boosting(points, seed, stop, **params)])
    finally:
        points.unpersist()


def _cut_lineage(spark) -> None:
    """Let boosting cut its lineage, every ten rounds by default; several hundred rounds are too deep for one plan."""
    spark.sparkContext.setCheckpointDir(scratch_path(spark, "boosting"))


def _fit_boosting(points: DataFrame, seed: int, stop: str | None = None, **params):
    more = {} if stop is None else {"validationIndicatorCol": stop, "validationTol": 1e-3, "checkpointInterval": 10}
    if stop is not None:
        _cut_lineage(points.sparkSession)
    gbt = GBTRegressor(
        featuresCol="__features", labelCol="__label", predictionCol="predicted_rul", seed=seed, **{**more, **params}
    )
    return gbt.fit(points)


def score_life(model: PipelineModel, df: DataFrame, cap: float | None = 125.0) -> DataFrame:
    """Add `predicted_rul`, held inside [0, cap] when a cap is given."""
    out = model.transform(df).drop("__features")
    return out if cap is None else out.withColumn("predicted_rul", clip("predicted_rul", 0.0, cap))


def importances(model: PipelineModel, cols: list[str]) -> dict[str, float]:
    """Importance per feature, largest first."""
    values = model.stages[-1].featureImportances.toArray()
    return dict(sorted(zip(cols, map(float, values)), key=lambda x: (-x[1], x[0])))


def importance_table(model: PipelineModel, cols: list[str], spark) -> DataFrame:
    rows = [(name, value) for name, value in importances(model, cols).items()]
    return spark.createDataFrame(rows, "feature string, importance double")


def draw_params(rng: random.Random) -> dict:
    """One random setting of the boosted trees."""
    return {
        "maxIter": rng.randint(100, 500),
        "maxDepth": rng.randint(3, 10),
        "stepSize": 10 ** rng.uniform(-2, -0.69897),
        "minInstancesPerNode": rng.randint(10, 50),
        "subsamplingRate": rng.uniform(0.6, 1.0),
        "featureSubsetStrategy": f"{rng.uniform(0.6, 1.0):.4f}",
    }


def successive_halving(
    settings: list[dict], judge: Callable[[dict, int], float], rounds: list[int], keep: float = 1 / 3, parallel: int = 4
) -> tuple[dict, float, list[list[int]]]:
    """(best setting, its error, numbers of the settings judged in each step).

    Every setting is judged after the first number of rounds; the best share `keep` of them, one at least, goes on to the
    next number. Ties go to the earlier setting, so the result does not hang on the order in which judges end.
    """
    alive = list(range(len(settings)))
    steps: list[list[int]] = []
    errors: list[float] = []
    with ThreadPool(parallel) as pool:
        for n in rounds:
            steps.append(alive)
            errors = pool.map(lambda i, n=n: judge(settings[i], n), alive)
            ranked = sorted(range(len(alive)), key=lambda j: (errors[j], alive[j]))
            best, error = alive[ranked[0]], errors[ranked[0]]
            alive = sorted(alive[j] for j in ranked[: max(1, math.ceil(len(alive) * keep))])
    return settings[best], error, steps


def search_life_params(
    df: DataFrame, cols: list[str], groups: list[str], label: str = "rul", trials: int = 30, parallel: int = 4,
    seed: int = 42, draw=draw_params, rounds: list[int] | None = None,
) -> tuple[dict, float]:
    """Random search by successive halving over `trials` draws; returns the best setting and its RMSE.

    Every draw is judged on engines held out from its fit, first after a small part of its own `maxIter` boosting rounds, and
    the best third of the draws after three times as many, until one to three are left, which are fitted and judged with all
    their rounds. So the rounds of a draw count like its other settings, and the RMSE is that of the setting as returned.
    `rounds` may name the rounds of the steps instead; draws that have more than the last number are left to a further step
    with all of theirs. All fits read the vectors of one stored split, side by side while they are small.
    """
    rng = random.Random(seed)
    settings = [draw(rng) for _ in range(trials)]
    if rounds is None:
        steps, of = PARTS_OF_ROUNDS, lambda own, part: -(-own // part)
    else:
        whole = max(params["maxIter"] for params in settings)
        steps, of = [*rounds, *([whole] if rounds[-1] < whole else [])], min
    spark = df.sparkSession
    _cut_lineage(spark)
    split = group_holdout(df, groups, 0.2, seed, "__held").select(*cols, label, "__held")
    split = write_table(split, scratch_path(spark, "search"))
    even = _evenly(split, split.count()).withColumn("__label", F.col(label).cast("double"))
    # the memory is left to what the fits keep there, their rows as bins and the errors of the last rounds
    points = _points(even, cols, "__label", label, "__held", level=StorageLevel.DISK_ONLY)
    train, held = points.filter(~F.col("__held")), points.filter("__held")

    def judge(params: dict, step: int) -> float:
        model = _fit_boosting(train, seed, **{**params, "maxIter": of(params["maxIter"], step)})
        return regression_metrics(model.transform(held), label, "predicted_rul").first()["rmse"]

    try:
        at_once = _side_by_side(points.count(), parallel)
        best, error, _ = successive_halving(settings, judge, steps, parallel=at_once)
    finally:
        points.unpersist()
    return best, error


def cross_validate(
    df: DataFrame, cols: list[str], key: str | list[str], label: str = "failure", k: int = 5, seed: int = 42,
    parallel: int = 3, **params
) -> DataFrame:
    """Stratified k-fold F1: mean and spread over the folds. All fits read the vectors of one stored fold column, side by side
    while they are small."""
    spark = df.sparkSession
    dealt = folds(df, key, k, [label], seed).select(*cols, label, "fold")
    points = _points(write_table(dealt, scratch_path(spark, "folds")), cols, label, "fold")

    def fold(i: int) -> DataFrame:
        model = _fit_forest(points.filter(F.col("fold") != i), label, seed=seed, **params)
        scored = _probabilities(model.transform(points.filter(F.col("fold") == i)))
        return confusion(scored, label, "failure_pred", ["fold"])

    try:
        with ThreadPool(_side_by_side(points.count(), parallel)) as pool:
            parts = pool.map(fold, range(k))
        counts = reduce(DataFrame.unionByName, parts)
        return fold_summary(write_table(counts, scratch_path(spark, "fold-counts")))
    finally:
        points.unpersist()


def what_if(model: PipelineModel, df: DataFrame, rul: str = "predicted_rul", stress: str = "thermal_stress"):
    """Predict again after the recommended stress reduction and report the gain over the present prediction.

    `df` is an `interventions` result, made from `rul`. Both predictions are as the model gives them, not held inside any
    range, and run over the whole fleet as one plan.
    """
    now = score_life(model, df.drop("predicted_rul"), None).withColumnRenamed("predicted_rul", "rul_before")
    before = now.withColumn("stress_before", F.col(stress))
    after = score_life(model, what_if_inputs(before, stress), None).withColumnRenamed("predicted_rul", "rul_after")
    return after.withColumn("model_gain", F.greatest(F.lit(0.0), F.col("rul_after") - F.col("rul_before")))


def audit(df: DataFrame, rul: str = "predicted_rul", anomaly: str = "is_anomaly", score: str = "anomaly_score"):
    """Status record of every scored machine row; row-wise, so streams can use it as well."""
    status = F.when((F.col(rul) < 30) | (F.col(anomaly) == 1), "CRITICAL").otherwise("STABLE")
    return df.withColumns(
        {
            "status": status,
            "life_bar_pct": machine.life_bar_pct(rul),
            "anomaly_detected": F.col(anomaly) == 1,
            "health_score": F.col(score),
        }
    )


def live_machine_features() -> dict[str, Column]:
    """Unscaled features of a single reading, with fixed maxima instead of the table's."""
    return {
        "power_w": machine.power_w(),
        "temp_delta": F.col("proc_temp_c") - F.col("air_temp_c"),
        "stress_index": F.col("torque") / machine.LIVE_TORQUE_MAX * (F.col("rpm") / machine.LIVE_RPM_MAX),
        "overstrain_margin": machine.overstrain_margin(),
    }

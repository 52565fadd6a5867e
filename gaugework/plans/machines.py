"""Machine rows from the raw table to scored results."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.functions.machine import MODE_COLUMNS
from gaugework.operators.features import clean_machines, machine_features
from gaugework.operators.iforest import IsolationForest, fit_isolation_forest
from gaugework.operators.metrics import auc, confusion
from gaugework.operators.models import MACHINE_FEATURES, fit_failure_classifier, score_failures
from gaugework.operators.quality import contract_checks
from gaugework.operators.sampling import holdout
from gaugework.operators.sizing import attach_row
from gaugework.operators.store import ModelStore
from gaugework.session import scratch_path
from gaugework.sources.tables import write_table


def raw_contract(clean: DataFrame) -> DataFrame:
    return contract_checks(clean, required=["air_temp_c", "failure", *MODE_COLUMNS], forbidden=["air_temp_k"])


def feature_contract(features: DataFrame) -> DataFrame:
    targets = ["failure", *MODE_COLUMNS]
    return contract_checks(
        features,
        required=["temp_delta", "overstrain_margin", "air_temp_c_smooth", *targets],
        types={t: "bigint" for t in targets},
    )


def machine_table(raw: DataFrame, order: str = "UDI", store: str | None = None) -> DataFrame:
    """Clean rows with scaled features; columns that reports read in real units keep a `_raw` copy. `store` as for
    `machine_features`."""
    clean = clean_machines(raw)
    kept = clean.withColumns({f"{c}_raw": F.col(c).cast("string") for c in ("tool_wear", "power_w")})
    scaled = machine_features(kept, order, store=store)
    return scaled.withColumns({f"{c}_raw": F.col(f"{c}_raw").cast("double") for c in ("tool_wear", "power_w")})


def fit_machines(
    features: DataFrame, key: str = "UDI", trees: int = 200, depth: int = 15, forest_trees: int = 200, seed: int = 42,
    store: ModelStore | None = None,
) -> tuple[DataFrame, PipelineModel, IsolationForest]:
    """(rows with `is_test`, classifier of the other 80 percent, forest of the rows without a failure).

    The split is stored once for both fits and all scores. With a `store`, models of the same rows and settings are fitted
    once and read back.
    """
    spark = features.sparkSession
    split = write_table(holdout(features, key, 0.2, ["failure"], seed), scratch_path(spark, "machine-split"))
    train = split.filter(~F.col("is_test")).select(*MACHINE_FEATURES, "failure")
    store = store or ModelStore(spark, scratch_path(spark, "models"))
    sizes = {"trees": trees, "depth": depth, "seed": seed}
    model = store.fitted("failure-classifier", train, sizes, lambda df: fit_failure_classifier(df, MACHINE_FEATURES, **sizes))
    forest = stored_forest(store, split.filter(F.col("failure") == 0), MACHINE_FEATURES, key, forest_trees, seed)
    return split, model, forest


def train_and_score(features: DataFrame, key: str = "UDI", **settings) -> tuple[DataFrame, DataFrame]:
    """Scored table and one-row evaluation: the classifier on the hold-out, the forest's flags (`flag_`) on all rows.

    `settings` as for `fit_machines`.
    """
    split, model, forest = fit_machines(features, key, **settings)
    scored = forest.transform(score_failures(model, split))
    test = scored.filter("is_test")
    flags = confusion(scored, "failure", "is_anomaly")
    flags = flags.select(*(F.col(c).alias(f"flag_{c}") for c in flags.columns))
    report = attach_row(confusion(test, "failure", "failure_pred"), auc(test, "failure", "failure_prob"))
    return scored, attach_row(report, flags)


def stored_forest(store: ModelStore, normal: DataFrame, cols: list[str], key: str, trees: int = 200, seed: int = 42) -> IsolationForest:
    """Isolation forest of the rows, fitted once and read back."""
    spark = normal.sparkSession
    return store.fitted(
        "isolation-forest", normal.select(key, *cols), {"trees": trees, "seed": seed, "cols": cols, "key": key},
        lambda df: fit_isolation_forest(df, cols, key, trees, seed=seed),
        lambda forest, path: forest.save(spark, path), lambda path: IsolationForest.load(spark, path),
    )

"""Splits, folds and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugework.functions.machine import scenario_key
from gaugework.operators import features as X
from gaugework.operators import sampling as P
from gaugework.plans import adapters as A
from gaugework.plans.catalog.registry import oracle, r, register, tidy

RANDOM = "md5(concat_ws('|', event_id, 42))"


@register(
    "stratified_holdout",
    oracle(
        f"SELECT event_id, label, row_number() OVER (PARTITION BY label ORDER BY {RANDOM}) "
        "<= ceil(0.2::DOUBLE * count(*) OVER (PARTITION BY label)) AS is_test FROM scored",
        "scored",
    ),
)
def stratified_holdout(spark, sf_dir):
    return tidy(P.holdout(A.scored(spark, sf_dir).select("event_id", "label"), "event_id", 0.2, ["label"]))


@register(
    "group_holdout",
    oracle(
        "SELECT event_id, dataset_id, unit, is_test FROM cycles JOIN (SELECT dataset_id, unit, "
        "row_number() OVER (ORDER BY md5(concat_ws('|', dataset_id, unit, 42))) <= ceil(0.2::DOUBLE * count(*) OVER ()) AS is_test "
        "FROM (SELECT DISTINCT dataset_id, unit FROM cycles)) USING (dataset_id, unit)",
        "cycles",
    ),
)
def group_holdout(spark, sf_dir):
    df = A.cycles(spark, sf_dir).select("event_id", "dataset_id", "unit")
    return P.group_holdout(df, ["dataset_id", "unit"])


@register(
    "folds",
    oracle(f"SELECT event_id, label, (row_number() OVER (PARTITION BY label ORDER BY {RANDOM}) - 1) % 5 AS fold FROM scored", "scored"),
)
def folds(spark, sf_dir):
    return tidy(P.folds(A.scored(spark, sf_dir).select("event_id", "label"), "event_id", 5, ["label"]))


@register(
    "ordered_prefix",
    oracle(
        "SELECT event_id, row_number() OVER (ORDER BY event_id) <= floor(0.8::DOUBLE * count(*) OVER ()) AS is_train FROM events"
    ),
)
def ordered_prefix(spark, sf_dir):
    return P.ordered_prefix(A.table(spark, sf_dir, "events").select("event_id"), "event_id")


@register(
    "capped_sample",
    oracle(
        f"SELECT event_id, dataset_id, condition_cluster FROM clustered QUALIFY row_number() OVER "
        f"(PARTITION BY dataset_id, condition_cluster ORDER BY {RANDOM}) <= 500",
        "clustered",
    ),
)
def capped_sample(spark, sf_dir):
    df = X.condition_clusters(A.cycles(spark, sf_dir), only=["FD002", "FD004"])
    cols = ["event_id", "dataset_id", "condition_cluster"]
    return tidy(P.capped_sample(df.select(*cols), "event_id", ["dataset_id", "condition_cluster"], 500))


@register(
    "large_capped_sample",
    oracle(
        f"SELECT event_id, event_type FROM scored QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY {RANDOM}) <= 1500",
        "scored",
    ),
)
def large_capped_sample(spark, sf_dir):
    return P.capped_sample(A.scored(spark, sf_dir).select("event_id", "event_type"), "event_id", ["event_type"], 1500)


@register(
    "sample_rows",
    oracle(f"SELECT event_id, {r('value')} AS value FROM scored ORDER BY {RANDOM} LIMIT 3000", "scored"),
)
def sample_rows(spark, sf_dir):
    """The 3000-row sample that drift reports draw."""
    return tidy(P.sample_rows(A.scored(spark, sf_dir).select("event_id", "value"), "event_id", 3000))


@register(
    "one_per_band",
    oracle(
        f"SELECT event_id, band, rul FROM b QUALIFY row_number() OVER (PARTITION BY band ORDER BY {RANDOM}) = 1",
        "cycles",
        ctes={
            "b": "SELECT *, CASE WHEN rul < 20 THEN 'critical' WHEN rul < 50 THEN 'degrading' ELSE 'healthy' END AS band FROM "
            "(SELECT event_id, max(cycle) OVER (PARTITION BY dataset_id, unit) - cycle AS rul FROM cycles)"
        },
    ),
)
def one_per_band(spark, sf_dir):
    df = X.remaining_life(A.cycles(spark, sf_dir)).withColumn("band", scenario_key("rul"))
    return P.one_per_band(df.select("event_id", "band", "rul"), "band", "event_id")


@register(
    "draw_with_replacement",
    oracle(
        """SELECT draw, event_id FROM (SELECT unnest(range(1, 101)) AS draw) d
JOIN (SELECT event_id, row_number() OVER (ORDER BY md5(concat_ws('|', event_id, 42))) AS i FROM eligible) e
  ON e.i = ('0x' || substr(md5(concat_ws('|', draw, 42)), 1, 15))::BIGINT % (SELECT count(*) FROM eligible) + 1""",
        "cycles",
        ctes={
            "eligible": "SELECT event_id FROM (SELECT event_id, max(cycle) OVER (PARTITION BY dataset_id, unit) - cycle AS rul "
            "FROM cycles) WHERE rul BETWEEN 20 AND 60"
        },
    ),
)
def draw_with_replacement(spark, sf_dir):
    """The 100 starting states (two fleets of 50) drawn from the eligible rows."""
    df = X.remaining_life(A.cycles(spark, sf_dir)).filter(F.col("rul").between(20, 60)).select("event_id")
    return P.draw_with_replacement(df, "event_id", 100)

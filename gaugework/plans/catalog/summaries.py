"""Summary queries, survival statistics and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugework.functions.machine import MODE_COLUMNS, power_w
from gaugework.operators import features as X
from gaugework.operators import metrics as M
from gaugework.operators import sampling as P
from gaugework.operators import summary as S
from gaugework.operators import survival as V
from gaugework.operators.columns import clip
from gaugework.operators.cumulative import quantiles
from gaugework.plans import adapters as A
from gaugework.plans.catalog.registry import oracle, r, register, tidy
from gaugework.session import scratch_path
from gaugework.sources.tables import write_table


def _log(spark, sf_dir):
    """Machine log with a given score and flag per row."""
    df = X.clean_machines(A.machine_log(spark, sf_dir))
    return df.withColumns(
        {"failure_prob": F.col("torque") / (F.col("torque") + 40.0), "is_anomaly": (F.col("tool_wear") > 240).cast("long")}
    )


LOG = {"log": "SELECT *, torque / (torque + 40) AS failure_prob, (tool_wear > 240)::BIGINT AS is_anomaly FROM clean_log"}


@register("group_counts", oracle('SELECT dataset_id, count(*) AS "rows" FROM cycles GROUP BY 1', "cycles"))
def group_counts(spark, sf_dir):
    return S.group_counts(A.cycles(spark, sf_dir), ["dataset_id"])


@register(
    "value_ranges",
    oracle(
        "SELECT " + ", ".join(f"{r(f'{e}({c})')} AS {c}_{e}" for c in ("tool_wear", "torque", "rpm") for e in ("min", "max"))
        + " FROM machines",
        "machines",
    ),
)
def value_ranges(spark, sf_dir):
    return tidy(X.value_ranges(A.machines(spark, sf_dir), ["tool_wear", "torque", "rpm"]))


SHARES = [0.5, 0.75, 0.9, 0.95, 0.99]


@register(
    "distribution_profile",
    oracle(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", {s}::DOUBLE AS share, {r(f'quantile_cont({c}, {s}::DOUBLE)')} AS quantile FROM t"
            for c in ("score", "value", "k")
            for s in SHARES
        ),
        "scored",
        ctes={"t": "SELECT score, value, k FROM scored"},
    ),
)
def distribution_profile(spark, sf_dir):
    return tidy(quantiles(A.scored(spark, sf_dir), ["score", "value", "k"], SHARES))


@register(
    "mean_and_max",
    oracle(
        f"SELECT {r('avg(tool_wear)')} AS wear_mean, max(tool_wear) AS wear_max, {r('avg(torque)')} AS torque_mean FROM machines",
        "machines",
    ),
)
def mean_and_max(spark, sf_dir):
    df = A.machines(spark, sf_dir)
    return tidy(
        df.agg(F.avg("tool_wear").alias("wear_mean"), F.max("tool_wear").alias("wear_max"), F.avg("torque").alias("torque_mean"))
    )


@register(
    "anomaly_summary",
    oracle(
        f"""SELECT count(*) AS total_samples, sum(failure)::BIGINT AS failure_count,
  {r("sum(failure) / count(*) * 100")} AS failure_rate_pct, sum(is_anomaly)::BIGINT AS anomaly_count,
  {r("sum(is_anomaly) / count(*) * 100")} AS anomaly_rate_pct, {r("avg(failure_prob)")} AS avg_failure_prob,
  count(*) FILTER (failure_prob > 0.5) AS high_risk_count, sum(TWF)::BIGINT AS "TWF", sum(HDF)::BIGINT AS "HDF",
  sum(PWF)::BIGINT AS "PWF", sum(OSF)::BIGINT AS "OSF", sum(RNF)::BIGINT AS "RNF" FROM log""",
        "clean_log",
        ctes=LOG,
    ),
)
def anomaly_summary(spark, sf_dir):
    return tidy(S.anomaly_summary(_log(spark, sf_dir)))


@register(
    "overlap",
    oracle(
        """SELECT count(*) FILTER (is_anomaly = 1 AND failure = 1) AS anomaly_vs_failure_overlap,
  count(*) FILTER (is_anomaly = 1 AND failure = 0) AS anomaly_without_failure,
  count(*) FILTER (is_anomaly = 0 AND failure = 1) AS failure_without_anomaly FROM log""",
        "clean_log",
        ctes=LOG,
    ),
)
def overlap(spark, sf_dir):
    return S.overlap(_log(spark, sf_dir))


@register(
    "mode_breakdown",
    oracle(
        " UNION ALL ".join(
            f"SELECT '{m}' AS mode, sum({m})::BIGINT AS failures, sum(failure)::BIGINT AS total_failures FROM clean_log"
            for m in MODE_COLUMNS
        ),
        "clean_log",
    ),
)
def mode_breakdown(spark, sf_dir):
    return S.mode_breakdown(X.clean_machines(A.machine_log(spark, sf_dir)))


@register("class_distribution", oracle('SELECT failure, count(*) AS "rows" FROM machines GROUP BY 1', "machines"))
def class_distribution(spark, sf_dir):
    return S.class_distribution(A.machines(spark, sf_dir), "failure")


@register(
    "binned_trend",
    oracle(
        f"""SELECT bin, {r("lo + (bin + 0.5::DOUBLE) * w")} AS center, {r("avg(failure)")} AS mean, count(*) AS "rows"
FROM (SELECT failure, lo, w, least(CAST(floor((tool_wear - lo) / w) AS BIGINT), 28) AS bin FROM machines,
      (SELECT min(tool_wear)::DOUBLE AS lo, (max(tool_wear) - min(tool_wear)) / 29.0::DOUBLE AS w, max(tool_wear) AS hi
       FROM machines) WHERE tool_wear < hi)
GROUP BY bin, lo, w""",
        "machines",
    ),
)
def binned_trend(spark, sf_dir):
    return tidy(S.binned_mean(A.machines(spark, sf_dir), "tool_wear", "failure"))


@register(
    "stage_rates",
    oracle(
        f"""SELECT stage, label, count(m.failure) AS "rows", {r("coalesce(avg(m.failure) * 100, 0)")} AS rate_pct,
  CASE WHEN coalesce(avg(m.failure) * 100, 0) < 2 THEN 'normal' WHEN avg(m.failure) * 100 < 8 THEN 'warning'
       ELSE 'critical' END AS severity
FROM (VALUES (0::BIGINT, 0, 50, '0-50'), (1, 50, 100, '50-100'), (2, 100, 150, '100-150'), (3, 150, 200, '150-200'),
             (4, 200, 240, '200-240')) b(stage, lo, hi, label)
LEFT JOIN machines m ON m.tool_wear >= lo AND m.tool_wear < hi GROUP BY stage, label""",
        "machines",
    ),
)
def stage_rates(spark, sf_dir):
    return tidy(S.stage_rates(A.machines(spark, sf_dir), "tool_wear", "failure"))


@register(
    "error_histogram",
    oracle(
        f"""SELECT bin, {r("lo + bin * w")} AS low, {r("lo + (bin + 1) * w")} AS high, count(b) AS "rows"
FROM (SELECT unnest(range(40)) AS bin) CROSS JOIN ends
LEFT JOIN (SELECT least(CAST(floor((e - lo) / w) AS BIGINT), 39) AS b FROM err, ends) ON bin = b GROUP BY bin, lo, w""",
        "scored",
        ctes={
            "err": "SELECT (k * 3 + hour * 0.37::DOUBLE) - value AS e FROM scored",
            "ends": "SELECT min(e) AS lo, (max(e) - min(e)) / 40 AS w FROM err",
        },
    ),
)
def error_histogram(spark, sf_dir):
    df = A.scored(spark, sf_dir).withColumn("predicted", F.col("k") * 3 + F.col("hour") * 0.37)
    return tidy(S.error_histogram(df, "value", "predicted"))


@register(
    "prediction_sample",
    oracle(
        f"SELECT event_id, {r('value')} AS actual, {r('k * 3')} AS predicted FROM scored "
        "ORDER BY md5(concat_ws('|', event_id, 42)) LIMIT 2000",
        "scored",
    ),
)
def prediction_sample(spark, sf_dir):
    """The actual-against-predicted sample of 2000 rows that the report shows."""
    df = A.scored(spark, sf_dir).select("event_id", F.col("value").alias("actual"), (F.col("k") * 3).alias("predicted"))
    return tidy(P.sample_rows(df, "event_id", 2000))


@register(
    "null_counts",
    oracle(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) - count({e}) AS nulls FROM t"
            for c, e in (("event_id", "event_id"), ("s2", "s2"), ("s2_velocity", "v"), ("s2_trend", "t10"))
        ),
        "cycles",
        ctes={
            "t": "SELECT event_id, s2, s2 - lag(s2) OVER w AS v, CASE WHEN cycle >= 10 THEN s2 END AS t10 FROM cycles "
            "WINDOW w AS (PARTITION BY dataset_id, unit ORDER BY cycle)"
        },
    ),
)
def null_counts(spark, sf_dir):
    df = X.rolling_features(A.cycles(spark, sf_dir), ["s2"])
    return S.null_counts(df.select("event_id", "s2", "s2_velocity", "s2_trend"))


FACTORS = ["torque", "rpm", "tool_wear", "air_temp_c", "power_w"]


@register(
    "importance_report",
    oracle(
        f"""SELECT feature, {r("importance")} AS importance, {r("importance / sum(importance) OVER () * 100")} AS share_pct,
  CASE WHEN feature = 'power_w' THEN 'physics' ELSE 'sensor' END AS family
FROM (SELECT * FROM ("""
        + " UNION ALL ".join(f"SELECT '{c}' AS feature, abs(corr({c}, failure)) AS importance FROM t" for c in FACTORS)
        + ") ORDER BY importance DESC, feature LIMIT 4)",
        "machines",
        ctes={"t": "SELECT *, torque * (rpm * 2.0::DOUBLE * pi() / 60.0::DOUBLE) AS power_w FROM machines"},
    ),
)
def importance_report(spark, sf_dir):
    df = A.machines(spark, sf_dir).withColumn("power_w", power_w())
    strength = df.agg(*[F.abs(F.corr(c, "failure")).alias(c) for c in FACTORS])
    table = strength.unpivot([], FACTORS, "feature", "importance")
    return tidy(S.importance_report(table, S.machine_family(), 4))


@register(
    "top_values",
    oracle(
        f"SELECT dataset_id, unit, {r('max(s2)')} AS peak FROM cycles GROUP BY 1, 2 ORDER BY max(s2) DESC, 1, 2 LIMIT 10", "cycles"
    ),
)
def top_values(spark, sf_dir):
    peaks = A.cycles(spark, sf_dir).groupBy("dataset_id", "unit").agg(F.max("s2").alias("peak"))
    return tidy(peaks.orderBy(F.desc("peak"), "dataset_id", "unit").limit(10))


@register("first_rows", oracle(f"SELECT event_id, {r('value')} AS value FROM scored ORDER BY event_id LIMIT 5", "scored"))
def first_rows(spark, sf_dir):
    """The five-row example of the input that is stored with a model."""
    return tidy(A.scored(spark, sf_dir).select("event_id", "value").orderBy("event_id").limit(5))


@register(
    "feasibility",
    oracle(
        f"""SELECT count(*) AS total_scenarios, count(*) FILTER (tool_wear * torque <= 9000) AS feasible_count,
  count(*) FILTER (tool_wear * torque > 9000) AS infeasible_count,
  {r("count(*) FILTER (tool_wear * torque <= 9000) / count(*) * 100")} AS feasibility_rate FROM machines""",
        "machines",
    ),
)
def feasibility(spark, sf_dir):
    load = F.col("tool_wear") * F.col("torque")
    status = F.when(load <= 5000, "OPTIMAL").when(load <= 9000, "FEASIBLE").otherwise("INFEASIBLE")
    return tidy(S.feasibility(A.machines(spark, sf_dir).withColumn("status", status)))


# ---- survival ---------------------------------------------------------------------------------------------------

CURVE = {
    "grid": "SELECT fleet, unnest(range((SELECT max(lifetime) FROM lifetimes) + 1)) AS cycle FROM (SELECT DISTINCT fleet FROM lifetimes)",
    "curve": """SELECT g.fleet, g.cycle,
  count(*) FILTER (l.lifetime > g.cycle OR (l.lifetime = g.cycle AND l.censored)) AS active,
  count(*) FILTER (l.lifetime > g.cycle OR (l.lifetime = g.cycle AND l.censored)) / count(*) * 100 AS pct
FROM grid g JOIN lifetimes l ON g.fleet = l.fleet GROUP BY 1, 2""",
}


@register(
    "survival_curve",
    oracle(f"SELECT fleet, cycle, active, {r('pct')} AS survival_pct FROM curve", "lifetimes", ctes=CURVE),
)
def survival_curve(spark, sf_dir):
    return tidy(V.survival_curve(A.lifetimes(A.cycles(spark, sf_dir)), "fleet"))


@register(
    "half_life",
    oracle(
        f"""SELECT fleet, max(cycle) AS total_cycles, min(cycle) FILTER (pct <= 50) AS half_life_cycle,
  {r("arg_max(pct, cycle)")} AS final_survival_pct FROM curve GROUP BY fleet""",
        "lifetimes",
        ctes=CURVE,
    ),
)
def half_life(spark, sf_dir):
    return tidy(V.survival_summary(V.survival_curve(A.lifetimes(A.cycles(spark, sf_dir)), "fleet"), "fleet"))


@register(
    "lifetime_summary",
    oracle(
        f"""SELECT fleet, count(*) AS units, {r("avg(lifetime)")} AS mean_cycles, {r("stddev_pop(lifetime)")} AS std_cycles,
  min(lifetime) AS min_cycles, max(lifetime) AS max_cycles FROM lifetimes GROUP BY fleet""",
        "lifetimes",
    ),
)
def lifetime_summary(spark, sf_dir):
    return tidy(V.lifetime_summary(A.lifetimes(A.cycles(spark, sf_dir)), "fleet"))


@register(
    "life_extension",
    oracle(
        f"SELECT {r('m')} AS treated_mean, {r('u')} AS control_mean, {r('(m - u) / u * 100')} AS life_extension_pct FROM "
        "(SELECT avg(lifetime) FILTER (fleet = 'managed') AS m, avg(lifetime) FILTER (fleet = 'unmanaged') AS u FROM lifetimes)",
        "lifetimes",
    ),
)
def life_extension(spark, sf_dir):
    return tidy(V.life_extension(A.lifetimes(A.cycles(spark, sf_dir)), "fleet", "managed", "unmanaged"))


def _u_test(source: str, group: str, first: str, second: str, value: str) -> str:
    return f"""SELECT {r("na")} AS n_first, {r("nb")} AS n_second, {r("u")} AS u,
  {r("(u - na * nb / 2 - 0.5) / sqrt(na * nb / 12 * (na + nb + 1 - ties / ((na + nb) * (na + nb - 1))))")} AS z
FROM (SELECT sum(a) AS na, sum(n) - sum(a) AS nb, sum(a * rk) - sum(a) * (sum(a) + 1) / 2 AS u, sum(n * n * n - n) AS ties
      FROM (SELECT a, n, sum(n) OVER (ORDER BY v) - n + (n + 1) / 2 AS rk
            FROM (SELECT {value} AS v, sum(CASE WHEN {group} = '{first}' THEN 1 ELSE 0 END)::DOUBLE AS a, count(*)::DOUBLE AS n
                  FROM {source} WHERE {group} IN ('{first}', '{second}') GROUP BY 1)))"""


@register("mann_whitney", oracle(_u_test("lifetimes", "fleet", "managed", "unmanaged", "lifetime"), "lifetimes"))
def mann_whitney(spark, sf_dir):
    out = V.mann_whitney(A.lifetimes(A.cycles(spark, sf_dir)), "fleet", "managed", "unmanaged", "lifetime")
    return tidy(out.select("n_first", "n_second", "u", "z"))


@register("mann_whitney_orders", oracle(_u_test("orders", "o_orderstatus", "F", "O", "o_totalprice")))
def mann_whitney_orders(spark, sf_dir):
    out = V.mann_whitney(A.table(spark, sf_dir, "orders"), "o_orderstatus", "F", "O", "o_totalprice")
    return tidy(out.select("n_first", "n_second", "u", "z"))


# ---- metrics ----------------------------------------------------------------------------------------------------


@register(
    "class_weights",
    oracle(
        f"""SELECT event_id, label, {r("t / (classes * n)")} AS weight FROM scored
JOIN (SELECT label, count(*) AS n FROM scored GROUP BY 1) USING (label),
  (SELECT count(*)::DOUBLE AS t, count(DISTINCT label) AS classes FROM scored)""",
        "scored",
    ),
)
def class_weights(spark, sf_dir):
    return tidy(M.class_weights(A.scored(spark, sf_dir).select("event_id", "label"), "label"))


CONFUSION = """SELECT {by} count(*) FILTER (label = 0 AND flag = 0) AS tn, count(*) FILTER (label = 0 AND flag = 1) AS fp,
  count(*) FILTER (label = 1 AND flag = 0) AS fn, count(*) FILTER (label = 1 AND flag = 1) AS tp FROM scored {group}"""
RATIOS = (
    f"tn, fp, fn, tp, {r('coalesce(tp / nullif(tp + fp, 0), 0)')} AS precision, "
    f"{r('coalesce(tp / nullif(tp + fn, 0), 0)')} AS recall, {r('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)')} AS f1, "
    f"{r('(tp + tn) / (tp + tn + fp + fn)')} AS accuracy"
)


@register("confusion", oracle(f"SELECT {RATIOS} FROM c", "scored", ctes={"c": CONFUSION.format(by="", group="")}))
def confusion(spark, sf_dir):
    return tidy(M.confusion(A.scored(spark, sf_dir), "label", "flag"))


@register(
    "class_report",
    oracle(
        f"""SELECT y AS class, {r("coalesce(hits / p.n, 0)")} AS precision, {r("hits / a.n")} AS recall,
  {r("2 * hits / (a.n + coalesce(p.n, 0))")} AS f1, a.n AS support
FROM (SELECT label AS y, count(*) AS n, count(*) FILTER (label = flag) AS hits FROM scored GROUP BY 1) a
LEFT JOIN (SELECT flag AS q, count(*) AS n FROM scored GROUP BY 1) p ON y = q""",
        "scored",
    ),
)
def class_report(spark, sf_dir):
    return tidy(M.class_report(A.scored(spark, sf_dir), "label", "flag"))


def auc_sql(score: str, source: str, by: str = "", label: str = "label") -> str:
    part = f"PARTITION BY {by} " if by else ""
    return f"""SELECT {by + ',' if by else ''} sum({label})::BIGINT AS positives, (count(*) - sum({label}))::BIGINT AS negatives,
  {r(f"(sum({label} * rk) - sum({label}) * (sum({label}) + 1) / 2) / (sum({label})::DOUBLE * (count(*) - sum({label})))")} AS auc
FROM (SELECT {by + ',' if by else ''} {label}, (rank() OVER ({part}ORDER BY {score})
        + (count(*) OVER (PARTITION BY {by + ',' if by else ''} {score}) - 1) / 2.0)::DOUBLE AS rk FROM {source})
{'GROUP BY ' + by if by else ''}"""


@register("auc", oracle(auc_sql("score", "scored"), "scored"))
def auc(spark, sf_dir):
    return tidy(M.auc(A.scored(spark, sf_dir), "label", "score"))


@register("auc_tied", oracle(auc_sql("k", "scored", "event_type", "flag"), "scored"))
def auc_tied(spark, sf_dir):
    """AUC per group on a score with a hundred values, so nearly every row is tied."""
    df = A.scored(spark, sf_dir).select("event_type", F.col("flag"), "k")
    return tidy(M.auc(df, "flag", "k", ["event_type"]))


REGRESSION = f"""count(*) AS "rows", {r("sqrt(avg((y - p) ** 2))")} AS rmse, {r("avg(abs(y - p))")} AS mae,
  {r("1 - sum((y - p) ** 2) / (var_pop(y) * count(*))")} AS r2"""


@register(
    "regression_metrics",
    oracle(f"SELECT {REGRESSION} FROM (SELECT value AS y, least(k * 3, 125) AS p FROM scored)", "scored"),
)
def regression_metrics(spark, sf_dir):
    df = A.scored(spark, sf_dir).withColumn("p", clip(F.col("k") * 3, 0.0, 125.0))
    return tidy(M.regression_metrics(df, "value", "p"))


@register(
    "fold_f1",
    oracle(
        f"SELECT {r('avg(f1)')} AS cv_f1_mean, {r('stddev_pop(f1)')} AS cv_f1_std FROM "
        "(SELECT 2 * tp / (2 * tp + fp + fn) AS f1 FROM c)",
        "scored",
        ctes={
            "f": "SELECT *, (row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws('|', event_id, 42))) - 1) % 5 AS fold FROM scored",
            "c": CONFUSION.format(by="fold,", group="GROUP BY fold").replace("FROM scored", "FROM f"),
        },
    ),
)
def fold_f1(spark, sf_dir):
    dealt = P.folds(A.scored(spark, sf_dir), "event_id", 5, ["label"])
    return tidy(M.fold_summary(M.confusion(dealt, "label", "flag", ["fold"])))


@register(
    "model_report",
    oracle(
        f"SELECT is_test, {RATIOS}, positives, negatives, auc, rmse, mae, r2 FROM c JOIN a USING (is_test) JOIN e USING (is_test)",
        "scored",
        ctes={
            "s": "SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws('|', event_id, 42))) "
            "<= ceil(0.2::DOUBLE * count(*) OVER (PARTITION BY label)) AS is_test FROM scored",
            "c": CONFUSION.format(by="is_test,", group="GROUP BY is_test").replace("FROM scored", "FROM s"),
            "a": auc_sql("score", "s", "is_test"),
            "e": f"SELECT is_test, {REGRESSION} FROM (SELECT is_test, value AS y, k * 3 AS p FROM s) GROUP BY is_test",
        },
    ),
)
def model_report(spark, sf_dir):
    """Train against test: confusion, AUC and regression errors on given predictions."""
    df = P.holdout(A.scored(spark, sf_dir).withColumn("p", F.col("k") * 3), "event_id", 0.2, ["label"])
    df = write_table(df, scratch_path(spark, "split"))
    cells = M.confusion(df, "label", "flag", ["is_test"])
    curve = M.auc(df, "label", "score", ["is_test"])
    errors = M.regression_metrics(df, "value", "p", ["is_test"]).drop("rows")
    return tidy(cells.join(F.broadcast(curve), "is_test").join(F.broadcast(errors), "is_test"))

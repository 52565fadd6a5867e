"""Contracts, integrity, split validation, drift, readiness."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugework.operators import drift as D
from gaugework.operators import metrics as M
from gaugework.operators import quality as Q
from gaugework.operators import readiness as G
from gaugework.operators import sampling as P
from gaugework.operators import survival as V
from gaugework.operators import summary as S
from gaugework.plans import adapters as A
from gaugework.plans.catalog.registry import oracle, r, register, tidy


@register(
    "contract_checks",
    oracle(
        """SELECT "check", value = 0 AS passed, value FROM (
  SELECT 'has_torque' AS "check", 0::BIGINT AS value UNION ALL SELECT 'has_RNF', 1 UNION ALL SELECT 'no_air_temp_k', 0
  UNION ALL SELECT 'type_failure', 0 UNION ALL SELECT 'type_torque', 1
  UNION ALL SELECT 'nulls_torque', count(*) - count(torque) FROM machines
  UNION ALL SELECT 'nulls_failure', count(*) - count(failure) FROM machines
  UNION ALL SELECT 'range_tool_wear', count(*) FILTER (tool_wear < 0 OR tool_wear > 240) FROM machines
  UNION ALL SELECT 'range_torque', count(*) FILTER (torque > 60) FROM machines)""",
        "machines",
    ),
)
def contract_checks(spark, sf_dir):
    return Q.contract_checks(
        A.machines(spark, sf_dir),
        required=["torque", "RNF"],
        forbidden=["air_temp_k"],
        not_null=["torque", "failure"],
        ranges={"tool_wear": (0, 240), "torque": (None, 60)},
        types={"failure": "bigint", "torque": "bigint"},
    )


def _profile(col: str, numeric: bool) -> str:
    fence = f"(SELECT quantile_cont({col}, [0.25::DOUBLE, 0.75::DOUBLE]) AS q FROM t)"
    out = f"count(*) FILTER ({col} < q[1] - 1.5 * (q[2] - q[1]) OR {col} > q[2] + 1.5 * (q[2] - q[1]))" if numeric else "0::BIGINT"
    return (
        f"SELECT '{col}' AS \"column\", count(*) - count({col}) AS missing, count(DISTINCT {col}) AS distinct_values, {out} AS outliers, "
        f"count(DISTINCT {col}) <= 1 AS is_constant FROM t{', ' + fence if numeric else ''}"
    )


@register(
    "column_profile",
    oracle(
        " UNION ALL ".join([_profile(c, True) for c in ("value", "k", "hour", "one")] + [_profile("event_type", False)]),
        "scored",
        ctes={
            "t": "SELECT CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 97 = 0 THEN value + 900 ELSE value END AS value, k, hour, "
            "1.0::DOUBLE AS one, CASE WHEN k > 90 THEN NULL ELSE event_type END AS event_type FROM scored"
        },
    ),
)
def column_profile(spark, sf_dir):
    e = F.col("event_id")
    holed = F.when(e % 11 == 0, None).when(e % 97 == 0, F.col("value") + 900).otherwise(F.col("value"))
    df = A.scored(spark, sf_dir).select(
        holed.alias("value"), "k", "hour", F.lit(1.0).alias("one"), F.when(F.col("k") <= 90, F.col("event_type")).alias("event_type")
    )
    return Q.column_profile(df, ["value", "k", "hour", "one"], ["event_type"])


@register(
    "duplicate_rows",
    oracle(
        """SELECT sum(n)::BIGINT AS "rows", sum(n - 1)::BIGINT AS duplicate_rows, count(*) FILTER (n > 1) AS duplicated_groups
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"""
    ),
)
def duplicate_rows(spark, sf_dir):
    return Q.duplicate_rows(A.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register(
    "conflicting_labels",
    oracle(
        """SELECT coalesce(sum(n) FILTER (lo <> hi), 0)::BIGINT AS conflicting_rows, count(*) FILTER (lo <> hi) AS conflicting_groups
FROM (SELECT count(*) AS n, min(failure) AS lo, max(failure) AS hi FROM machines GROUP BY torque, tool_wear)""",
        "machines",
    ),
)
def conflicting_labels(spark, sf_dir):
    return Q.conflicting_labels(A.machines(spark, sf_dir), ["torque", "tool_wear"], "failure")


SPLIT = {
    "s": "SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', event_id, 42))) <= ceil(0.2::DOUBLE * count(*) OVER ()) AS is_test "
    "FROM scored"
}


def _split(spark, sf_dir):
    return P.holdout(A.scored(spark, sf_dir), "event_id", 0.2)


@register(
    "row_overlap",
    oracle(
        """SELECT count(*) FILTER (NOT is_test) AS train_rows, count(*) FILTER (is_test) AS test_rows,
  count(*) FILTER (is_test AND (k, hour, label) IN (SELECT (k, hour, label) FROM s WHERE NOT is_test)) AS test_rows_in_train FROM s""",
        "scored",
        ctes=SPLIT,
    ),
)
def row_overlap(spark, sf_dir):
    return Q.row_overlap(_split(spark, sf_dir), ["k", "hour", "label"])


@register(
    "group_leakage",
    oracle(
        'SELECT count(*) AS "groups", count(*) FILTER (lo <> hi) AS leaking_groups FROM '
        "(SELECT min(is_test::INT) AS lo, max(is_test::INT) AS hi FROM s GROUP BY user_id)",
        "scored",
        ctes=SPLIT,
    ),
)
def group_leakage(spark, sf_dir):
    return Q.group_leakage(_split(spark, sf_dir), ["user_id"])


@register(
    "range_shift",
    oracle(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", {r('lo')} AS train_min, {r('hi')} AS train_max, {r('tlo')} AS test_min, {r('thi')} AS test_max, "
            f"count(*) FILTER ({c} < lo OR {c} > hi) AS test_outside FROM s, (SELECT min({c}) FILTER (NOT is_test) AS lo, "
            f"max({c}) FILTER (NOT is_test) AS hi, min({c}) FILTER (is_test) AS tlo, max({c}) FILTER (is_test) AS thi FROM s) "
            "WHERE is_test GROUP BY lo, hi, tlo, thi"
            for c in ("value", "k")
        ),
        "scored",
        ctes=SPLIT,
    ),
)
def range_shift(spark, sf_dir):
    return tidy(Q.range_shift(_split(spark, sf_dir), ["value", "k"]))


@register(
    "label_shift",
    oracle(
        f"""SELECT event_type AS label, {r("a / (SELECT count(*) FILTER (NOT is_test) FROM s)")} AS train_share,
  {r("b / (SELECT count(*) FILTER (is_test) FROM s)")} AS test_share,
  {r("b / (SELECT count(*) FILTER (is_test) FROM s) - a / (SELECT count(*) FILTER (NOT is_test) FROM s)")} AS shift
FROM (SELECT event_type, count(*) FILTER (NOT is_test) AS a, count(*) FILTER (is_test) AS b FROM s GROUP BY 1)""",
        "scored",
        ctes=SPLIT,
    ),
)
def label_shift(spark, sf_dir):
    return tidy(Q.label_shift(_split(spark, sf_dir), "event_type"))


# ---- drift between finished and open orders ------------------------------------------------------------------------

DRIFT_COLUMNS = ["o_totalprice", "o_custkey", "o_orderkey"]
SIDES = {
    "sides": "SELECT o_orderstatus = 'F' AS is_ref, o_totalprice * CASE WHEN o_orderstatus = 'O' THEN 1.15::DOUBLE ELSE 1 END "
    "AS o_totalprice, o_custkey::DOUBLE AS o_custkey, o_orderkey::DOUBLE AS o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'O')",
    "long": " UNION ALL ".join(f"SELECT '{c}' AS \"column\", is_ref, {c} AS v FROM sides" for c in DRIFT_COLUMNS),
    "totals": 'SELECT "column", count(*) FILTER (is_ref)::DOUBLE AS n, count(*) FILTER (NOT is_ref)::DOUBLE AS m, '
    "stddev_pop(v) FILTER (is_ref) AS sd, min(v) FILTER (is_ref) AS lo, max(v) FILTER (is_ref) AS hi FROM long GROUP BY 1",
    "steps": """SELECT "column", v, sum(a) OVER w AS ca, sum(b) OVER w AS cb, lead(v) OVER w AS nv
FROM (SELECT "column", v, count(*) FILTER (is_ref) AS a, count(*) FILTER (NOT is_ref) AS b FROM long GROUP BY 1, 2)
WINDOW w AS (PARTITION BY "column" ORDER BY v)""",
    "dist": """SELECT "column", n, m, sd, max(abs(ca / n - cb / m)) AS ks, coalesce(sum(abs(ca / n - cb / m) * (nv - v)), 0) AS wd
FROM steps JOIN totals USING ("column") GROUP BY 1, 2, 3, 4""",
}


def sides(spark, sf_dir):
    orders = A.table(spark, sf_dir, "orders").select("o_orderstatus", *DRIFT_COLUMNS)
    ref = orders.filter(F.col("o_orderstatus") == "F")
    cur = orders.filter(F.col("o_orderstatus") == "O").withColumn("o_totalprice", F.col("o_totalprice") * 1.15)
    return ref, cur


@register(
    "drift_distance",
    oracle(
        f"""SELECT "column", n::BIGINT AS ref_rows, m::BIGINT AS cur_rows, {r("ks")} AS ks, {r("wd", 4)} AS wasserstein,
  {r("wd / greatest(sd, 0.001)")} AS wasserstein_norm, ks > 1.358::DOUBLE * sqrt((n + m) / (n * m)) AS ks_drifted,
  wd / greatest(sd, 0.001) >= 0.1 AS drifted FROM dist""",
        ctes=SIDES,
    ),
)
def drift_distance(spark, sf_dir):
    out = D.ks_and_wasserstein(*sides(spark, sf_dir), DRIFT_COLUMNS)
    return tidy(out.withColumn("wasserstein", F.round("wasserstein", 4)))


@register(
    "drift_psi",
    oracle(
        f"""SELECT "column", {r("sum((q - p) * ln(q / p))")} AS psi FROM (
  SELECT "column", greatest(count(*) FILTER (is_ref) / n, 0.0001::DOUBLE) AS p, greatest(count(*) FILTER (NOT is_ref) / m, 0.0001::DOUBLE) AS q
  FROM long JOIN totals USING ("column") GROUP BY "column", n, m, greatest(0, least(9, CAST(floor((v - lo) * 10 / (hi - lo)) AS BIGINT))))
GROUP BY 1""",
        ctes=SIDES,
    ),
)
def drift_psi(spark, sf_dir):
    return tidy(D.psi(*sides(spark, sf_dir), DRIFT_COLUMNS))


@register(
    "dataset_drift",
    oracle(
        f"""SELECT count(*) AS "columns", count(*) FILTER (hit) AS drifted_columns, {r("count(*) FILTER (hit) / count(*)")} AS drift_share,
  count(*) FILTER (hit) / count(*) >= 0.5 AS dataset_drift FROM (SELECT wd / greatest(sd, 0.001) >= 0.1 AS hit FROM dist)""",
        ctes=SIDES,
    ),
)
def dataset_drift(spark, sf_dir):
    return tidy(D.dataset_drift(D.ks_and_wasserstein(*sides(spark, sf_dir), DRIFT_COLUMNS)))


@register(
    "label_drift",
    oracle(
        f"""SELECT {r("js")} AS js_distance, js >= 0.1 AS drifted FROM (
  SELECT sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
                            + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS js
  FROM (SELECT failure, count(*) FILTER (prod_type = 0) / (SELECT count(*) FROM machines WHERE prod_type = 0) AS p,
               count(*) FILTER (prod_type <> 0) / (SELECT count(*) FROM machines WHERE prod_type <> 0) AS q
        FROM machines GROUP BY failure))""",
        "machines",
    ),
)
def label_drift(spark, sf_dir):
    df = A.machines(spark, sf_dir)
    return tidy(D.label_drift(df.filter(F.col("prod_type") == 0), df.filter(F.col("prod_type") != 0), "failure"))


@register(
    "missing_comparison",
    oracle(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) FILTER (ref AND {c} IS NULL) AS ref_missing, count(*) FILTER (NOT ref AND {c} IS NULL) "
            f"AS cur_missing, {r(f'count(*) FILTER (ref AND {c} IS NULL) / count(*) FILTER (ref)')} AS ref_share, "
            f"{r(f'count(*) FILTER (NOT ref AND {c} IS NULL) / count(*) FILTER (NOT ref)')} AS cur_share FROM t"
            for c in ("value", "k")
        ),
        "scored",
        ctes={"t": "SELECT label = 0 AS ref, CASE WHEN value <= 200 THEN value END AS value, CASE WHEN k <> 3 THEN k END AS k FROM scored"},
    ),
)
def missing_comparison(spark, sf_dir):
    df = A.scored(spark, sf_dir).select(
        "label", F.when(F.col("value") <= 200, F.col("value")).alias("value"), F.when(F.col("k") != 3, F.col("k")).alias("k")
    )
    return tidy(D.missing_comparison(df.filter("label = 0"), df.filter("label = 1"), ["value", "k"]))


# ---- readiness -----------------------------------------------------------------------------------------------------


def metric_rows(spark, sf_dir):
    """Metrics of given predictions as rows (metric, value); the significance comes from the lifetimes."""
    df = A.scored(spark, sf_dir).withColumn("p", F.col("value") * 0.9 + F.col("k") * 0.1)
    cells = M.confusion(df, "label", "flag").select("f1", "precision").unpivot([], ["f1", "precision"], "metric", "value")
    errors = M.regression_metrics(df, "value", "p").select("r2", "rmse").unpivot([], ["r2", "rmse"], "metric", "value")
    test = V.mann_whitney(A.lifetimes(A.cycles(spark, sf_dir)), "fleet", "managed", "unmanaged", "lifetime")
    sig = test.select(F.lit("significant").alias("metric"), F.col("significant").cast("double").alias("value"))
    return cells.unionByName(errors).unionByName(sig)


METRICS = {
    "m": """SELECT 2 * tp / (2 * tp + fp + fn) AS f1, tp / (tp + fp) AS "precision", r2, rmse, u_z > 1.6448536269514722::DOUBLE AS sig
FROM (SELECT count(*) FILTER (label = 1 AND flag = 1) AS tp, count(*) FILTER (label = 0 AND flag = 1) AS fp,
             count(*) FILTER (label = 1 AND flag = 0) AS fn,
             1 - sum((value - p) ** 2) / (var_pop(value) * count(*)) AS r2, sqrt(avg((value - p) ** 2)) AS rmse
      FROM (SELECT *, value * 0.9::DOUBLE + k * 0.1::DOUBLE AS p FROM scored)),
  (SELECT (u - na * nb / 2 - 0.5) / sqrt(na * nb / 12 * (na + nb + 1 - ties / ((na + nb) * (na + nb - 1)))) AS u_z
   FROM (SELECT sum(a) AS na, sum(n) - sum(a) AS nb, sum(a * rk) - sum(a) * (sum(a) + 1) / 2 AS u, sum(n * n * n - n) AS ties
         FROM (SELECT a, n, sum(n) OVER (ORDER BY lifetime) - n + (n + 1) / 2 AS rk
               FROM (SELECT lifetime, count(*) FILTER (fleet = 'managed')::DOUBLE AS a, count(*)::DOUBLE AS n FROM lifetimes GROUP BY 1))))""",
    "checks": """SELECT 'r2_above_0.7' AS "check", 'r2' AS metric, r2 AS value, r2 >= 0.7 AS passed FROM m
UNION ALL SELECT 'rmse_below_25', 'rmse', rmse, rmse < 25 FROM m
UNION ALL SELECT 'f1_above_0.6', 'f1', f1, f1 >= 0.6 FROM m
UNION ALL SELECT 'precision_above_0.8', 'precision', "precision", "precision" >= 0.8 FROM m
UNION ALL SELECT 'comparison_significant', 'significant', sig::INT::DOUBLE, sig FROM m""",
}


@register(
    "gate_checks",
    oracle(f'SELECT "check", metric, {r("value")} AS value, passed FROM checks', "scored", "lifetimes", ctes=METRICS),
)
def gate_checks(spark, sf_dir):
    return tidy(G.gate_checks(metric_rows(spark, sf_dir)))


@register(
    "readiness",
    oracle(
        "SELECT true AS all_inputs_present, bool_and(passed) AS all_metrics_pass, count(*) FILTER (passed) AS gates_passed, "
        "bool_and(passed) AS ready FROM checks",
        "scored",
        "lifetimes",
        ctes=METRICS,
    ),
)
def readiness(spark, sf_dir):
    from gaugework.sources.tables import present_inputs

    inputs = present_inputs(spark, {t: f"{sf_dir}/{t}.parquet" for t in ("events", "orders", "lineitem")})
    return G.readiness(metric_rows(spark, sf_dir), inputs)


@register(
    "headlines",
    oracle(
        f"""SELECT {r("rmse")} AS rmse, {r("r2")} AS r2, {r("f1")} AS f1, {r('"precision"')} AS "precision",
  {r("(mm - um) / um * 100")} AS life_extension_pct, anomaly_count, failure_count FROM m,
  (SELECT avg(lifetime) FILTER (fleet = 'managed') AS mm, avg(lifetime) FILTER (fleet = 'unmanaged') AS um FROM lifetimes),
  (SELECT sum(flag)::BIGINT AS anomaly_count, sum(label)::BIGINT AS failure_count FROM scored)""",
        "scored",
        "lifetimes",
        ctes=METRICS,
    ),
)
def headlines(spark, sf_dir):
    """The nested record of all parts, read back as flat headline columns."""
    scores = A.scored(spark, sf_dir)
    counts = S.anomaly_summary(
        scores.select(F.col("label").alias("failure"), F.col("flag").alias("is_anomaly"), F.col("score").alias("failure_prob"))
    )
    life = V.life_extension(A.lifetimes(A.cycles(spark, sf_dir)), "fleet", "managed", "unmanaged")
    record = G.compile_record(
        {"models": G.wide(metric_rows(spark, sf_dir), ["rmse", "r2", "f1", "precision"]), "fleet": life, "anomalies": counts}
    )
    return tidy(
        record.select("models.*", "fleet.life_extension_pct", "anomalies.anomaly_count", "anomalies.failure_count")
    )

"""Projections, features, windows and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugework.functions import machine
from gaugework.functions.engine import MULTI_CONDITION, physics
from gaugework.operators import columns as C
from gaugework.operators import features as X
from gaugework.operators.quality import _count_if
from gaugework.operators.smoothing import savgol
from gaugework.operators.summary import fleet_profile, fleet_statistics
from gaugework.plans import adapters as A
from gaugework.plans.catalog.registry import oracle, r, register, tidy
from gaugework.plans.engines import clean_cycles, engine_features
from gaugework.session import scratch_path
from gaugework.sources.tables import write_table

SENSORS = ["s2", "s3", "s4", "s8", "s9", "s11", "s15"]
ENGINEERED = ["thermal_stress", "pressure_heat_index", "efficiency_proxy", "compressor_delta"] + [
    f"{s}_{k}" for s in SENSORS for k in ("velocity", "trend")
]


def _zscored(cols: list[str]) -> str:
    return ", ".join(f"(({c}) - avg({c}) OVER w) / (stddev_samp({c}) OVER w + 1e-6) AS {c}" for c in cols)


FEATURE_CTES = {
    "normed": f"SELECT * REPLACE ({_zscored(SENSORS)}) FROM clustered WINDOW w AS (PARTITION BY dataset_id, condition_cluster)",
    "lived": "SELECT *, max(cycle) OVER (PARTITION BY dataset_id, unit) - cycle AS rul FROM normed",
    "physical": "SELECT *, s11 * s15 AS thermal_stress, s4 * s11 AS pressure_heat_index, s9 / (s8 + 1e-6) AS efficiency_proxy, "
    "s3 - s2 AS compressor_delta FROM lived",
    "rolled": "SELECT * REPLACE (least(rul, 125) AS rul), "
    + ", ".join(
        f"{s} - lag({s}) OVER w AS {s}_velocity, CASE WHEN count({s}) OVER w10 = 10 THEN avg({s}) OVER w10 END AS {s}_trend"
        for s in SENSORS
    )
    + " FROM physical WINDOW w AS (PARTITION BY dataset_id, unit ORDER BY cycle), "
    "w10 AS (PARTITION BY dataset_id, unit ORDER BY cycle ROWS 9 PRECEDING)",
    "filled": "SELECT * REPLACE (" + ", ".join(f"coalesce({c}, 0) AS {c}" for c in ENGINEERED) + ") FROM rolled",
    "feat": f"SELECT * REPLACE ({_zscored(ENGINEERED)}) FROM filled WINDOW w AS ()",
}


def features(spark, sf_dir):
    """Cycles and unscaled features are stored once, as their statistics take several passes over them."""
    cycles = write_table(A.cycles(spark, sf_dir), scratch_path(spark, "cycles"))
    return engine_features(clean_cycles(cycles, SENSORS), store=scratch_path(spark, "unscaled"), position="cycle", trusted=True)


@register(
    "engine_features",
    oracle(
        "SELECT event_id, dataset_id, unit, cycle, condition_cluster, rul, "
        + ", ".join(f"{r(c)} AS {c}" for c in SENSORS + ENGINEERED)
        + " FROM feat",
        "clustered",
        ctes=FEATURE_CTES,
    ),
)
def engine_feature_table(spark, sf_dir):
    cols = ["event_id", "dataset_id", "unit", "cycle", "condition_cluster", "rul", *SENSORS, *ENGINEERED]
    return tidy(features(spark, sf_dir).select(*cols))


@register(
    "fleet_profile",
    oracle(
        f"""SELECT coalesce(dataset_id, 'all') AS dataset_id, count(DISTINCT dataset_id || '_' || unit) AS engines,
  count(*) AS "rows", {r("avg(rul)")} AS mean_rul, min(rul) AS min_rul, max(rul) AS max_rul,
  count(*) FILTER (rul < 20) AS critical_count, {r("avg(abs(thermal_stress))")} AS mean_abs_stress,
  {r("avg(abs(s2_trend))")} AS mean_abs_trend, {r("max(s2_velocity)")} AS max_velocity
FROM feat GROUP BY ROLLUP (feat.dataset_id)""",
        "clustered",
        ctes=FEATURE_CTES,
    ),
)
def fleet(spark, sf_dir):
    feats = features(spark, sf_dir)
    engines = feats.groupBy("dataset_id", "unit").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("rul").alias("life"),
        F.min("rul").alias("lo"),
        F.max("rul").alias("hi"),
        _count_if(F.col("rul") < 20).alias("critical"),
        F.sum(F.abs("thermal_stress")).alias("stress"),
        F.sum(F.abs("s2_trend")).alias("trend"),
        F.max("s2_velocity").alias("velocity"),
    )
    rows = F.sum("n")
    out = engines.rollup("dataset_id").agg(
        F.count(F.lit(1)).alias("engines"),
        rows.alias("rows"),
        (F.sum("life") / rows).alias("mean_rul"),
        F.min("lo").alias("min_rul"),
        F.max("hi").alias("max_rul"),
        F.sum("critical").alias("critical_count"),
        (F.sum("stress") / rows).alias("mean_abs_stress"),
        (F.sum("trend") / rows).alias("mean_abs_trend"),
        F.max("velocity").alias("max_velocity"),
    )
    return tidy(out.withColumn("dataset_id", F.coalesce("dataset_id", F.lit("all"))))


def _nearest(column: str, share: float) -> str:
    return f"list_sort(list({column}))[round_even({share} * (count({column}) - 1), 0)::INT + 1]"


@register(
    "fleet_statistics",
    oracle(
        f"""SELECT coalesce(dataset_id, 'all') AS dataset_id, {r("quantile_cont(rul, 0.5)")} AS median_rul, {r("avg(thermal_stress)")} AS mean_stress,
  {r("stddev_samp(thermal_stress)")} AS std_stress, {r(_nearest("thermal_stress", 0.9))} AS p90_stress,
  {r(_nearest("thermal_stress", 0.95))} AS p95_stress
FROM lived GROUP BY ROLLUP (lived.dataset_id)""",
        "cycles",
        ctes={"lived": "SELECT *, s11 * s15 AS thermal_stress, max(cycle) OVER (PARTITION BY dataset_id, unit) - cycle AS rul FROM cycles"},
    ),
)
def statistics_of_fleet(spark, sf_dir):
    """Middle of the remaining lives and the spread of thermal stress, by data set and overall."""
    return tidy(fleet_statistics(X.engine_physics(X.remaining_life(A.cycles(spark, sf_dir)))))


@register(
    "life_profile",
    oracle(
        f"""SELECT coalesce(dataset_id, 'all') AS dataset_id, count(DISTINCT dataset_id || '_' || unit) AS engines,
  count(*) AS "rows", {r("avg(rul)")} AS mean_rul, min(rul) AS min_rul, max(rul) AS max_rul,
  count(*) FILTER (rul < 20) AS critical_count
FROM lived GROUP BY ROLLUP (lived.dataset_id)""",
        "cycles",
        ctes={"lived": "SELECT *, max(cycle) OVER (PARTITION BY dataset_id, unit) - cycle AS rul FROM cycles"},
    ),
)
def life_profile(spark, sf_dir):
    return tidy(fleet_profile(X.remaining_life(A.cycles(spark, sf_dir))))


@register(
    "encode_and_convert",
    oracle(
        f"""SELECT udi AS "UDI", prod_type, {r("air_temp_c")} AS air_temp_c, {r("proc_temp_c")} AS proc_temp_c, rpm,
  {r("torque")} AS torque, tool_wear, {r("power_w")} AS power_w, {r("proc_temp_c - air_temp_c")} AS temp_delta,
  {r("lim - tool_wear * torque")} AS overstrain_margin, {r("(1 - tool_wear * torque / lim) * 100")} AS margin_pct,
  {r("greatest(0, (1 - tool_wear * torque / lim) * 100)")} AS margin_pct_floor
FROM (SELECT *, CASE prod_type WHEN 0 THEN 11000 WHEN 1 THEN 12000 ELSE 13000 END AS lim FROM clean_log)""",
        "clean_log",
    ),
)
def encode_and_convert(spark, sf_dir):
    clean = X.clean_machines(A.machine_log(spark, sf_dir))
    return tidy(
        clean.select(
            "UDI", "prod_type", "air_temp_c", "proc_temp_c", "rpm", "torque", "tool_wear", "power_w",
            (F.col("proc_temp_c") - F.col("air_temp_c")).alias("temp_delta"),
            machine.overstrain_margin().alias("overstrain_margin"),
            machine.overstrain_margin_pct().alias("margin_pct"),
            machine.overstrain_margin_pct(floor=True).alias("margin_pct_floor"),
        )
    )


@register(
    "cast_and_literal",
    oracle(
        f"""SELECT 'FD001' AS dataset_id, {r("l_orderkey")} AS l_orderkey, {r("l_linenumber")} AS l_linenumber,
  {r("l_quantity")} AS l_quantity FROM lineitem"""
    ),
)
def cast_and_literal(spark, sf_dir):
    li = A.table(spark, sf_dir, "lineitem")
    keep = ["l_orderkey", "l_linenumber", "l_quantity"]
    dropped = C.drop_columns(li, [c for c in li.columns if c not in keep] + ["not_there"])
    return tidy(C.with_literal(C.cast_all(dropped), "dataset_id", "FD001"))


@register(
    "range_filters",
    oracle(
        f"""SELECT event_id, dataset_id, rul, {r("s2")} AS s2 FROM lived
WHERE rul BETWEEN 20 AND 49 AND dataset_id IN ('FD001', 'FD003') AND s2 > 30 AND label = 0""",
        "cycles",
        ctes={"lived": "SELECT *, max(cycle) OVER (PARTITION BY dataset_id, unit) - cycle AS rul FROM cycles"},
    ),
)
def range_filters(spark, sf_dir):
    df = X.remaining_life(A.cycles(spark, sf_dir))
    hit = F.col("rul").between(20, 49) & F.col("dataset_id").isin("FD001", "FD003")
    return tidy(df.filter(hit & (F.col("s2") > 30) & (F.col("label") == 0)).select("event_id", "dataset_id", "rul", "s2"))


@register(
    "select_by_schema",
    oracle(
        f"""SELECT event_id, {r("s11 * s15")} AS thermal_stress, {r("s4 * s11")} AS pressure_heat_index,
  {r("s9 / (s8 + 1e-6)")} AS efficiency_proxy, {r("s3 - s2")} AS compressor_delta FROM cycles""",
        "cycles",
    ),
)
def select_by_schema(spark, sf_dir):
    df = X.engine_physics(A.cycles(spark, sf_dir))
    picked = C.select_features(df, ["unit", "cycle", "rul"], ("double",), ["thermal", "pressure", "efficiency", "compressor"])
    return tidy(df.select("event_id", *picked))


@register(
    "global_unit",
    oracle("SELECT dataset_id || '_' || unit AS global_unit, count(*) AS \"rows\" FROM cycles GROUP BY ALL", "cycles"),
)
def global_units(spark, sf_dir):
    df = A.cycles(spark, sf_dir).withColumn("global_unit", C.global_unit())
    return df.groupBy("global_unit").agg(F.count(F.lit(1)).alias("rows"))


@register(
    "fill_and_clip",
    oracle(
        f"""SELECT event_id, {r("coalesce(v, 0)")} AS velocity, {r("least(s2, 125)")} AS capped,
  {r("greatest(10, least(s2, 125))")} AS held
FROM (SELECT *, s2 - lag(s2) OVER (PARTITION BY dataset_id, unit ORDER BY cycle) AS v FROM cycles)""",
        "cycles",
    ),
)
def fill_and_clip(spark, sf_dir):
    df = C.fill_null(X.rolling_features(A.cycles(spark, sf_dir), ["s2"], trend=False), ["s2_velocity"], 0.0)
    return tidy(
        df.select(
            "event_id",
            F.col("s2_velocity").alias("velocity"),
            C.clip("s2", high=125.0).alias("capped"),
            C.clip("s2", 10.0, 125.0).alias("held"),
        )
    )


@register(
    "cold_start_columns",
    oracle(
        f"SELECT prod_type, {r('torque')} AS torque, {r('0')} AS s4_trend, {r('0')} AS s4_velocity, count(*) AS \"rows\" "
        "FROM machines GROUP BY ALL",
        "machines",
    ),
)
def cold_start(spark, sf_dir):
    df = C.ensure_columns(A.machines(spark, sf_dir), ["torque", "s4_trend", "s4_velocity"])
    return tidy(df.groupBy("prod_type", "torque", "s4_trend", "s4_velocity").agg(F.count(F.lit(1)).alias("rows")))


@register(
    "engine_state",
    oracle(f"SELECT event_id, {r('s2')} AS s2 FROM cycles WHERE dataset_id = 'FD002' AND unit = 3 AND cycle = 5", "cycles"),
)
def engine_state(spark, sf_dir):
    return tidy(C.engine_state(A.cycles(spark, sf_dir), "FD002", 3, 5).select("event_id", "s2"))


@register(
    "engine_list",
    oracle("SELECT unit, max(cycle) AS max_cycle FROM cycles WHERE dataset_id = 'FD003' GROUP BY unit", "cycles"),
)
def engine_list(spark, sf_dir):
    return C.engine_list(A.cycles(spark, sf_dir), "FD003")


@register(
    "scalar_functions",
    oracle(
        f"""SELECT event_id, {r("round(value, 1)")} AS rounded, {r("abs(value - 60)")} AS gap, {r("sqrt(value)")} AS root,
  {r("least(value, k)")} AS low, {r("greatest(value, k)")} AS high, upper(event_type) AS upper_type,
  string_split(trim('  ' || event_type || ' x '), ' ')[1] AS first_word, concat_ws('_', event_type, user_id) AS key,
  printf('%d of %s', event_id, event_type) AS message
FROM scored""",
        "scored",
    ),
)
def scalar_functions(spark, sf_dir):
    df = A.scored(spark, sf_dir)
    v, k = F.col("value"), F.col("k")
    return tidy(
        df.select(
            "event_id",
            F.round(v, 1).alias("rounded"),
            F.abs(v - 60).alias("gap"),
            F.sqrt(v).alias("root"),
            F.least(v, k).alias("low"),
            F.greatest(v, k).alias("high"),
            F.upper("event_type").alias("upper_type"),
            F.split(F.trim(F.concat(F.lit("  "), F.col("event_type"), F.lit(" x "))), " ")[0].alias("first_word"),
            F.concat_ws("_", "event_type", F.col("user_id").cast("string")).alias("key"),
            F.format_string("%d of %s", F.col("event_id"), F.col("event_type")).alias("message"),
        )
    )


@register(
    "stress_index",
    oracle(
        f"""SELECT prod_type, tool_wear, rpm, {r("torque")} AS torque,
  {r("(torque / (SELECT max(torque) FROM machines)) * (rpm / (SELECT max(rpm) FROM machines))")} AS stress_index
FROM machines""",
        "machines",
    ),
)
def stress_index(spark, sf_dir):
    df = X.machine_physics(A.machines(spark, sf_dir))
    return tidy(df.select("prod_type", "tool_wear", "rpm", "torque", "stress_index"))


@register(
    "minmax_scale",
    oracle(
        "SELECT prod_type, failure, "
        + ", ".join(
            r(f"CASE WHEN (SELECT max({c}) = min({c}) FROM m) THEN 0 ELSE ({c} - (SELECT min({c}) FROM m))::DOUBLE / "
              f"nullif((SELECT max({c}) - min({c}) FROM m), 0) END") + f" AS {c}"
            for c in ("torque", "rpm", "tool_wear", "constant")
        )
        + " FROM m",
        "machines",
        ctes={"m": "SELECT *, 7::BIGINT AS constant FROM machines"},
    ),
)
def minmax_scale(spark, sf_dir):
    df = A.machines(spark, sf_dir).withColumn("constant", F.lit(7).cast("long"))
    cols = ["torque", "rpm", "tool_wear", "constant"]
    return tidy(X.minmax(df, cols).select("prod_type", "failure", *cols))


@register(
    "physics_features",
    oracle(
        f"""SELECT event_id, {r("s11 * s15")} AS thermal_stress, {r("s4 * s11")} AS pressure_heat_index,
  {r("s9 / (s8 + 1e-6)")} AS efficiency_proxy, {r("s3 - s2")} AS compressor_delta FROM cycles""",
        "cycles",
    ),
)
def physics_features(spark, sf_dir):
    return tidy(A.cycles(spark, sf_dir).withColumns(physics()).select("event_id", *physics()))


@register(
    "remaining_life",
    oracle(
        """SELECT event_id, max(cycle) OVER (PARTITION BY dataset_id, unit) - cycle AS rul_full,
  least(max(cycle) OVER (PARTITION BY dataset_id, unit) - cycle, 40) AS rul FROM cycles""",
        "cycles",
    ),
)
def remaining_life(spark, sf_dir):
    full = X.remaining_life(A.cycles(spark, sf_dir)).withColumnRenamed("rul", "rul_full")
    return full.select("event_id", "rul_full", F.least("rul_full", F.lit(40)).alias("rul"))


@register(
    "condition_cluster",
    oracle("SELECT event_id, dataset_id, condition_cluster FROM clustered", "clustered"),
)
def condition_cluster(spark, sf_dir):
    df = X.condition_clusters(A.cycles(spark, sf_dir), only=MULTI_CONDITION)
    return tidy(df.select("event_id", "dataset_id", "condition_cluster"))


@register(
    "condition_settings",
    oracle(f"SELECT DISTINCT dataset_id, {r('round(op_set1, 2)')} AS setting FROM cycles", "cycles"),
)
def condition_settings(spark, sf_dir):
    rounded = F.round("op_set1", 2).alias("setting")
    return tidy(A.cycles(spark, sf_dir).select("dataset_id", rounded).distinct())


@register(
    "condition_zscore",
    oracle(
        "SELECT event_id, " + ", ".join(f"{r(s)} AS {s}" for s in SENSORS) + " FROM normed",
        "clustered",
        ctes={"normed": FEATURE_CTES["normed"]},
    ),
)
def condition_zscore(spark, sf_dir):
    df = X.condition_clusters(A.cycles(spark, sf_dir), only=MULTI_CONDITION)
    return tidy(X.group_zscore(df, SENSORS, ["dataset_id", "condition_cluster"]).select("event_id", *SENSORS))


@register(
    "velocity",
    oracle(
        "SELECT event_id, "
        + ", ".join(f"{r(f'{s} - lag({s}) OVER w')} AS {s}_velocity" for s in ("s2", "s3", "s11"))
        + " FROM cycles WINDOW w AS (PARTITION BY dataset_id, unit ORDER BY cycle)",
        "cycles",
    ),
)
def velocity(spark, sf_dir):
    df = X.rolling_features(A.cycles(spark, sf_dir), ["s2", "s3", "s11"], trend=False)
    return tidy(df.select("event_id", "s2_velocity", "s3_velocity", "s11_velocity"))


@register(
    "trend",
    oracle(
        "SELECT event_id, "
        + ", ".join(
            r(f"CASE WHEN count({s}) OVER w = 10 THEN avg({s}) OVER w END") + f" AS {s}_trend" for s in ("s2", "s3", "s11")
        )
        + " FROM cycles WINDOW w AS (PARTITION BY dataset_id, unit ORDER BY cycle ROWS 9 PRECEDING)",
        "cycles",
    ),
)
def trend(spark, sf_dir):
    df = X.rolling_features(A.cycles(spark, sf_dir), ["s2", "s3", "s11"], velocity=False)
    return tidy(df.select("event_id", "s2_trend", "s3_trend", "s11_trend"))


@register(
    "engineered_zscore",
    oracle(
        f"""SELECT event_id, {r("(v - avg(v) OVER ()) / (stddev_samp(v) OVER () + 1e-6)")} AS s2_velocity,
  {r("(h - avg(h) OVER ()) / (stddev_samp(h) OVER () + 1e-6)")} AS thermal_stress
FROM (SELECT event_id, s11 * s15 AS h, coalesce(s2 - lag(s2) OVER (PARTITION BY dataset_id, unit ORDER BY cycle), 0) AS v
      FROM cycles)""",
        "cycles",
    ),
)
def engineered(spark, sf_dir):
    df = X.engine_physics(X.rolling_features(A.cycles(spark, sf_dir), ["s2"], trend=False))
    return tidy(X.engineered_zscore(df, ["velocity", "thermal"]).select("event_id", "s2_velocity", "thermal_stress"))


# least-squares cubic on 11 points, worked out by hand: interior row over 429, first five rows over 858
INTERIOR = [-36, 9, 44, 69, 84, 89, 84, 69, 44, 9, -36]
EDGE = [
    [678, 288, 48, -72, -102, -72, -12, 48, 78, 48, -72],
    [288, 246, 192, 132, 72, 18, -24, -48, -48, -18, 48],
    [48, 192, 246, 232, 172, 88, 2, -64, -88, -48, 78],
    [-72, 132, 232, 251, 212, 138, 52, -23, -64, -48, 48],
    [-102, 72, 172, 212, 206, 168, 112, 52, 2, -24, -12],
]


def _at(col: str, k: int) -> str:
    return col if k == 0 else f"{'lead' if k > 0 else 'lag'}({col}, {abs(k)}) OVER w"


def _smooth_sql(col: str) -> str:
    def fit(weights, i, scale):
        return "(" + " + ".join(f"({w}) * {_at(col, j - i)}" for j, w in enumerate(weights)) + f") / {scale}.0::DOUBLE"

    cases = [f"WHEN n < 11 THEN {col}"]
    for i in range(5):
        cases.append(f"WHEN p = {i + 1} THEN {fit(EDGE[i], i, 858)}")
        cases.append(f"WHEN n - p = {i} THEN {fit(EDGE[i][::-1], 10 - i, 858)}")
    return "CASE " + " ".join(cases) + f" ELSE {fit(INTERIOR, 5, 429)} END"


@register(
    "savgol",
    oracle(
        f"SELECT event_id, {r(_smooth_sql('s2'))} AS s2_smooth, {r(_smooth_sql('s4'))} AS s4_smooth FROM p "
        "WINDOW w AS (PARTITION BY dataset_id, unit ORDER BY cycle)",
        "cycles",
        ctes={"p": "SELECT *, cycle AS p, count(*) OVER (PARTITION BY dataset_id, unit) AS n FROM cycles"},
    ),
)
def savgol_by_engine(spark, sf_dir):
    df = savgol(A.cycles(spark, sf_dir), ["s2", "s4"], ["dataset_id", "unit"], ["cycle"])
    return tidy(df.select("event_id", "s2_smooth", "s4_smooth"))


SERIES = oracle(
    f'SELECT udi AS "UDI", {r(_smooth_sql("power_w"), 4)} AS power_w_smooth, {r(_smooth_sql("torque"), 4)} AS torque_smooth '
    "FROM p WINDOW w AS (ORDER BY udi)",
    "clean_log",
    ctes={"p": "SELECT *, row_number() OVER (ORDER BY udi) AS p, count(*) OVER () AS n FROM clean_log"},
)


@register("savgol_series", SERIES)
def savgol_series(spark, sf_dir, **options):
    """The whole table is one series; beyond the slice size it is cut into slices that overlap by the filter's reach."""
    clean = X.clean_machines(A.machine_log(spark, sf_dir)).select("UDI", "power_w", "torque")
    df = savgol(clean, ["power_w", "torque"], [], ["UDI"], **options)
    return tidy(df.select("UDI", "power_w_smooth", "torque_smooth"), 4)


@register("savgol_series_cut", SERIES)
def savgol_series_cut(spark, sf_dir):
    """The same series in slices of 2,000 rows."""
    return savgol_series(spark, sf_dir, limit=2000)


@register(
    "union_parts",
    oracle(
        f"SELECT dataset_id, count(*) AS \"rows\", {r('sum(s3)')} AS s3_sum FROM "
        "(SELECT dataset_id, s2, s3 FROM cycles WHERE dataset_id <> 'FD004' UNION ALL BY NAME "
        "SELECT dataset_id, s2 FROM cycles WHERE dataset_id = 'FD004') GROUP BY dataset_id",
        "cycles",
    ),
)
def union_parts(spark, sf_dir):
    df = A.cycles(spark, sf_dir)
    parts = [
        df.filter(F.col("dataset_id") != "FD004").select("dataset_id", "s2", "s3"),
        df.filter(F.col("dataset_id") == "FD004").select("dataset_id", "s2"),
    ]
    return tidy(C.union_parts(parts).groupBy("dataset_id").agg(F.count(F.lit(1)).alias("rows"), F.sum("s3").alias("s3_sum")))

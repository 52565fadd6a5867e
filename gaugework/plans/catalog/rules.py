"""Rule flags, bands, setpoints, interventions and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugework.functions import machine
from gaugework.operators import features as X
from gaugework.operators import recommend as R
from gaugework.operators.models import audit
from gaugework.operators.sizing import attach_row
from gaugework.plans import adapters as A
from gaugework.plans.catalog.causal import FITTED, MACHINE_SQL, fitted_effects, machine_rows
from gaugework.plans.catalog.registry import oracle, r, register, tidy
from gaugework.streaming.live import score_readings

LIMIT = "CASE prod_type WHEN 0 THEN 11000 WHEN 1 THEN 12000 ELSE 13000 END"


@register(
    "rule_flags",
    oracle(
        f"""SELECT prod_type, tool_wear, rpm, {r("torque")} AS torque, temp_delta < 8.6::DOUBLE AS heat_risk,
  power_w < 3500 OR power_w > 9000 AS power_risk, tool_wear >= 200 AS wear_risk, {LIMIT} - tool_wear * torque < 0 AS overstrain_risk,
  greatest(0, (1 - tool_wear * torque / {LIMIT}) * 100) < 20 AS overstrain_caution FROM m""",
        "machines",
        ctes=MACHINE_SQL,
    ),
)
def rule_flags(spark, sf_dir):
    flags = machine.rule_flags()
    return tidy(machine_rows(spark, sf_dir).withColumns(flags).select("prod_type", "tool_wear", "rpm", "torque", *flags))


LIVED = {"lived": "SELECT *, max(cycle) OVER (PARTITION BY dataset_id, unit) - cycle AS rul, s11 * s15 AS thermal_stress FROM cycles"}
URGENCY = "CASE WHEN rul < 20 THEN 'CRITICAL' WHEN rul < 50 THEN 'WARNING' WHEN rul < 80 THEN 'CAUTION' ELSE 'NORMAL' END"
REDUCTION = "CASE WHEN rul < 20 THEN 0.4 WHEN rul < 50 THEN 0.3 WHEN rul < 80 THEN 0.2 ELSE 0.0 END::DOUBLE"


def _lived(spark, sf_dir):
    return X.engine_physics(X.remaining_life(A.cycles(spark, sf_dir)))


@register(
    "life_urgency",
    oracle(
        f"""SELECT event_id, rul, {URGENCY} AS urgency, {r(REDUCTION)} AS max_reduction, {r("least(rul / 125, 1)")} AS life_share,
  {r("greatest(0, least(100, rul / 200 * 100))")} AS life_bar_pct,
  CASE WHEN rul < 20 THEN 'critical' WHEN rul < 50 THEN 'degrading' ELSE 'healthy' END AS scenario FROM lived""",
        "cycles",
        ctes=LIVED,
    ),
)
def life_urgency(spark, sf_dir):
    df = X.remaining_life(A.cycles(spark, sf_dir))
    return tidy(
        df.select(
            "event_id",
            "rul",
            machine.life_urgency("rul").alias("urgency"),
            machine.max_reduction("rul").alias("max_reduction"),
            machine.life_share("rul").alias("life_share"),
            machine.life_bar_pct("rul").alias("life_bar_pct"),
            machine.scenario_key("rul").alias("scenario"),
        )
    )


@register(
    "operator_bands",
    oracle(
        f"""SELECT prod_type, tool_wear, rpm, {r("torque")} AS torque,
  CASE WHEN p > 0.5 THEN 'critical' WHEN p > 0.2 THEN 'warning' ELSE 'ok' END AS failure_band,
  {r("greatest(0, danger_threshold - tool_wear)", 4)} AS minutes_to_danger,
  CASE WHEN danger_threshold - tool_wear < 30 THEN 'critical' WHEN danger_threshold - tool_wear < 60 THEN 'warning' ELSE 'ok' END
    AS danger_band,
  CASE WHEN tool_wear >= danger_threshold THEN 'CRITICAL' WHEN tool_wear >= 200 THEN 'WARNING' WHEN tool_wear >= 150 THEN 'CAUTION'
       ELSE 'NORMAL' END AS wear_urgency,
  CASE WHEN tool_wear < 50 THEN 8000 WHEN tool_wear < 150 THEN 7500 WHEN tool_wear < 200 THEN 7000 WHEN tool_wear < 220 THEN 6000
       ELSE 5000 END::DOUBLE AS target_power
FROM (SELECT *, torque / 60 AS p FROM machines), fitted""",
        "machines",
        ctes=FITTED,
    ),
)
def operator_bands(spark, sf_dir):
    rows = machine_rows(spark, sf_dir)
    df = attach_row(rows, fitted_effects(rows).select("danger_threshold"))
    left = machine.minutes_to_danger("tool_wear", "danger_threshold")
    return tidy(
        df.select(
            "prod_type", "tool_wear", "rpm", "torque",
            machine.failure_band(F.col("torque") / 60).alias("failure_band"),
            F.round(left, 4).alias("minutes_to_danger"),
            machine.danger_band(left).alias("danger_band"),
            machine.wear_urgency("tool_wear", "danger_threshold").alias("wear_urgency"),
            machine.target_power("tool_wear").alias("target_power"),
        )
    )


def setpoint_ctes(source: str, danger: str) -> dict[str, str]:
    """Brute force over all torques and retry targets for the distinct (type, wear, target) of a table."""
    return {
        "asks": f"SELECT DISTINCT prod_type, tool_wear, target, {danger} AS danger FROM {source}",
        "caps": f"""SELECT *, least(greatest(10, least(75, floor({LIMIT} * 0.8::DOUBLE / greatest(tool_wear, 1)))),
  CASE WHEN tool_wear >= 200 THEN 40 ELSE 75 END, CASE WHEN tool_wear >= danger THEN 35 ELSE 75 END)::BIGINT AS cap FROM asks""",
        "tries": """SELECT *, target - 1000 * i AS goal, floor((target - 1000 * i) * 1000 / 105.0::DOUBLE) AS product
FROM caps, (SELECT unnest(range(0, 20)) AS i) WHERE i = 0 OR target - 1000 * (i - 1) > 4000""",
        "bounds": "SELECT *, greatest(33334, product - floor(product * 0.05::DOUBLE)) AS lo, "
        "least(85714, product + floor(product * 0.05::DOUBLE)) AS hi FROM tries",
        "points": """SELECT prod_type, tool_wear, target, i, goal, lo, max(q) AS q FROM bounds, (SELECT unnest(range(10, 76)) AS q)
WHERE q <= cap AND greatest(1200, ceil(lo / q)) <= least(2800, floor(hi / q)) GROUP BY ALL""",
        "best": "SELECT * FROM points QUALIFY row_number() OVER (PARTITION BY prod_type, tool_wear, target ORDER BY i) = 1",
        "solved": f"""SELECT a.prod_type, a.tool_wear, a.target, a.danger, b.q IS NOT NULL AS ok, coalesce(b.q, 0) AS torque_nm,
  CASE WHEN b.q IS NULL THEN 0 ELSE greatest(1200, ceil(b.lo / b.q)) END::BIGINT AS setpoint_rpm,
  coalesce(b.goal, (SELECT min(goal) FROM tries t WHERE t.prod_type = a.prod_type AND t.tool_wear = a.tool_wear
                    AND t.target = a.target)) AS goal, {LIMIT.replace("prod_type", "a.prod_type")} AS lim
FROM asks a LEFT JOIN best b ON a.prod_type = b.prod_type AND a.tool_wear = b.tool_wear AND a.target = b.target""",
    }


POINT_COLUMNS = f"""CASE WHEN ok THEN 'OPTIMAL' ELSE 'INFEASIBLE' END AS status,
  CASE WHEN NOT ok OR tool_wear >= danger THEN 'CRITICAL' WHEN tool_wear >= 200 THEN 'WARNING' WHEN tool_wear >= 150 THEN 'CAUTION'
       ELSE 'NORMAL' END AS urgency, {r("goal")} AS target_power_w, torque_nm, setpoint_rpm,
  {r("torque_nm * (setpoint_rpm * 2.0::DOUBLE * pi() / 60.0::DOUBLE)")} AS setpoint_power_w,
  {r("CASE WHEN ok THEN (1 - tool_wear * torque_nm / lim) * 100 ELSE 0 END")} AS osf_margin_pct"""
TARGET = (
    "CASE WHEN tool_wear < 50 THEN 8000 WHEN tool_wear < 150 THEN 7500 WHEN tool_wear < 200 THEN 7000 "
    "WHEN tool_wear < 220 THEN 6000 ELSE 5000 END::DOUBLE"
)
POINTS = ["status", "urgency", "target_power_w", "torque_nm", "setpoint_rpm", "setpoint_power_w", "osf_margin_pct"]


@register(
    "setpoint",
    oracle(
        f"SELECT m.prod_type, m.tool_wear, {r('m.torque')} AS torque, {POINT_COLUMNS.replace('tool_wear', 's.tool_wear')} FROM m "
        "JOIN solved s ON m.prod_type = s.prod_type AND m.tool_wear = s.tool_wear AND m.target = s.target",
        "machines",
        ctes={"m": f"SELECT *, {TARGET} AS target FROM machines", **setpoint_ctes("m", "240")},
    ),
)
def setpoint(spark, sf_dir):
    out = R.setpoints(A.machines(spark, sf_dir), danger=240.0)
    return tidy(out.select("prod_type", "tool_wear", "torque", *POINTS))


@register(
    "setpoint_for_load",
    oracle(
        f"SELECT m.prod_type, m.tool_wear, m.target, {POINT_COLUMNS.replace('tool_wear', 's.tool_wear')}, count(*) AS \"rows\" FROM m "
        "JOIN solved s ON m.prod_type = s.prod_type AND m.tool_wear = s.tool_wear AND m.target = s.target GROUP BY ALL",
        "machines",
        ctes={
            "m": "SELECT prod_type, tool_wear, (floor(torque * rpm / 2000) * 250 + 1000)::DOUBLE AS target FROM machines",
            **setpoint_ctes("m", "200"),
        },
    ),
)
def setpoint_for_load(spark, sf_dir):
    """Operator-given targets from 1 to 16 kW, so that retries and infeasible rows occur."""
    load = F.floor(F.col("torque") * F.col("rpm") / 2000) * 250 + 1000
    df = A.machines(spark, sf_dir).select("prod_type", "tool_wear", load.cast("double").alias("target"))
    out = R.setpoints(df, target="target", danger=200.0)
    keys = ["prod_type", "tool_wear", "target", *POINTS]
    return tidy(tidy(out.select(*keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")))


STAGES = ", ".join(f"('{name}', {w}, {t}::DOUBLE)" for name, (w, t) in R.SCENARIOS.items())
GRID = {
    **FITTED,
    "grid": "SELECT scenario, prod_type, tool_wear::BIGINT AS tool_wear, target, danger_threshold FROM fitted, "
    f"(VALUES {STAGES}) s(scenario, tool_wear, target), (SELECT unnest([0, 1, 2]) AS prod_type)",
    **setpoint_ctes("grid", "danger_threshold"),
}


def _solved_grid(rows):
    grid = R.scenario_table(fitted_effects(rows))
    return R.setpoints(grid, target="target", danger=F.col("danger_threshold"))


@register(
    "setpoint_grid",
    oracle(
        f"""SELECT g.scenario, g.prod_type, g.tool_wear, {POINT_COLUMNS.replace('tool_wear', 's.tool_wear')}
FROM grid g JOIN solved s ON g.prod_type = s.prod_type AND g.tool_wear = s.tool_wear AND g.target = s.target""",
        "machines",
        ctes=GRID,
    ),
)
def setpoint_grid(spark, sf_dir):
    """The 15 scenarios, solved with the danger threshold fitted on all machine rows."""
    return tidy(_solved_grid(machine_rows(spark, sf_dir)).select("scenario", "prod_type", "tool_wear", *POINTS))


NEAR = {
    "worn": "SELECT DISTINCT tool_wear AS wear FROM machines",
    "near": "SELECT wear, arg_min(scenario, abs(w - wear) * 1000 + w) AS scenario, min(abs(w - wear)) AS gap FROM worn, (VALUES "
    + ", ".join(f"('{n}', {w})" for n, (w, _) in R.SCENARIOS.items())
    + ") v(scenario, w) GROUP BY wear",
}


@register(
    "nearest_scenario",
    oracle(
        """SELECT tool_wear, scenario AS matched_scenario, CASE WHEN gap <= 10 THEN scenario END AS within_ten, count(*) AS "rows"
FROM machines JOIN near ON tool_wear = wear GROUP BY ALL""",
        "machines",
        ctes=NEAR,
    ),
)
def nearest_scenario(spark, sf_dir):
    df = A.machines(spark, sf_dir).withColumns(
        {"matched_scenario": R.nearest_scenario(), "within_ten": R.nearest_scenario(tolerance=10)}
    )
    return df.groupBy("tool_wear", "matched_scenario", "within_ten").agg(F.count(F.lit(1)).alias("rows"))


@register(
    "setpoint_lookup",
    oracle(
        """SELECT type_code, m.tool_wear, CASE WHEN g.scenario IS NOT NULL THEN n.scenario END AS matched_scenario, s.ok AS solved,
  s.torque_nm, s.setpoint_rpm, CASE WHEN g.scenario IS NULL THEN 'unknown product type (known: L, M, H): ' || type_code END AS error,
  count(*) AS "rows"
FROM asked m JOIN near n ON m.tool_wear = n.wear
LEFT JOIN grid g ON g.scenario = n.scenario AND g.prod_type = CASE upper(type_code) WHEN 'L' THEN 0 WHEN 'M' THEN 1 WHEN 'H' THEN 2 END
LEFT JOIN solved s ON g.prod_type = s.prod_type AND g.tool_wear = s.tool_wear AND g.target = s.target
GROUP BY ALL""",
        "machines",
        ctes={
            "asked": "SELECT *, CASE WHEN rpm % 10 = 0 THEN 'x' WHEN prod_type = 0 THEN 'l' WHEN prod_type = 1 THEN 'M' ELSE 'h' END "
            "AS type_code FROM machines",
            **NEAR,
            **GRID,
        },
    ),
)
def setpoint_lookup(spark, sf_dir):
    rows = machine_rows(spark, sf_dir)
    code = F.when(F.col("rpm") % 10 == 0, "x").when(F.col("prod_type") == 0, "l").when(F.col("prod_type") == 1, "M").otherwise("h")
    asked = rows.select(code.alias("type_code"), "tool_wear")
    out = R.lookup_setpoint(asked, _solved_grid(rows)).withColumn("solved", F.col("status") == "OPTIMAL")
    keys = ["type_code", "tool_wear", "matched_scenario", "solved", "torque_nm", "setpoint_rpm", "error"]
    return tidy(out.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")))


@register(
    "setpoint_or_lookup",
    oracle(
        """SELECT m.prod_type, m.tool_wear, CASE WHEN gap <= 10 THEN 'lookup' ELSE 'solve' END AS source,
  """
        + ", ".join(f"CASE WHEN gap <= 10 THEN g.{c} ELSE s.{c} END AS {c}" for c in POINTS)
        + """, count(*) AS "rows"
FROM machines m JOIN near n ON m.tool_wear = n.wear
JOIN g_out g ON g.scenario = n.scenario AND g.prod_type = m.prod_type
JOIN s_out s ON m.prod_type = s.prod_type AND m.tool_wear = s.tool_wear AND s.target = """
        + TARGET.replace("tool_wear", "m.tool_wear")
        + " GROUP BY ALL",
        "machines",
        ctes={
            **NEAR,
            **{
                f"g_{name}": body.replace("FROM asks", "FROM g_asks").replace("FROM caps", "FROM g_caps")
                .replace("FROM tries", "FROM g_tries").replace("FROM bounds", "FROM g_bounds").replace("FROM points", "FROM g_points")
                .replace("JOIN best", "JOIN g_best")
                for name, body in setpoint_ctes(
                    f"(SELECT prod_type, tool_wear, target FROM (VALUES {STAGES}) s(scenario, tool_wear, target), "
                    "(SELECT unnest([0, 1, 2]) AS prod_type))",
                    "200",
                ).items()
            },
            "scenario_points": f"SELECT scenario, g_solved.* FROM g_solved JOIN (VALUES {STAGES}) s(scenario, w, t) ON tool_wear = w",
            **setpoint_ctes(f"(SELECT *, {TARGET} AS target FROM machines)", "200"),
            "g_out": f"SELECT scenario, prod_type, {POINT_COLUMNS} FROM scenario_points",
            "s_out": f"SELECT prod_type, tool_wear, target, {POINT_COLUMNS} FROM solved",
        },
    ),
)
def setpoint_or_lookup(spark, sf_dir):
    df = A.machines(spark, sf_dir)
    grid = R.setpoints(R.scenario_table(df.agg(F.lit(200.0).alias("danger"))), target="target", danger=F.col("danger"))
    out = R.setpoint_or_lookup(df.select("prod_type", "tool_wear"), grid, danger=200.0)
    return tidy(out.groupBy("prod_type", "tool_wear", "source", *POINTS).agg(F.count(F.lit(1)).alias("rows")))


@register(
    "setpoint_text",
    oracle(
        f"""SELECT m.prod_type, m.tool_wear, CASE WHEN ok THEN printf('To reach %.0f W run at %d rpm and %d Nm, which gives %.0f W '
  || 'and leaves %.1f%% of the overstrain limit (%s).', goal, setpoint_rpm, torque_nm, torque_nm * (setpoint_rpm * 2.0::DOUBLE * pi() / 60.0::DOUBLE),
  round(round((1 - s.tool_wear * torque_nm / lim) * 100, 6), 1), CASE WHEN s.tool_wear >= danger THEN 'CRITICAL'
  WHEN s.tool_wear >= 200 THEN 'WARNING' WHEN s.tool_wear >= 150 THEN 'CAUTION' ELSE 'NORMAL' END)
  ELSE 'No speed and torque are within limits: replace the tool now' END AS recommendation, count(*) AS "rows" FROM m
JOIN solved s ON m.prod_type = s.prod_type AND m.tool_wear = s.tool_wear AND m.target = s.target GROUP BY ALL""",
        "machines",
        ctes={"m": f"SELECT *, {TARGET} AS target FROM machines", **setpoint_ctes("m", "240")},
    ),
)
def setpoint_text(spark, sf_dir):
    out = R.setpoints(A.machines(spark, sf_dir), danger=240.0).withColumn("recommendation", R.setpoint_text())
    return out.groupBy("prod_type", "tool_wear", "recommendation").agg(F.count(F.lit(1)).alias("rows"))


STATUS = f"CASE WHEN ({REDUCTION}) = 0 OR thermal_stress <= 0.1 THEN 'NO_INTERVENTION_NEEDED' ELSE 'SUCCESS' END"


@register(
    "intervention",
    oracle(
        f"""SELECT event_id, rul, status, {URGENCY} AS urgency, {r(REDUCTION)} AS max_reduction,
  {r("CASE WHEN status = 'SUCCESS' THEN best END")} AS best_stress,
  {r("CASE WHEN status = 'SUCCESS' THEN thermal_stress - best END")} AS stress_reduction,
  {r("CASE WHEN status = 'SUCCESS' THEN (thermal_stress - best) / abs(thermal_stress) * 100 END")} AS stress_reduction_pct,
  {r("CASE WHEN status = 'SUCCESS' THEN 8.6275::DOUBLE * (thermal_stress - best) ELSE 0 END")} AS causal_gain
FROM (SELECT *, {STATUS} AS status, thermal_stress * (1 - {REDUCTION}) AS best FROM lived)""",
        "cycles",
        ctes=LIVED,
    ),
)
def intervention(spark, sf_dir):
    out = R.interventions(_lived(spark, sf_dir), "thermal_stress", "rul", -8.6275, True)
    return tidy(
        out.select(
            "event_id", "rul", "status", "urgency", "max_reduction", "best_stress", "stress_reduction", "stress_reduction_pct",
            "causal_gain",
        )
    )


@register(
    "intervention_text",
    oracle(
        f"""SELECT event_id, CASE WHEN status = 'SUCCESS' THEN printf('%s: take %.0f%% off the thermal stress; this should add %.1f to '
  || '%.1f cycles, for a remaining life of %.1f to %.1f cycles', {URGENCY}, cut / abs(thermal_stress) * 100, 0.0::DOUBLE,
  8.6275::DOUBLE * cut, rul::DOUBLE, rul + 8.6275::DOUBLE * cut)
  ELSE printf('Nothing to do: %.1f cycles of life remain', rul::DOUBLE) END AS recommendation
FROM (SELECT *, {STATUS} AS status, thermal_stress - thermal_stress * (1 - {REDUCTION}) AS cut FROM lived)""",
        "cycles",
        ctes=LIVED,
    ),
)
def intervention_text(spark, sf_dir):
    df = _lived(spark, sf_dir).withColumn("life", F.col("rul").cast("double"))
    out = R.interventions(df, "thermal_stress", "life", -8.6275, True)
    return out.select("event_id", R.intervention_text("life").alias("recommendation"))


@register(
    "what_if_inputs",
    oracle(
        f"""SELECT event_id, {r("CASE WHEN moved THEN s11 * root ELSE s11 END")} AS s11,
  {r("CASE WHEN moved THEN s15 * root ELSE s15 END")} AS s15, {r("CASE WHEN moved THEN best ELSE thermal_stress END")} AS thermal_stress
FROM (SELECT *, status = 'SUCCESS' AND abs(thermal_stress) > 1e-6 AS moved, sqrt(abs(best / nullif(thermal_stress, 0))) AS root
      FROM (SELECT *, {STATUS} AS status, thermal_stress * (1 - {REDUCTION}) AS best FROM lived))""",
        "cycles",
        ctes=LIVED,
    ),
)
def what_if_inputs(spark, sf_dir):
    out = R.what_if_inputs(R.interventions(_lived(spark, sf_dir), "thermal_stress", "rul", -8.6275, True))
    return tidy(out.select("event_id", "s11", "s15", "thermal_stress"))


@register(
    "audit",
    oracle(
        f"""SELECT event_id, CASE WHEN rul < 30 OR is_anomaly = 1 THEN 'CRITICAL' ELSE 'STABLE' END AS status,
  {r("greatest(0, least(100, rul / 200 * 100))")} AS life_bar_pct, is_anomaly = 1 AS anomaly_detected, {r("score - 0.5")} AS health_score
FROM (SELECT event_id, value / 2 AS rul, flag AS is_anomaly, score FROM scored)""",
        "scored",
    ),
)
def audit_scores(spark, sf_dir):
    df = A.scored(spark, sf_dir).select(
        "event_id",
        (F.col("value") / 2).alias("predicted_rul"),
        F.col("flag").alias("is_anomaly"),
        (F.col("score") - 0.5).alias("anomaly_score"),
    )
    return tidy(audit(df).select("event_id", "status", "life_bar_pct", "anomaly_detected", "health_score"))


LIVE_COLUMNS = ["rpm", "torque", "tool_wear", "power_w", "temp_delta", "stress_index", "overstrain_margin"]
LIVE_SQL = oracle(
    f"""SELECT prod_type, failure, {r("power_w")} AS power_w, {r("temp_delta")} AS temp_delta, {r("stress_index")} AS stress_index,
  {r("overstrain_margin")} AS overstrain_margin, temp_delta < 8.6::DOUBLE AS heat_risk, power_w < 3500 OR power_w > 9000 AS power_risk,
  overstrain_margin < 0 AS overstrain_risk, {r(TARGET)} AS target_power_w, """
    + ", ".join(
        f"{r(f'greatest(0, least(1, ({c} - ({lo}::DOUBLE)) / {hi - lo}::DOUBLE))')} AS {c}_scaled"
        for c, (lo, hi) in machine.LIVE_RANGES.items()
        if c in LIVE_COLUMNS
    )
    + " FROM live",
    "machines",
    ctes={
        **MACHINE_SQL,
        "live": f"SELECT *, torque / 75.0::DOUBLE * (rpm / 2800.0::DOUBLE) AS stress_index, {LIMIT} - tool_wear * torque AS "
        "overstrain_margin FROM m",
    },
)


def live_output(df):
    cols = ["prod_type", "failure", "power_w", "temp_delta", "stress_index", "overstrain_margin", "heat_risk", "power_risk"]
    cols += ["overstrain_risk", "target_power_w", *[f"{c}_scaled" for c in machine.LIVE_RANGES if c in LIVE_COLUMNS]]
    return tidy(score_readings(df).select(*cols))


@register("live_readings", LIVE_SQL)
def live_readings(spark, sf_dir):
    return live_output(A.machines(spark, sf_dir))

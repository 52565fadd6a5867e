"""Effects, refutations and causal risk."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from gaugework.functions.engine import dataset_code
from gaugework.functions.machine import power_w
from gaugework.operators import causal as K
from gaugework.operators import features as X
from gaugework.operators import recommend as R
from gaugework.operators.columns import with_literal
from gaugework.operators.sampling import capped_sample
from gaugework.operators.sizing import attach_row
from gaugework.plans import adapters as A
from gaugework.plans.catalog.registry import oracle, r, register, tidy

MACHINE_SQL = {
    "m": "SELECT *, torque * (rpm * 2.0::DOUBLE * pi() / 60.0::DOUBLE) AS power_w, proc_temp_c - air_temp_c AS temp_delta FROM machines"
}


def machine_rows(spark, sf_dir):
    df = A.machines(spark, sf_dir)
    return df.withColumns({"power_w": power_w(), "temp_delta": F.col("proc_temp_c") - F.col("air_temp_c")})


def residual_ctes(source: str, treatment: str, outcome: str, confounders: list[str], tag: str) -> dict[str, str]:
    """CTEs that take the confounders out one after the other; the effect is regr_slope(y, t) on the last."""
    zs = [f"z{i}" for i in range(len(confounders))]
    start = f"SELECT {treatment}::DOUBLE AS t, {outcome}::DOUBLE AS y" + "".join(
        f", {c}::DOUBLE AS {z}" for c, z in zip(confounders, zs)
    )
    ctes = {f"{tag}_0": f"{start} FROM {source}"}
    for i, z in enumerate(zs):
        rest = ["t", "y", *zs[i + 1 :]]
        slopes = ", ".join(f"regr_slope({c}, {z}) AS b_{c}" for c in rest)
        left = ", ".join(f"{c} - b_{c} * {z} AS {c}" for c in rest)
        ctes[f"{tag}_{i + 1}"] = f"SELECT {left} FROM {tag}_{i}, (SELECT {slopes} FROM {tag}_{i})"
    return ctes


def last(tag: str, confounders: list[str]) -> str:
    return f"{tag}_{len(confounders)}"


WEAR = ("tool_wear", "failure", ["prod_type", "torque", "rpm"])
POWER = ("power_w", "failure", ["temp_delta", "tool_wear", "prod_type"])


@register(
    "effect_ols",
    oracle(
        " UNION ALL ".join(
            f"SELECT '{t}' AS treatment, {r('regr_slope(y, t)', 10)} AS effect, count(*) AS \"rows\", {r('(SELECT avg(failure) FROM m)')} "
            f"AS outcome_mean FROM {last(t, z)}"
            for t, _, z in (WEAR, POWER)
        ),
        "machines",
        ctes={**MACHINE_SQL, **residual_ctes("m", *WEAR, "tool_wear"), **residual_ctes("m", *POWER, "power_w")},
    ),
)
def effect_ols(spark, sf_dir):
    rows = machine_rows(spark, sf_dir)
    parts = [with_literal(K.effect(rows, *spec), "treatment", spec[0]) for spec in (WEAR, POWER)]
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.select(
        "treatment",
        (F.round("effect", 10) + 0.0).alias("effect"),
        "rows",
        (F.round("outcome_mean", 6) + 0.0).alias("outcome_mean"),
    )


LIFE = ("thermal_stress", "rul", ["condition_cluster", "dataset_code", "cycle"])
LIFE_SQL = {
    "l": "SELECT *, s11 * s15 AS thermal_stress, right(dataset_id, 1)::INT - 1 AS dataset_code, "
    "max(cycle) OVER (PARTITION BY dataset_id, unit) - cycle AS rul FROM clustered"
}


def _life_rows(spark, sf_dir):
    df = X.condition_clusters(A.cycles(spark, sf_dir), only=["FD002", "FD004"])
    code = F.substring("dataset_id", 5, 1).cast("int") - 1
    return X.engine_physics(X.remaining_life(df)).withColumn("dataset_code", code)


@register(
    "effect_on_life",
    oracle(
        f"SELECT {r('regr_slope(y, t)', 8)} AS effect, count(*) AS \"rows\" FROM {last('e', LIFE[2])}",
        "clustered",
        ctes={**LIFE_SQL, **residual_ctes("l", *LIFE, "e")},
    ),
)
def effect_on_life(spark, sf_dir):
    return K.effect(_life_rows(spark, sf_dir), *LIFE).select((F.round("effect", 8) + 0.0).alias("effect"), "rows")


@register(
    "effect_on_sampled_life",
    oracle(
        f"SELECT {r('regr_slope(y, t)', 8)} AS effect, count(*) AS \"rows\" FROM {last('e', LIFE[2])}",
        "clustered",
        ctes={
            **LIFE_SQL,
            "s": "SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY dataset_id, condition_cluster "
            "ORDER BY md5(concat_ws('|', event_id, 42))) <= 500",
            **residual_ctes("s", *LIFE, "e"),
        },
    ),
)
def effect_on_sampled_life(spark, sf_dir):
    """The same on 500 rows per data set and condition, which is the sampling rule of the report."""
    rows = capped_sample(_life_rows(spark, sf_dir), "event_id", ["dataset_id", "condition_cluster"], 500)
    return K.effect(rows, *LIFE).select((F.round("effect", 8) + 0.0).alias("effect"), "rows")


UNITS_SQL = f"""SELECT {r("b * w")} AS scaled_coefficient, {r("w")} AS treatment_range,
  {r("b * 10 * 100")} AS effect_per_step_pct,
  {r("CASE WHEN b > 0 THEN least(greatest(0, least(1, (0.15::DOUBLE - base) / (b * w))) * w + lo, 240) ELSE 240 END", 4)}
  AS danger_threshold, {r("base")} AS outcome_mean
FROM (SELECT regr_slope(y, t) AS b FROM {last("e", WEAR[2])}),
  (SELECT max(tool_wear) - min(tool_wear) AS w, min(tool_wear) AS lo, avg(failure) AS base FROM m)"""


@register("danger_threshold", oracle(UNITS_SQL, "machines", ctes={**MACHINE_SQL, **residual_ctes("m", *WEAR, "e")}))
def danger_threshold(spark, sf_dir):
    """Wear effect per 10 minutes and the wear at which the failure rate passes 15 percent."""
    out = K.effect_in_units(machine_rows(spark, sf_dir), *WEAR, step=10)
    return tidy(out.withColumn("danger_threshold", F.round("danger_threshold", 4)))


REFUTED = ("k", "value", ["hour", "label"])
REPS = 3
RING = {
    "ring": "SELECT event_id, k, value, hour, label, row_number() OVER (ORDER BY md5(concat_ws('|', event_id, 42))) AS i, "
    "count(*) OVER () AS n FROM scored",
    **{
        f"p{rep}": f"SELECT b.k AS k, a.value, a.hour, a.label FROM ring a JOIN ring b ON b.i = (a.i - 1 + {rep}) % a.n + 1"
        for rep in range(1, REPS + 1)
    },
}
PLACEBO = {**RING}
for _rep in range(1, REPS + 1):
    PLACEBO.update(residual_ctes(f"p{_rep}", *REFUTED, f"pe{_rep}"))
PLACEBO_SELECT = " UNION ALL ".join(
    f"SELECT {rep} AS rep, regr_slope(y, t) AS effect FROM {last(f'pe{rep}', REFUTED[2])}" for rep in range(1, REPS + 1)
)


@register(
    "placebo",
    oracle(f"SELECT rep::BIGINT AS rep, {r('effect', 8)} AS effect FROM ({PLACEBO_SELECT})", "scored", ctes=PLACEBO),
)
def placebo(spark, sf_dir):
    out = K.placebo_effects(A.scored(spark, sf_dir), "event_id", *REFUTED, reps=REPS)
    return tidy(out, 8)


NOISE = {}
for _rep in range(1, REPS + 1):
    NOISE[f"n{_rep}"] = (
        "SELECT *, ('0x' || substr(md5(concat_ws('|', event_id, " + str(42 + _rep) + ")), 1, 8))::BIGINT / 4294967296.0::DOUBLE "
        "AS noise FROM scored"
    )
    NOISE.update(residual_ctes(f"n{_rep}", REFUTED[0], REFUTED[1], [*REFUTED[2], "noise"], f"ne{_rep}"))
NOISE_SELECT = " UNION ALL ".join(
    f"SELECT {rep} AS rep, regr_slope(y, t) AS effect FROM ne{rep}_{len(REFUTED[2]) + 1}" for rep in range(1, REPS + 1)
)


@register(
    "random_cause",
    oracle(f"SELECT rep::BIGINT AS rep, {r('effect', 8)} AS effect FROM ({NOISE_SELECT})", "scored", ctes=NOISE),
)
def random_cause(spark, sf_dir):
    out = K.random_cause_effects(A.scored(spark, sf_dir), "event_id", *REFUTED, reps=REPS)
    return tidy(out, 8)


@register(
    "refutation_report",
    oracle(
        f"""SELECT {r("o", 8)} AS original_effect, {r("p", 8)} AS placebo_effect, {r("q", 8)} AS random_cause_effect,
  abs(p) < abs(o) * 0.2 AS placebo_passed, abs(q - o) < abs(o) * 0.2 AS random_cause_passed,
  abs(p) < abs(o) * 0.2 AND abs(q - o) < abs(o) * 0.2 AS reliable
FROM (SELECT regr_slope(y, t) AS o FROM {last("oe", REFUTED[2])}), (SELECT avg(effect) AS p FROM ({PLACEBO_SELECT})),
  (SELECT avg(effect) AS q FROM ({NOISE_SELECT}))""",
        "scored",
        ctes={**PLACEBO, **NOISE, **residual_ctes("scored", *REFUTED, "oe")},
    ),
)
def refutation_report(spark, sf_dir):
    return tidy(K.refutation_report(A.scored(spark, sf_dir), "event_id", *REFUTED, reps=REPS), 8)


def fitted_effects(rows):
    """One row: effect per 10 minutes of wear and per 100 watts in percent, danger threshold, failure rate."""
    wear = K.effect_in_units(rows, *WEAR, step=10).select(
        F.col("effect_per_step_pct").alias("wear_effect"), "danger_threshold", (F.col("outcome_mean") * 100).alias("baseline_pct")
    )
    power = K.effect_in_units(rows, *POWER, step=100).select(F.col("effect_per_step_pct").alias("power_effect"))
    return wear.crossJoin(F.broadcast(power))


FITTED = {
    **MACHINE_SQL,
    **residual_ctes("m", *WEAR, "fw"),
    **residual_ctes("m", *POWER, "fp"),
    "fitted": f"""SELECT b * 1000 AS wear_effect, p * 10000 AS power_effect, base * 100 AS baseline_pct,
  CASE WHEN b > 0 THEN least(greatest(0, least(1, (0.15::DOUBLE - base) / (b * w))) * w + lo, 240) ELSE 240 END AS danger_threshold
FROM (SELECT regr_slope(y, t) AS b FROM {last("fw", WEAR[2])}), (SELECT regr_slope(y, t) AS p FROM {last("fp", POWER[2])}),
  (SELECT max(tool_wear) - min(tool_wear) AS w, min(tool_wear) AS lo, avg(failure) AS base FROM m)""",
}


@register(
    "causal_risk",
    oracle(
        f"""SELECT prod_type, tool_wear, rpm, {r("torque")} AS torque, {r("tool_wear / 10 * wear_effect")} AS wear_risk_pct,
  {r("power_w / 100 * power_effect")} AS power_risk_pct,
  {r("tool_wear / 10 * wear_effect + power_w / 100 * power_effect")} AS added_risk_pct FROM m, fitted""",
        "machines",
        ctes=FITTED,
    ),
)
def causal_risk(spark, sf_dir):
    rows = machine_rows(spark, sf_dir)
    wide = attach_row(rows, fitted_effects(rows))
    risk = K.causal_risk(F.col("tool_wear"), F.col("power_w"), F.col("wear_effect"), F.col("power_effect"))
    return tidy(wide.withColumns(risk).select("prod_type", "tool_wear", "rpm", "torque", *risk))


@register(
    "risk_curve",
    oracle(
        f"SELECT wear, {r('baseline_pct + wear / 10 * wear_effect')} AS risk_pct FROM fitted, (SELECT unnest(range(0, 241, 5)) AS wear)",
        "machines",
        ctes=FITTED,
    ),
)
def risk_curve(spark, sf_dir):
    return tidy(K.risk_curve(fitted_effects(machine_rows(spark, sf_dir)), "wear_effect", "baseline_pct"))


# ---- the three effects of the pipeline: refuted together, and what follows from them ------------------------------

LOG_SPECS = [WEAR, POWER]
LOG_SQL = {"log": "SELECT *, proc_temp_c - air_temp_c AS temp_delta FROM clean_log"}
SCALED_SQL = {
    **LIFE_SQL,
    "lz": "SELECT * EXCLUDE (thermal_stress), (thermal_stress - avg(thermal_stress) OVER ()) / (stddev_samp(thermal_stress) OVER () + 1e-6::DOUBLE) "
    "AS thermal_stress FROM l",
}


def refuted_ctes(source: str, key: str, spec: tuple[str, str, list[str]], tag: str) -> dict[str, str]:
    """CTEs up to the one-row `tag`: effect, mean effects of the refutations, and whether they are passed."""
    t, y, zs = spec
    kept = ", ".join(f"a.{c}" for c in (y, *zs))
    ctes = {
        f"{tag}_ring": f"SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', {key}, 42))) AS ring_i, count(*) OVER () AS ring_n FROM {source}"
    }
    placebo, noise = [], []
    for rep in range(1, REPS + 1):
        ctes[f"{tag}_p{rep}"] = (
            f"SELECT b.{t} AS {t}, {kept} FROM {tag}_ring a JOIN {tag}_ring b ON b.ring_i = (a.ring_i - 1 + {rep}) % a.ring_n + 1"
        )
        ctes |= residual_ctes(f"{tag}_p{rep}", t, y, zs, f"{tag}_pe{rep}")
        placebo.append(f"SELECT regr_slope(y, t) AS e FROM {last(f'{tag}_pe{rep}', zs)}")
        ctes[f"{tag}_n{rep}"] = (
            f"SELECT *, ('0x' || substr(md5(concat_ws('|', {key}, {42 + rep})), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS noise FROM {source}"
        )
        ctes |= residual_ctes(f"{tag}_n{rep}", t, y, [*zs, "noise"], f"{tag}_ne{rep}")
        noise.append(f"SELECT regr_slope(y, t) AS e FROM {tag}_ne{rep}_{len(zs) + 1}")
    ctes |= residual_ctes(source, t, y, zs, f"{tag}_oe")
    ctes[tag] = f"""SELECT '{t}' AS treatment, o, p, q, abs(p) < abs(o) * 0.2 AS placebo_passed, abs(q - o) < abs(o) * 0.2 AS random_passed
  FROM (SELECT regr_slope(y, t) AS o FROM {last(f"{tag}_oe", zs)}), (SELECT avg(e) AS p FROM ({" UNION ALL ".join(placebo)})),
    (SELECT avg(e) AS q FROM ({" UNION ALL ".join(noise)}))"""
    return ctes


REFUTED_CTES = {
    **LOG_SQL,
    **refuted_ctes("log", "udi", WEAR, "rw"),
    **refuted_ctes("log", "udi", POWER, "rp"),
    **SCALED_SQL,
    **refuted_ctes("lz", "event_id", LIFE, "rs"),
}


def scaled_life_rows(spark, sf_dir):
    """Engine cycles with remaining life, data-set code and thermal stress in standard deviations."""
    return X.zscore(_life_rows(spark, sf_dir).withColumn("dataset_code", dataset_code()), ["thermal_stress"])


def stress_effect(rows, key="event_id"):
    """One row: cycles of life for each standard deviation of thermal stress, and whether its refutations are passed."""
    found = K.refutations(rows.withColumn("dataset_code", dataset_code()), key, [LIFE], REPS)
    return found.select(F.col("original_effect").alias("effect"), "reliable")


@register(
    "effect_refutations",
    oracle(
        " UNION ALL ".join(
            f"""SELECT treatment, {r("o", 8)} AS original_effect, {r("p", 8)} AS placebo_effect, {r("q", 8)} AS random_cause_effect,
  placebo_passed, random_passed AS random_cause_passed, placebo_passed AND random_passed AS reliable FROM {tag}"""
            for tag in ("rw", "rp", "rs")
        ),
        "clean_log",
        "clustered",
        ctes=REFUTED_CTES,
    ),
)
def effect_refutations(spark, sf_dir):
    """Wear and power on failures, thermal stress on remaining life: each with both refutations."""
    log = X.clean_machines(A.machine_log(spark, sf_dir))
    log = log.withColumns({"power_w": power_w(), "temp_delta": F.col("proc_temp_c") - F.col("air_temp_c")})
    machines = K.refutations(log, "UDI", LOG_SPECS, REPS)
    return tidy(machines.unionByName(K.refutations(scaled_life_rows(spark, sf_dir), "event_id", [LIFE], REPS)).drop("outcome"), 8)


CUT = "CASE WHEN rul < 20 THEN 0.4 WHEN rul < 50 THEN 0.3 WHEN rul < 80 THEN 0.2 ELSE 0.0 END::DOUBLE"


@register(
    "intervention_by_effect",
    oracle(
        f"""SELECT event_id, rul, status, {r(CUT)} AS max_reduction, {r("effect", 8)} AS effect, reliable,
  {r("CASE WHEN status = 'SUCCESS' THEN best END")} AS best_stress,
  {r("CASE WHEN status = 'SUCCESS' THEN (thermal_stress - best) / abs(thermal_stress) * 100 END")} AS stress_reduction_pct,
  {r("CASE status WHEN 'SUCCESS' THEN abs(effect) * (thermal_stress - best) WHEN 'NO_INTERVENTION_NEEDED' THEN 0 END")} AS causal_gain
FROM (SELECT lz.*, rs.o AS effect, placebo_passed AND random_passed AS reliable, thermal_stress * (1 - {CUT}) AS best,
    CASE WHEN NOT (placebo_passed AND random_passed) THEN 'CAUSAL_UNRELIABLE'
      WHEN ({CUT}) = 0 OR thermal_stress <= 0.1 THEN 'NO_INTERVENTION_NEEDED' ELSE 'SUCCESS' END AS status FROM lz, rs)""",
        "clustered",
        ctes={**SCALED_SQL, **refuted_ctes("lz", "event_id", LIFE, "rs")},
    ),
)
def intervention_by_effect(spark, sf_dir):
    """Interventions on scaled stress with the effect estimated from the same engines, if its refutations are passed."""
    rows = scaled_life_rows(spark, sf_dir)
    wide = attach_row(rows, stress_effect(rows))
    out = R.interventions(wide, "thermal_stress", "rul", F.col("effect"), F.col("reliable"))
    shown = out.select(
        "event_id", "rul", "status", "max_reduction", (F.round("effect", 8) + 0.0).alias("effect"), "reliable", "best_stress",
        "stress_reduction_pct", "causal_gain",
    )
    return tidy(shown, keep=("effect",))

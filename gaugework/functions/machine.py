"""Column expressions for machine cycles: conversions, limits, rule flags and bands."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the machine data set: type codes, overstrain limits per type, power window in watts, wear at
# which tool failures start, smallest safe temperature difference, physical wear limit in minutes.
TYPE_CODES = {"L": 0, "M": 1, "H": 2}
TYPE_LABELS = {0: "L", 1: "M", 2: "H"}
OVERSTRAIN_LIMITS = {0: 11000, 1: 12000}
OVERSTRAIN_LIMIT_OTHER = 13000
POWER_MIN_W = 3500
POWER_MAX_W = 9000
WEAR_ONSET_MIN = 200
HEAT_DELTA_MIN = 8.6
WEAR_LIMIT_MIN = 240
MODE_COLUMNS = ["TWF", "HDF", "PWF", "OSF", "RNF"]
# Fixed ranges for scoring single readings without a fitted table.
LIVE_RANGES = {
    "rpm": (1168.0, 2886.0),
    "torque": (3.8, 76.6),
    "tool_wear": (0.0, 253.0),
    "air_temp_c": (22.99, 29.99),
    "proc_temp_c": (32.86, 39.44),
    "power_w": (0.0, 9400.0),
    "temp_delta": (7.5, 12.9),
    "stress_index": (0.0, 1.0),
    "overstrain_margin": (-3650.0, 13000.0),
}
LIVE_TORQUE_MAX = 75.0
LIVE_RPM_MAX = 2800.0


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def celsius(kelvin: str | Column) -> Column:
    return _c(kelvin) - F.lit(273.15)


def power_w(torque: str | Column = "torque", rpm: str | Column = "rpm") -> Column:
    return _c(torque) * (_c(rpm) * F.lit(2.0) * F.lit(math.pi) / F.lit(60.0))


def encode(col: str | Column, codes: dict[str, int], default: int | None = None) -> Column:
    """Ordinal code of a label; unknown labels give `default`."""
    out = F.lit(default)
    for label, code in codes.items():
        out = F.when(_c(col) == label, F.lit(code)).otherwise(out)
    return out.cast("long")


def overstrain_limit(prod_type: str | Column = "prod_type") -> Column:
    out = F.lit(OVERSTRAIN_LIMIT_OTHER)
    for code, limit in OVERSTRAIN_LIMITS.items():
        out = F.when(_c(prod_type) == code, limit).otherwise(out)
    return out


def overstrain_margin(prod_type="prod_type", wear="tool_wear", torque="torque") -> Column:
    return overstrain_limit(prod_type) - _c(wear) * _c(torque)


def overstrain_margin_pct(prod_type="prod_type", wear="tool_wear", torque="torque", floor: bool = False) -> Column:
    pct = (F.lit(1.0) - _c(wear) * _c(torque) / overstrain_limit(prod_type)) * F.lit(100.0)
    return F.greatest(F.lit(0.0), pct) if floor else pct


def rule_flags() -> dict[str, Column]:
    """Failure-mode rules on `temp_delta`, `power_w`, `tool_wear`, `torque`, `prod_type`."""
    margin = overstrain_margin()
    return {
        "heat_risk": F.col("temp_delta") < HEAT_DELTA_MIN,
        "power_risk": (F.col("power_w") < POWER_MIN_W) | (F.col("power_w") > POWER_MAX_W),
        "wear_risk": F.col("tool_wear") >= WEAR_ONSET_MIN,
        "overstrain_risk": margin < 0,
        "overstrain_caution": overstrain_margin_pct(floor=True) < 20,
    }


def band(value: str | Column, edges: list[tuple[object, object]], last: object, at_least: bool = False) -> Column:
    """Label of the first edge that the value is below (or at least at), else `last`; null for a missing value."""
    out = F.lit(last)
    for edge, label in reversed(edges):
        hit = _c(value) >= edge if at_least else _c(value) < edge
        out = F.when(hit, F.lit(label)).otherwise(out)
    return F.when(_c(value).isNotNull(), out)


def life_urgency(rul: str | Column) -> Column:
    return band(rul, [(20, "CRITICAL"), (50, "WARNING"), (80, "CAUTION")], "NORMAL")


def max_reduction(rul: str | Column) -> Column:
    """Largest share of thermal stress that may be taken away at this remaining life."""
    return band(rul, [(20, 0.4), (50, 0.3), (80, 0.2)], 0.0)


def scenario_key(rul: str | Column) -> Column:
    return band(rul, [(20, "critical"), (50, "degrading")], "healthy")


def wear_urgency(wear: str | Column, danger: str | Column) -> Column:
    edges = [(_c(danger), "CRITICAL"), (WEAR_ONSET_MIN, "WARNING"), (150, "CAUTION")]
    return band(wear, edges, "NORMAL", at_least=True)


def target_power(wear: str | Column) -> Column:
    return band(wear, [(50, 8000.0), (150, 7500.0), (200, 7000.0), (220, 6000.0)], 5000.0)


def failure_band(prob: str | Column) -> Column:
    return F.when(_c(prob) > 0.5, "critical").when(_c(prob) > 0.2, "warning").when(_c(prob).isNotNull(), "ok")


def minutes_to_danger(wear: str | Column, danger: str | Column) -> Column:
    return F.greatest(F.lit(0.0), _c(danger) - _c(wear))


def danger_band(minutes: str | Column) -> Column:
    return band(minutes, [(30, "critical"), (60, "warning")], "ok")


def life_share(rul: str | Column, cap: float = 125.0) -> Column:
    return F.least(_c(rul) / F.lit(cap), F.lit(1.0))


def life_bar_pct(rul: str | Column, full: float = 200.0) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), _c(rul) / F.lit(full) * F.lit(100.0)))

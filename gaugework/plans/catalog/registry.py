"""Registered queries: a Spark plan and, where SQL can say the same, the SQL to check it against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    plan: Plan
    sql: str | None


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    def add(plan: Plan) -> Plan:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = Query(plan, sql)
        return plan

    return add


def tidy(df: DataFrame, digits: int = 6, keep: tuple[str, ...] = ()) -> DataFrame:
    """Doubles rounded (and freed of the sign of zero), integers as bigint: the form in which results are compared."""
    cols = []
    for name, dtype in df.dtypes:
        col = F.col(f"`{name}`")
        if name in keep:
            pass
        elif dtype in ("double", "float"):
            col = F.round(col, digits) + F.lit(0.0)
        elif dtype in ("int", "smallint", "tinyint"):
            col = col.cast("bigint")
        cols.append(col.alias(name))
    return df.select(*cols)


# ---- SQL side -------------------------------------------------------------------------------------------------

VIEWS = {
    "cycles": """
  SELECT event_id, 'FD00' || (user_id % 4 + 1) AS dataset_id, user_id // 4 AS unit,
         (event_id % 6) * 7.0::DOUBLE + (event_id % 3) * 0.001::DOUBLE AS op_set1,
         value AS s2, value * 1.5::DOUBLE + k AS s3, k AS s4, k % 7 + 1 AS s8, value + k * 2 AS s9,
         value / (k + 1.37::DOUBLE) AS s11, k / 100 + 0.5::DOUBLE AS s15, label,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS cycle
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS k,
               CAST(event_type = 'error' AS BIGINT) AS label FROM events)""",
    "machines": """
  SELECT CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END::BIGINT AS prod_type,
         3.8::DOUBLE + l_quantity AS torque,
         1168 + CAST(floor(l_extendedprice) AS BIGINT) % 1700 AS rpm,
         l_partkey % 254 AS tool_wear,
         23.0::DOUBLE + l_discount * 50 AS air_temp_c,
         31.5::DOUBLE + l_discount * 50 + l_tax * 40 AS proc_temp_c,
         CAST(l_linestatus = 'F' AND l_partkey % 254 > 100 AS BIGINT) AS failure
  FROM lineitem""",
    "machine_log": """
  SELECT o_orderkey AS udi,
         CASE o_orderkey % 3 WHEN 0 THEN 'L' WHEN 1 THEN 'M' ELSE 'H' END AS type_code,
         295.5::DOUBLE + (cents % 70) / 10.0::DOUBLE AS air_temp_k,
         305.75::DOUBLE + (cents % 65) / 10.0::DOUBLE AS proc_temp_k,
         1168 + cents % 1700 AS rpm, 4.25::DOUBLE + (o_custkey % 70) AS torque, o_orderkey % 254 AS tool_wear,
         fail::BIGINT AS failure, (fail AND o_orderkey % 254 > 200)::BIGINT AS TWF,
         (fail AND o_orderkey % 5 = 1)::BIGINT AS HDF, (fail AND o_orderkey % 5 = 2)::BIGINT AS PWF,
         (fail AND o_orderkey % 5 = 3)::BIGINT AS OSF, (fail AND o_orderkey % 50 = 7)::BIGINT AS RNF
  FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS cents, o_orderstatus = 'P' AS fail FROM orders)""",
    "clean_log": """
  SELECT udi, CASE type_code WHEN 'L' THEN 0 WHEN 'M' THEN 1 ELSE 2 END::BIGINT AS prod_type,
         air_temp_k - 273.15::DOUBLE AS air_temp_c, proc_temp_k - 273.15::DOUBLE AS proc_temp_c, rpm, torque, tool_wear,
         torque * (rpm * 2.0::DOUBLE * pi() / 60.0::DOUBLE) AS power_w, failure, TWF, HDF, PWF, OSF, RNF
  FROM machine_log""",
    "scored": """
  SELECT event_id, user_id, event_type, value, value / (value + 1.0::DOUBLE) AS score,
         CAST(event_type = 'error' AS BIGINT) AS label, CAST(value > 60 AS BIGINT) AS flag,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS k, CAST(hour(ts) AS DOUBLE) AS hour
  FROM events""",
    "lifetimes": """
  SELECT dataset_id, unit, CASE WHEN unit % 2 = 0 THEN 'managed' ELSE 'unmanaged' END AS fleet,
         CASE WHEN unit % 2 = 0 THEN last + last // 10 ELSE last END AS lifetime, unit % 7 = 0 AS censored
  FROM (SELECT dataset_id, unit, max(cycle) AS last FROM cycles GROUP BY ALL)""",
    "clustered": """
  SELECT *, CASE WHEN dataset_id IN ('FD002', 'FD004')
                 THEN dense_rank() OVER (PARTITION BY dataset_id ORDER BY round(op_set1, 2)) - 1
                 ELSE 0 END::BIGINT AS condition_cluster
  FROM cycles""",
}
NEEDS = {"lifetimes": ["cycles"], "clean_log": ["machine_log"], "clustered": ["cycles"]}


def _closure(views: tuple[str, ...]) -> list[str]:
    out: list[str] = []
    for v in views:
        for need in [*_closure(tuple(NEEDS.get(v, []))), v]:
            if need not in out:
                out.append(need)
    return out


def oracle(select: str, *views: str, ctes: dict[str, str] | None = None) -> str:
    """SQL text: the named views, further CTEs in order, then the select."""
    parts = [f"{v} AS ({VIEWS[v]})" for v in _closure(views)]
    parts += [f"{name} AS ({body})" for name, body in (ctes or {}).items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + select


def r(expr: str, digits: int = 6) -> str:
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + CAST(0 AS DOUBLE))"

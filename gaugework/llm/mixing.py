"""Mixing sources to target weights: a budget runs down a tree of groups, and each leaf gives a token prefix of seeded epochs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugework.llm.common import WORD, stored


def words(text: str) -> Column:
    """Tokens of a text where no other count is given: its words."""
    return F.regexp_count(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(WORD)).cast("bigint")


def _order(seed: int, epoch: Column, key: str) -> Column:
    """Place of a document in an epoch: 60 bits of a digest of seed, epoch and key, the same in any SQL engine."""
    digest = F.md5(F.concat_ws(":", F.lit(seed).cast("string"), epoch.cast("string"), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def fill_level(nodes: DataFrame, parent: list[str], child: str) -> DataFrame:
    """Adds `budget`: each parent's `parent_budget` dealt to its children by `weight`, none above its `capacity`.

    Children in ascending order of capacity for each unit of weight are the first to be full. A child is full if its
    capacity is at most its share of what those before it leave; what full children can't use goes to the others of the
    same parent in proportion to their weights. Whole tokens: shares are rounded down and the rest goes, one each, to the
    first children (by name) that have room.
    """
    ratio = F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight")).otherwise(F.lit(float("inf")))
    by = Window.partitionBy(*parent)
    ahead = by.orderBy("__ratio", F.col(child).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    after = by.orderBy("__ratio", F.col(child).asc_nulls_first()).rowsBetween(0, Window.unboundedFollowing)
    zero = F.lit(0)
    dealt = (
        nodes.withColumn("__ratio", ratio)
        .withColumn("__used", F.coalesce(F.sum("capacity").over(ahead), zero))
        .withColumn("__weight", F.sum("weight").over(after))
        .withColumn("__left", F.greatest(F.col("parent_budget") - F.col("__used"), zero))
        # capacity/weight against left/weights: full if the child's own share is no less than its capacity
        .withColumn("__full", (F.col("weight") > 0) & (F.col("capacity") * F.col("__weight") <= F.col("__left") * F.col("weight")))
        .withColumn("__gone", F.coalesce(F.sum(F.when(F.col("__full"), F.col("capacity"))).over(by), zero))
        .withColumn("__open", F.sum(F.when(~F.col("__full"), F.col("weight")).otherwise(0.0)).over(by))
        .withColumn("__share", F.when(F.col("__open") > 0, F.floor((F.col("parent_budget") - F.col("__gone")) * F.col("weight") / F.col("__open"))).otherwise(zero))
        .withColumn("budget", F.when(F.col("__full"), F.col("capacity")).otherwise(F.least(F.greatest(F.col("__share"), zero), F.col("capacity"))))
    )
    room = (F.col("budget") < F.col("capacity")) & (F.col("weight") > 0)
    turn = by.orderBy(F.col(child).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    dealt = dealt.withColumn("__rest", F.col("parent_budget") - F.sum("budget").over(by)).withColumn("__turn", F.sum(room.cast("int")).over(turn))
    extra = F.when(room & (F.col("__turn") <= F.col("__rest")), F.lit(1)).otherwise(zero)
    return dealt.withColumn("budget", (F.col("budget") + extra).cast("bigint")).select(*nodes.columns, "budget")


def budgets(leaves: DataFrame, levels: list[str], total: int, weights: dict[str, DataFrame] | None = None, epochs: float = 1.0) -> DataFrame:
    """Budget in tokens of each leaf of the tree whose paths are the columns `levels`.

    leaves: `levels` and `supply` (tokens), one row each. A leaf can give `epochs` times its supply, and a node what its
    leaves can. weights: for a level, a table of that level's path (or its own column alone) and `weight`; nodes without
    one, and levels without a table, weigh 1 each; a leaf under a weight of 0 gives nothing. From the root down, shortages are made up by siblings first; only
    when all siblings are full does a node's budget stay below what its parent was to get, and that was already settled
    one level up, since no node is given more than its leaves hold.
    """
    weights = weights or {}
    nodes = leaves
    wanted = F.lit(True)
    for depth, level in enumerate(levels):
        name = f"__weight{depth}"
        if level in weights:
            own = [c for c in weights[level].columns if c in levels]
            table = weights[level].select(*(F.col(c).alias(f"__w_{c}") for c in own), F.col("weight").cast("double").alias(name))
            match = [F.col(c).eqNullSafe(F.col(f"__w_{c}")) for c in own]
            nodes = nodes.join(table, match, "left").drop(*(f"__w_{c}" for c in own)).withColumn(name, F.coalesce(name, F.lit(1.0)))
        else:
            nodes = nodes.withColumn(name, F.lit(1.0))
        wanted = wanted & (F.col(name) > 0)
    nodes = nodes.withColumn("capacity", F.when(wanted, F.floor(F.col("supply") * F.lit(float(epochs)))).otherwise(0).cast("bigint"))
    given = nodes.agg(F.least(F.lit(total), F.coalesce(F.sum("capacity"), F.lit(0))).cast("bigint").alias("parent_budget"))
    for depth, level in enumerate(levels):
        up = levels[:depth]
        here = nodes.groupBy(*levels[: depth + 1]).agg(F.sum("capacity").cast("bigint").alias("capacity"), F.max(f"__weight{depth}").alias("weight"))
        if up:
            above = given.select(*(F.col(c).alias(f"__up_{c}") for c in up), F.col("budget").alias("parent_budget"))
            here = here.join(above, [F.col(c).eqNullSafe(F.col(f"__up_{c}")) for c in up]).drop(*(f"__up_{c}" for c in up))
        else:
            here = here.crossJoin(given)  # one row
        given = fill_level(here, up, level)
    return given.select(*levels, "capacity", "weight", "budget")


def mix(
    docs: DataFrame,
    levels: list[str],
    total: int | float,
    weights: dict[str, DataFrame] | None = None,
    epochs: float = 1.0,
    seed: int = 17,
    id: str = "doc_id",
    text: str = "text",
    tokens: Column | None = None,
) -> DataFrame:
    """The chosen documents with `tokens` and `epochs`: how many times each is taken to meet the target weights.

    total: tokens wanted, or as a float the share of all tokens. levels: columns from the root's children to the leaf,
    such as domain, language, source. Every leaf goes through its documents in a seeded order, in a new order each epoch:
    whole epochs first, then the longest prefix of the next epoch that stays within the leaf's budget. Documents with
    the same place in the order (rows with equal ids) are taken together or not at all.

    Only the ids and counts are ordered, and only in the one hash bucket of each leaf in which its prefix ends: bucket
    totals tell the rest. A leaf of n rows has about sqrt(n) buckets of sqrt(n) rows, so one with a third of all rows is
    never ordered as a whole. Null level values are a group of
    their own, null ids have one common place; null and empty texts have no tokens and go with their place in the order.
    An empty table, or nothing to deal out, gives no rows. Extra columns pass through; `tokens` and `epochs` are replaced.
    """
    keep = [c for c in docs.columns if c not in ("tokens", "epochs")]
    names = [f"__level{i}" for i in range(len(levels))]
    base = docs.withColumn("__count", words(text) if tokens is None else tokens)
    base = base.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("__row"), *(F.col(f"`{c}`").alias(n) for c, n in zip(levels, names, strict=True)), F.col(f"`{id}`").alias("__id"), F.coalesce("__count", F.lit(0)).cast("bigint").alias("__count"))
    slim = stored(base.select(*names, "__id", "__count"), "counts")
    leaves = slim.groupBy(*names).agg(F.sum("__count").alias("supply"), F.count("*").alias("__rows"))
    leaves = stored(leaves, "leaves")
    wanted = total if isinstance(total, int) else int(total * (leaves.agg(F.sum("supply")).first()[0] or 0))
    renamed = {n: weights[c].withColumnsRenamed(dict(zip(levels, names, strict=True))) for c, n in zip(levels, names, strict=True) if weights and c in weights}
    given = budgets(leaves.select(*names, "supply"), names, wanted, renamed, epochs)
    given = given.select(*(F.col(n).alias(f"__g{n}") for n in names), "budget")
    plan = leaves.join(given, [F.col(n).eqNullSafe(F.col(f"__g{n}")) for n in names])
    plan = stored(
        plan.withColumn("__whole", F.when(F.col("supply") > 0, F.floor(F.col("budget") / F.col("supply"))).otherwise(0).cast("bigint"))
        .withColumn("__rest", F.col("budget") - F.col("__whole") * F.col("supply"))
        .withColumn("__buckets", F.ceil(F.sqrt("__rows")).cast("bigint"))
        .select(*names, "__whole", "__rest", "__buckets"),
        "plan",
    )
    lettered = [F.col(n).alias(f"__p{n}") for n in names]
    side = plan.select(*lettered, "__whole", "__rest", "__buckets")
    on = [F.col(n).eqNullSafe(F.col(f"__p{n}")) for n in names]
    place = _order(seed, F.col("__whole"), "__id")
    bucket = F.floor(F.col("__place") / (F.lit(1 << 60) / F.col("__buckets"))).cast("bigint")
    placed = slim.join(side, on).withColumn("__place", place).withColumn("__bucket", bucket)
    sums = placed.groupBy(*names, "__bucket").agg(F.sum("__count").alias("__sum"), F.max("__rest").alias("__rest"))
    before = Window.partitionBy(*names).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("__before", F.coalesce(F.sum("__sum").over(before), F.lit(0)))
    # the bucket in which the leaf's prefix ends, and what is left of the budget at its start
    ends = sums.filter((F.col("__before") <= F.col("__rest")) & (F.col("__before") + F.col("__sum") > F.col("__rest")))
    ends = ends.select(*(F.col(n).alias(f"__e{n}") for n in names), F.col("__bucket").alias("__at"), (F.col("__rest") - F.col("__before")).alias("__room"))
    inside = placed.join(ends, [F.col(n).eqNullSafe(F.col(f"__e{n}")) for n in names] + [F.col("__bucket") == F.col("__at")])
    ties = inside.groupBy(*names, "__place").agg(F.sum("__count").alias("__sum"), F.max("__room").alias("__room"))
    through = Window.partitionBy(*names).orderBy("__place").rowsBetween(Window.unboundedPreceding, 0)
    ties = ties.withColumn("__through", F.sum("__sum").over(through))
    first_out = ties.filter(F.col("__through") > F.col("__room")).groupBy(*names).agg(F.min("__place").alias("__cut"))
    cuts = first_out.select(*(F.col(n).alias(f"__c{n}") for n in names), "__cut")
    cuts = side.join(cuts, [F.col(f"__p{n}").eqNullSafe(F.col(f"__c{n}")) for n in names], "left").drop(*(f"__c{n}" for n in names))
    cuts = stored(cuts.withColumn("__cut", F.when(F.col("__rest") == 0, F.lit(0)).otherwise(F.coalesce("__cut", F.lit(1 << 60)))), "cuts")
    chosen = base.join(cuts, on).withColumn("__place", place)
    times = F.col("__whole") + (F.col("__place") < F.col("__cut")).cast("bigint")
    return chosen.select("__row.*", F.col("__count").alias("tokens"), times.alias("epochs")).filter("epochs > 0")


def mix_sql(base: str, levels: list[str], weights: dict[str, dict[str, float]], share: float, epochs: float, seed: int) -> str:
    """The same choice in plain SQL. base: a query with doc_id, tokens and the levels; weights: by level and name."""

    def level_ctes(depth: int) -> str:
        path, level = levels[: depth + 1], levels[depth]
        up = path[:-1]
        cases = " ".join(f"WHEN '{k}' THEN {w!r}" for k, w in weights.get(level, {}).items())
        weight = f"CASE {level} {cases} ELSE 1.0 END::DOUBLE" if cases else "1.0::DOUBLE"
        part = f"PARTITION BY {', '.join(up)} " if up else ""
        source = f"n JOIN g{depth - 1} p USING ({', '.join(up)})" if up else "n CROSS JOIN (SELECT * FROM root)"
        parent = "p.budget" if up else "parent_budget"
        n = ", ".join(path)
        return f"""
n{depth} AS (SELECT {n}, sum(capacity)::BIGINT AS capacity, any_value({weight}) AS weight FROM leaves GROUP BY {n}),
a{depth} AS (SELECT n.*, {parent} AS pb FROM (SELECT * FROM n{depth}) {source}),
b{depth} AS (SELECT *, coalesce(sum(capacity) OVER ({part}ORDER BY capacity / weight, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
  sum(weight) OVER ({part}ORDER BY capacity / weight, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w FROM a{depth}),
c{depth} AS (SELECT *, capacity * w <= greatest(pb - used, 0) * weight AS ful FROM b{depth}),
d{depth} AS (SELECT *, coalesce(sum(capacity) FILTER (ful) OVER ({part}), 0) AS gone, sum(CASE WHEN ful THEN 0 ELSE weight END) OVER ({part}) AS opened FROM c{depth}),
e{depth} AS (SELECT *, CASE WHEN ful THEN capacity ELSE least(greatest(floor((pb - gone) * weight / opened), 0), capacity) END::BIGINT AS b0 FROM d{depth}),
f{depth} AS (SELECT *, pb - sum(b0) OVER ({part}) AS rest, sum((b0 < capacity)::INT) OVER ({part}ORDER BY {level} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS turn FROM e{depth}),
g{depth} AS (SELECT {n}, capacity, (b0 + CASE WHEN b0 < capacity AND turn <= rest THEN 1 ELSE 0 END)::BIGINT AS budget FROM f{depth})"""

    path = ", ".join(levels)
    steps = ",".join(level_ctes(d) for d in range(len(levels)))
    return f"""
WITH base AS ({base}),
leaves AS (SELECT {path}, sum(tokens)::BIGINT AS supply, floor(sum(tokens) * {epochs!r}::DOUBLE)::BIGINT AS capacity FROM base GROUP BY {path}),
root AS (SELECT least(floor({share!r}::DOUBLE * sum(supply))::BIGINT, sum(capacity)::BIGINT) AS parent_budget FROM leaves),
{steps},
plan AS (SELECT {path}, CASE WHEN supply > 0 THEN budget // supply ELSE 0 END AS whole, budget - CASE WHEN supply > 0 THEN budget // supply ELSE 0 END * supply AS rest
  FROM leaves JOIN g{len(levels) - 1} USING ({path})),
placed AS (SELECT *, ('0x' || substr(md5('{seed}:' || whole || ':' || doc_id), 1, 15))::BIGINT AS place FROM base JOIN plan USING ({path})),
summed AS (SELECT *, sum(tokens) OVER (PARTITION BY {path} ORDER BY place RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS through FROM placed)
SELECT doc_id, {path}, tokens::BIGINT AS tokens, (whole + (rest > 0 AND through <= rest)::INT)::BIGINT AS epochs
FROM summed WHERE whole + (rest > 0 AND through <= rest)::INT > 0"""

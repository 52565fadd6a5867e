"""Covariate-adjusted linear effects and their refutations.

An effect is the least-squares coefficient of the treatment next to its confounders. One aggregation gives the
covariances of all pairs of columns; sweeping the confounders out of that small matrix leaves the coefficient. The
rows are read once and nothing but one row per group is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugework.functions.hashing import hash_key, hash_uniform
from gaugework.operators.ordered import ROWS_PER_SLICE, hash_index, over_groups
from gaugework.operators.sizing import attach_row
from gaugework.operators.columns import clip




def _cov(a: str, b: str) -> str:
    return f"__cov_{min(a, b)}__{max(a, b)}"


def _pairs(cols: list[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(cols) for b in cols[i:]]


def _cov_exprs(cols: list[str]) -> list[Column]:
    return [F.covar_pop(a, b).alias(_cov(a, b)) for a, b in _pairs(cols)]


def _sweep(row: DataFrame, cols: list[str], confounders: list[str], treatment: str, outcome: str, name: str):
    """Coefficient of the treatment from the covariance columns of a one-row (or one-row-per-group) table."""
    rest = list(cols)
    originals = {c: f"__var_{c}" for c in cols}
    row = row.withColumns({originals[c]: F.col(_cov(c, c)) for c in cols})
    for z in confounders:
        rest.remove(z)
        pivot = F.col(_cov(z, z))
        # a confounder that is constant or a sum of earlier ones has nothing left to take out
        useful = pivot > F.col(originals[z]) * 1e-10
        row = row.withColumns(
            {
                _cov(a, b): F.when(
                    useful, F.col(_cov(a, b)) - F.col(_cov(a, z)) * F.try_divide(F.col(_cov(b, z)), pivot)
                ).otherwise(F.col(_cov(a, b)))
                for a, b in _pairs(rest)
            }
        )
    left = F.col(_cov(treatment, treatment))
    effect = F.when(left > F.col(originals[treatment]) * 1e-10, F.col(_cov(treatment, outcome)) / left)
    return row.withColumn(name, effect)


def effect(
    df: DataFrame, treatment: str, outcome: str, confounders: list[str], by: list[str] | None = None,
    name: str = "effect",
) -> DataFrame:
    """Effect of the treatment, rows used and mean outcome; one row, or one per `by` group."""
    by = by or []
    cols = [treatment, outcome, *confounders]
    rows = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]).dropna(subset=cols)
    sums = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(outcome).alias("outcome_mean"), *_cov_exprs(cols)
    )
    return _sweep(sums, cols, confounders, treatment, outcome, name).select(*by, name, "rows", "outcome_mean")


def danger_threshold(effect: Column, baseline: Column, low: Column, high: Column, level=0.15, cap=240.0) -> Column:
    """Treatment value at which the outcome passes `level`; `effect` is per full range, no effect gives the cap."""
    share = clip(F.try_divide(F.lit(level) - baseline, effect), 0.0, 1.0)
    return F.when(effect > 0, F.least(share * (high - low) + low, F.lit(cap))).otherwise(F.lit(cap))


def effect_in_units(
    df: DataFrame, treatment: str, outcome: str, confounders: list[str], step: float, level=0.15, cap=240.0
) -> DataFrame:
    """Effect over the treatment's range, per `step` units in percent, and the danger threshold.

    The raw columns are used: the coefficient times the range is the coefficient of the min-max scaled treatment.
    """
    ends = df.agg(F.min(treatment).cast("double").alias("low"), F.max(treatment).cast("double").alias("high"))
    out = effect(df, treatment, outcome, confounders, name="per_unit").crossJoin(F.broadcast(ends))
    span = F.col("high") - F.col("low")
    return out.select(
        (F.col("per_unit") * span).alias("scaled_coefficient"),
        span.alias("treatment_range"),
        (F.col("per_unit") * step * 100).alias("effect_per_step_pct"),
        danger_threshold(F.col("per_unit") * span, F.col("outcome_mean"), F.col("low"), F.col("high"), level, cap)
        .alias("danger_threshold"),
        "outcome_mean",
    )


def placebo_effects(
    df: DataFrame, key: str, treatment: str, outcome: str, confounders: list[str], reps: int = 1, seed: int = 42,
    limit: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Effect of permuted treatments. Rows are put in md5 order and the treatment is taken from the row `rep`
    places further on, the last rows from the first: one random order serves every repetition."""
    cols = [treatment, outcome, *confounders]
    rows = df.select(key, *[F.col(c).cast("double").alias(c) for c in cols]).dropna(subset=cols)
    placed = hash_index(rows, key, seed, None, "__i")
    total = rows.agg(F.count(F.lit(1)).alias("__total"))
    # rows past the end repeat the first ones, so that every row has `reps` followers
    head = rows.withColumn("__h", hash_key(key, seed)).orderBy("__h").limit(reps)
    past = F.row_number().over(W.orderBy("__h")) + F.col("__total")
    again = attach_row(head, total).withColumn("__i", past.cast("long")).drop("__h", "__total")
    ring = placed.withColumn("__real", F.lit(True)).unionByName(again.withColumn("__real", F.lit(False)))

    def build(frame):
        return {f"placebo_{r}": F.lead(treatment, r).over(frame.window) for r in range(1, reps + 1)}

    shifted = over_groups(ring, [], ["__i"], build, after=reps, limit=limit, position="__i", trusted=True).filter("__real")
    fakes = [f"placebo_{r}" for r in range(1, reps + 1)]
    return _repeated_effects(shifted, fakes, outcome, confounders)


def _repeated_effects(df: DataFrame, fakes: list[str], outcome: str, confounders: list[str]) -> DataFrame:
    shared = [outcome, *confounders]
    exprs = [*_cov_exprs(shared)]
    for fake in fakes:
        exprs += [F.covar_pop(fake, c).alias(_cov(fake, c)) for c in [fake, *shared]]
    stacked = _one_row_per_rep(df.agg(*exprs), fakes, "t", shared)
    return _sweep(stacked, ["t", *shared], confounders, "t", outcome, "effect").select("rep", "effect")


def _one_row_per_rep(sums: DataFrame, names: list[str], alias: str, shared: list[str]) -> DataFrame:
    """Covariances of each repetition's own column, renamed to `alias`, next to those all repetitions share."""
    reps = [
        F.struct(
            F.lit(i).alias("rep"),
            F.col(_cov(name, name)).alias(_cov(alias, alias)),
            *[F.col(_cov(name, c)).alias(_cov(alias, c)) for c in shared],
        )
        for i, name in enumerate(names, 1)
    ]
    return sums.select(*[F.col(_cov(a, b)) for a, b in _pairs(shared)], F.inline(F.array(*reps)))


def random_cause_effects(
    df: DataFrame, key: str, treatment: str, outcome: str, confounders: list[str], reps: int = 1, seed: int = 42
) -> DataFrame:
    """Effect with one more confounder that is pure noise; all repetitions in one pass over the rows."""
    cols = [treatment, outcome, *confounders]
    rows = df.select(key, *[F.col(c).cast("double").alias(c) for c in cols]).dropna(subset=cols)
    noise = [f"noise_{r}" for r in range(1, reps + 1)]
    noisy = rows.withColumns({c: hash_uniform(hash_key(key, seed + r)) for r, c in enumerate(noise, 1)})
    exprs = [*_cov_exprs(cols)]
    for n in noise:
        exprs += [F.covar_pop(n, c).alias(_cov(n, c)) for c in [n, *cols]]
    stacked = _one_row_per_rep(noisy.agg(*exprs), noise, "noise", cols)
    swept = _sweep(stacked, [*cols, "noise"], [*confounders, "noise"], treatment, outcome, "effect")
    return swept.select("rep", "effect")


def refutation_report(
    df: DataFrame, key: str, treatment: str, outcome: str, confounders: list[str], reps: int = 1, seed: int = 42,
    tolerance: float = 0.2,
) -> DataFrame:
    """One row: the effect, both refutations (mean over repetitions) and whether the effect is reliable."""
    original = effect(df, treatment, outcome, confounders).select(F.col("effect").alias("original_effect"))
    placebo = placebo_effects(df, key, treatment, outcome, confounders, reps, seed)
    noise = random_cause_effects(df, key, treatment, outcome, confounders, reps, seed)
    row = original.crossJoin(F.broadcast(placebo.agg(F.avg("effect").alias("placebo_effect")))).crossJoin(
        F.broadcast(noise.agg(F.avg("effect").alias("random_cause_effect")))
    )
    return _judged(row, tolerance)


Spec = tuple[str, str, list[str]]


def _used(specs: list[Spec]) -> list[str]:
    return list(dict.fromkeys(c for t, y, zs in specs for c in (t, y, *zs)))


def effects(df: DataFrame, specs: list[Spec], extra: list[str] | None = None) -> DataFrame:
    """Effects of several (treatment, outcome, confounders) in one pass: treatment, outcome, rep, effect.

    Each spec's rows are those without a null in its columns. With `extra`, columns of noise, there is one row for each of
    them (rep 1, 2, ...) with that column as one more confounder; without, rep is 0.
    """
    reps = extra or [None]
    df = df.select(*(F.col(c).cast("double").alias(c) for c in _used(specs)), *(extra or []))
    sums: dict[str, Column] = {}
    for i, (t, y, zs) in enumerate(specs):
        cols = [t, y, *zs]
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
        own = {c: F.when(whole, F.col(c)) for c in [*cols, *(extra or [])]}
        for a, b in _pairs(cols):
            sums[f"s{i}{_cov(a, b)}"] = F.covar_pop(own[a], own[b])
        for e in extra or []:
            for c in [e, *cols]:
                sums[f"s{i}{_cov(e, c)}"] = F.covar_pop(own[e], own[c])
    # the one row of sums becomes one row for each spec and repetition, and every spec is swept over its repetitions
    row = df.agg(*(c.alias(name) for name, c in sums.items()))
    out = None
    for i, (t, y, zs) in enumerate(specs):
        cols = [t, y, *zs]
        blocks = []
        for n, e in enumerate(reps, 1 if extra else 0):
            own = {_cov(a, b): F.col(f"s{i}{_cov(a, b)}") for a, b in _pairs(cols)}
            if e is not None:
                own |= {_cov("__e", "__e" if c == e else c): F.col(f"s{i}{_cov(e, c)}") for c in [e, *cols]}
            blocks.append(F.struct(F.lit(n).alias("rep"), *(c.alias(name) for name, c in own.items())))
        more = ["__e"] if extra else []
        swept = _sweep(row.select(F.inline(F.array(*blocks))), [*cols, *more], [*zs, *more], t, y, "effect")
        part = swept.select(F.lit(t).alias("treatment"), F.lit(y).alias("outcome"), "rep", "effect")
        out = part if out is None else out.unionByName(part)
    return out


def shuffled_treatments(
    df: DataFrame, key: str | list[str], specs: list[Spec], reps: int, seed: int = 42, limit: int = ROWS_PER_SLICE
) -> DataFrame:
    """The rows with `<treatment>__<rep>`: the value `rep` places further on in md5 order of the key, from the last rows on
    to the first. One random order serves all treatments and repetitions."""
    names = [key] if isinstance(key, str) else key
    rows = df.select(*names, *(F.col(c).cast("double").alias(c) for c in _used(specs) if c not in names))
    placed = hash_index(rows, key, seed, None, "__i")
    total = rows.agg(F.count(F.lit(1)).alias("__total"))
    head = rows.withColumn("__h", hash_key(key, seed)).orderBy("__h").limit(reps)
    past = F.row_number().over(W.orderBy("__h")) + F.col("__total")
    again = attach_row(head, total).withColumn("__i", past.cast("long")).drop("__h", "__total")
    ring = placed.withColumn("__real", F.lit(True)).unionByName(again.withColumn("__real", F.lit(False)))
    treatments = list(dict.fromkeys(t for t, _, _ in specs))

    def build(frame):
        return {f"{t}__{r}": F.lead(t, r).over(frame.window) for t in treatments for r in range(1, reps + 1)}

    return over_groups(ring, [], ["__i"], build, after=reps, limit=limit, position="__i", trusted=True).filter("__real")


def refutations(
    df: DataFrame, key: str | list[str], specs: list[Spec], reps: int = 1, seed: int = 42, tolerance: float = 0.2
) -> DataFrame:
    """One row for each spec: the effect, its placebo and random-cause refutations (mean over the repetitions), reliability.

    The rows are put in random order once and then read once for the effects and the random causes and once for the
    placebos of all specs and repetitions; only rows of sums are joined.
    """
    df = df.dropna(subset=_used(specs))
    noise = [f"__noise_{r}" for r in range(1, reps + 1)]
    noisy = df.withColumns({c: hash_uniform(hash_key(key, seed + r)) for r, c in enumerate(noise, 1)})
    original = effects(df, specs).select("treatment", "outcome", F.col("effect").alias("original_effect"))
    shuffled = shuffled_treatments(df, key, specs, reps, seed)
    fakes = [(f"{t}__{r}", y, zs) for t, y, zs in specs for r in range(1, reps + 1)]
    placebo = effects(shuffled, fakes).withColumn("treatment", F.regexp_replace("treatment", "__[0-9]+$", ""))
    mean = lambda rows, name: rows.groupBy("treatment", "outcome").agg(F.avg("effect").alias(name))
    out = original.join(mean(placebo, "placebo_effect"), ["treatment", "outcome"])
    return _judged(out.join(mean(effects(noisy, specs, noise), "random_cause_effect"), ["treatment", "outcome"]), tolerance)


def _judged(row: DataFrame, tolerance: float) -> DataFrame:
    bound = F.abs("original_effect") * tolerance
    return row.withColumns(
        {
            "placebo_passed": F.coalesce(F.abs("placebo_effect") < bound, F.lit(False)),
            "random_cause_passed": F.coalesce(
                F.abs(F.col("random_cause_effect") - F.col("original_effect")) < bound, F.lit(False)
            ),
        }
    ).withColumn("reliable", F.col("placebo_passed") & F.col("random_cause_passed"))


def causal_risk(wear: Column, power: Column, wear_effect: Column, power_effect: Column) -> dict[str, Column]:
    """Added failure risk in percent from wear (per 10 minutes) and power (per 100 watts)."""
    from_wear, from_power = wear / 10 * wear_effect, power / 100 * power_effect
    return {"wear_risk_pct": from_wear, "power_risk_pct": from_power, "added_risk_pct": from_wear + from_power}


def risk_curve(row: DataFrame, wear_effect: str, baseline_pct: str, top: int = 240, step: int = 5) -> DataFrame:
    """Risk over a wear grid from a one-row table of fitted values."""
    grid = row.withColumn("wear", F.explode(F.sequence(F.lit(0), F.lit(top), F.lit(step))))
    return grid.select("wear", (F.col(baseline_pct) + F.col("wear") / 10 * F.col(wear_effect)).alias("risk_pct"))

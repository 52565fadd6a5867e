"""Results do not depend on partitions, on a group being cut into slices, or on hot keys."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugework.operators import features as X
from gaugework.operators import metrics as M
from gaugework.operators import sampling as P
from gaugework.operators import ordered
from gaugework.operators.causal import effect, placebo_effects
from gaugework.operators.cumulative import quantiles, running_sums
from gaugework.operators.ordered import group_index, hash_index
from gaugework.operators.sizing import sized
from gaugework.operators.smoothing import savgol


@pytest.fixture(scope="module")
def hot(spark):
    """One group holds most of the rows; cycles have gaps and come in no order."""
    rng = random.Random(3)
    rows = [("hot", i * 3, rng.uniform(0, 9)) for i in range(400)]
    rows += [(f"g{g}", i, rng.uniform(0, 9)) for g in range(20) for i in range(rng.randint(1, 14))]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "unit string, cycle long, x double").cache()


def rounded(df, *cols):
    keys = ["unit", "cycle"]
    return sorted(tuple(r) for r in df.select(*keys, *[F.round(c, 9) for c in cols]).collect())


@pytest.mark.parametrize("limit", [10, 37, 399])
def test_cut_groups_give_the_same_windows(hot, limit):
    whole = X.rolling_features(hot, ["x"], ["unit"])
    cut = X.rolling_features(hot, ["x"], ["unit"], limit=limit)
    assert str(rounded(cut, "x_velocity", "x_trend")) == str(rounded(whole, "x_velocity", "x_trend"))


@pytest.mark.parametrize("limit", [10, 37, 10_000])
def test_a_known_position_gives_the_same_windows(hot, limit):
    whole = X.rolling_features(hot, ["x"], ["unit"])
    known = X.rolling_features(group_index(hot, ["unit"], ["cycle"]), ["x"], ["unit"], limit=limit, position="pos")
    assert str(rounded(known, "x_velocity", "x_trend")) == str(rounded(whole, "x_velocity", "x_trend"))


@pytest.mark.parametrize("limit", [10, 64])
def test_cut_groups_give_the_same_smoothing(hot, limit):
    whole, cut = savgol(hot, ["x"], ["unit"], ["cycle"]), savgol(hot, ["x"], ["unit"], ["cycle"], limit=limit)
    assert rounded(cut, "x_smooth") == rounded(whole, "x_smooth")


@pytest.mark.parametrize("limit", [7, 50, 10_000])
@pytest.mark.parametrize("parts", [1, 4, 17])
def test_positions(hot, limit, parts):
    out = group_index(hot.repartition(parts), ["unit"], ["cycle"], limit=limit).toPandas()
    for _, g in out.sort_values("cycle").groupby("unit"):
        assert list(g["pos"]) == list(range(1, len(g) + 1))
    whole = group_index(hot, [], ["x"], limit=limit).toPandas().sort_values("x")
    assert list(whole["pos"]) == list(range(1, len(whole) + 1))


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_holdout_is_exact_and_repeatable(spark, parts):
    df = spark.range(1000).withColumn("label", (F.col("id") % 10 == 0).cast("int")).repartition(parts)
    out = P.holdout(df, "id", 0.2, ["label"])
    sizes = {r["label"]: r["n"] for r in out.filter("is_test").groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert sizes == {0: 180, 1: 20} and out.count() == 1000
    picked = sorted(r["id"] for r in out.filter("is_test").collect())
    again = sorted(r["id"] for r in P.holdout(df.repartition(3), "id", 0.2, ["label"]).filter("is_test").collect())
    assert picked == again


def test_group_holdout_never_splits_a_group(hot):
    out = P.group_holdout(hot, ["unit"])
    sides = out.groupBy("unit").agg(F.count_distinct("is_test").alias("n"), F.max("is_test").alias("t")).collect()
    assert all(r["n"] == 1 for r in sides) and sum(r["t"] for r in sides) == 5  # a fifth of 21 groups, rounded up


def test_folds_prefix_and_caps(spark):
    df = spark.range(1003)
    counts = [r["count"] for r in P.folds(df, "id", 5).groupBy("fold").count().collect()]
    assert sorted(counts) == [200, 200, 201, 201, 201]
    out = P.ordered_prefix(df, "id", 0.8)
    assert out.filter("is_train").agg(F.max("id"), F.count("*")).first()[:] == (801, 802)
    skewed = df.withColumn("g", F.when(F.col("id") < 990, 0).otherwise(1))
    for cap in (5, 990, 1001):
        got = {r["g"]: r["count"] for r in P.capped_sample(skewed, "id", ["g"], cap).groupBy("g").count().collect()}
        assert got == {0: min(cap, 990), 1: min(cap, 13)}


def test_hash_positions_are_a_permutation(spark):
    out = hash_index(spark.range(500), "id").toPandas()
    assert sorted(out["pos"]) == list(range(1, 501)) and list(out.sort_values("id")["pos"]) != list(range(1, 501))


def test_running_sums_and_quantiles(spark):
    rng = np.random.default_rng(0)
    values = np.concatenate([rng.integers(0, 50, 400).astype(float), rng.normal(1e6, 10, 300), np.full(500, 7.0)])
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(5)
    counts = df.groupBy(F.col("v").alias("value")).agg(F.count("*").alias("n"))
    out = running_sums(counts, [], "value", ["n"]).toPandas().sort_values("value")
    assert list(out["cum_n"]) == list(out["n"].cumsum()) and set(out["tot_n"]) == {1200}
    assert list(out["next_value"])[:-1] == list(out["value"])[1:]
    got = {r["share"]: r["quantile"] for r in quantiles(df, ["v"], [0.0, 0.1, 0.5, 0.9, 1.0]).collect()}
    assert all(got[s] == pytest.approx(np.quantile(values, s)) for s in got)
    near = {r["share"]: r["quantile"] for r in quantiles(df, ["v"], [0.25, 0.9], linear=False).collect()}
    assert all(near[s] == np.quantile(values, s, method="nearest") for s in near)


def test_auc_is_symmetric_and_exact_on_ties(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 5) / 5, rng.randint(0, 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "s double, y int")
    got = M.auc(df, "y", "s").first()["auc"]
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert got == pytest.approx(brute)
    assert M.auc(df.withColumn("s", -F.col("s")), "y", "s").first()["auc"] == pytest.approx(1 - got)


def test_permutation_keeps_the_treatment_values(spark):
    """Placebo effects by brute force from the md5 order, with slices smaller than the table."""
    rng = np.random.default_rng(2)
    z = rng.normal(size=300)
    t = z + rng.normal(size=300)
    y = 2 * t - z + rng.normal(size=300)
    df = spark.createDataFrame([(i, float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(t, y, z))], "id long, t double, y double, z double")
    order = np.array([r["id"] for r in hash_index(df, "id").orderBy("pos").collect()])
    for limit in (20, 10_000):
        got = [r["effect"] for r in placebo_effects(df, "id", "t", "y", ["z"], reps=4, limit=limit).orderBy("rep").collect()]
        for rep, value in enumerate(got, 1):
            fake = np.empty(300)
            fake[order] = np.roll(t[order], -rep)
            design = np.column_stack([np.ones(300), fake, z])
            assert value == pytest.approx(np.linalg.lstsq(design, y, rcond=None)[0][1])
    assert effect(df, "t", "y", ["z"]).first()["effect"] == pytest.approx(2.0, abs=0.15)


def test_plans_have_no_window_over_the_whole_table(spark, hot):
    """A window without partition keys may only run over bucket tables, never over the rows."""
    plan = P.holdout(hot.withColumn("k", F.concat("unit", F.col("cycle").cast("string"))), "k")._jdf.queryExecution().toString()
    assert "cartesian" not in plan.lower()
    side, rows = sized(hot.groupBy("unit").count())
    assert rows == 21
    joined = hot.join(side, "unit")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in joined


@pytest.mark.parametrize("kind", ["bigint", "double", "string", "date", "timestamp_ntz", "decimal(20,2)"])
@pytest.mark.parametrize("limit", [7, 40, 1000])
def test_order_of_any_type_does_not_depend_on_the_limit(spark, kind, limit):
    """String, date and null orders, with ties that the second column breaks: the same positions at every limit."""
    from gaugework.operators.ordered import group_index

    rows = spark.range(400).selectExpr("id % 3 AS g", "id", "CAST(nullif((id * 7) % 60, 11) AS INT) AS n")
    value = {"date": "date_add(date'2024-01-01', n)", "timestamp_ntz": "CAST(date_add(date'2024-01-01', n) AS timestamp_ntz)"}
    rows = rows.selectExpr("g", "id", f"CAST({value.get(kind, 'n')} AS {kind}) AS v").repartition(5)
    small = {(r.g, r.id): r.pos for r in group_index(rows, ["g"], ["v", "id"]).collect()}
    cut = {(r.g, r.id): r.pos for r in group_index(rows, ["g"], ["v", "id"], limit=limit).collect()}
    assert cut == small and len(small) == 400


def test_positions_with_gaps_are_refused(spark):
    from gaugework.operators.features import rolling_features

    cycles = spark.range(60).selectExpr("1 AS unit", "id * 5 + 5 AS cycle", "CAST(id AS double) AS x")
    with pytest.raises(ValueError, match="without gaps"):
        rolling_features(cycles, ["x"], ["unit"], limit=20, position="cycle")


@pytest.mark.parametrize("kind", ["id", "string", "ties"])
def test_many_buckets_give_the_positions_and_no_row_meets_all_split_points(spark, hot, monkeypatch, kind):
    monkeypatch.setattr(ordered, "ROWS_PER_BUCKET", 1)
    order = {
        "id": [F.when(F.col("id") % 97 > 0, F.col("id") * 7 % 1999)], "string": [F.hex(F.col("id") * 7 % 1999)],
        "ties": [F.col("id") % 3, F.when(F.col("id") > 50, F.col("id"))],
    }[kind]
    names = [f"o{i}" for i in range(len(order))]
    df = spark.range(1500).withColumns(dict(zip(names, order))).withColumn("unit", F.when(F.col("id") % 10 == 0, "b").otherwise("a"))
    names.append("id")  # the rows whose first value is null
    met = []
    place = ordered.place

    def spy(value, splits, buckets):
        met.append(buckets)
        return place(value, splits, buckets)

    monkeypatch.setattr(ordered, "place", spy)
    cut = group_index(df, ["unit"], names, limit=2).select("id", "pos")
    assert max(met) <= 64 and met[0] * met[1] == 2048
    whole = group_index(df, ["unit"], names).select("id", "pos")
    assert cut.exceptAll(whole).count() == 0 and cut.count() == 1500


def test_buckets_do_not_follow_a_small_limit(spark, hot, monkeypatch):
    met = []
    place = ordered.place
    monkeypatch.setattr(ordered, "place", lambda value, splits, buckets: met.append(buckets) or place(value, splits, buckets))
    assert group_index(hot, [], ["x"], limit=2).agg(F.max("pos")).first()[0] == hot.count()
    assert met[0] * met[1] == 8

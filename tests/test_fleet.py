"""Fleet statistics, draws with replacement and gates."""

import hashlib
import statistics

import pytest

from gaugework.operators.readiness import GATES, gate_checks
from gaugework.operators.sampling import draw_with_replacement
from gaugework.operators.summary import fleet_statistics


def nearest(values, share):
    values = sorted(values)
    return values[round(share * (len(values) - 1))]


def test_fleet_statistics_by_hand(spark):
    rows = [("A", i % 37, (i * 7919 % 101) / 7) for i in range(200)] + [("B", 5, 1.5), (None, 9, 2.0), ("A", None, None), ("C", None, None)]
    got = {r.dataset_id: r for r in fleet_statistics(spark.createDataFrame(rows, "dataset_id string, rul int, thermal_stress double")).collect()}
    assert set(got) == {"A", "B", None, "C", "all"}
    for name in ("A", "all"):
        lives = [l for d, l, _ in rows if l is not None and (name == "all" or d == name)]
        stress = [s for d, _, s in rows if s is not None and (name == "all" or d == name)]
        r = got[name]
        assert r.median_rul == statistics.median(lives)
        assert r.mean_stress == pytest.approx(statistics.fmean(stress)) and r.std_stress == pytest.approx(statistics.stdev(stress))
        assert (r.p90_stress, r.p95_stress) == (nearest(stress, 0.9), nearest(stress, 0.95))
    assert tuple(got["B"])[1:3] == (5.0, 1.5) and got["B"].p90_stress == 1.5
    assert tuple(got["C"])[1:] == (None,) * 5


@pytest.mark.parametrize("n", [1, 40, 300])
def test_draws_against_the_whole_order(spark, n):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(150)], "id int, v string").repartition(5)
    md5 = lambda text: hashlib.md5(text.encode()).hexdigest()
    order = sorted(range(150), key=lambda i: md5(f"{i}|42"))
    want = [(d, order[int(md5(f"{d}|42")[:15], 16) % 150]) for d in range(1, n + 1)]
    got = draw_with_replacement(df, "id", n)
    assert got.columns == ["draw", "id", "v"]
    assert sorted((r.draw, r.id) for r in got.collect()) == want
    assert draw_with_replacement(df.limit(0), "id", n).count() == 0


def test_a_repeated_or_unknown_metric_ends_no_gate(spark):
    metric, _, _ = next(iter(GATES.values()))
    df = spark.createDataFrame([(metric, 1.0), (metric, 2.0), ("something else", 3.0), (None, 1.0)], "metric string, value double")
    rows = {r.check: r for r in gate_checks(df).collect()}
    assert len(rows) == len(GATES) and next(iter(rows.values())).value == 2.0
    assert all(r.value is None and not r.passed for r in rows.values() if r.metric != metric)
    assert len(gate_checks(df.limit(0)).collect()) == len(GATES)

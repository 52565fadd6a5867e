from collections import defaultdict
from hashlib import md5

import pytest

from gaugework.llm.mixing import budgets, mix
from gaugework.llm.queries import ORACLES, QUERIES
from tests.compare import database, difference


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert difference(QUERIES["op8_hierarchical_mix"](spark, sf), database(sf), ORACLES["op8_hierarchical_mix"]) is None


def water(budget, children):
    """children: name -> (weight, capacity); the level at which all the budget is used, by bisection over the reals."""
    low, high = 0.0, 1e12
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(c, mid * w) for w, c in children.values()) < budget else (low, mid)
    return {n: min(c, low * w) for n, (w, c) in children.items()}


def test_shortages_go_to_siblings_first(spark):
    supply = {("a", "x"): 10, ("a", "y"): 1000, ("b", "x"): 30, ("b", "y"): 40, ("c", "x"): 5000}
    leaves = spark.createDataFrame([(*k, v) for k, v in supply.items()], "d string, s string, supply bigint")
    table = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 1.0)], "d string, weight double")
    got = {(r.d, r.s): r.budget for r in budgets(leaves, ["d", "s"], 600, {"d": table}).collect()}
    # b wants 300 but holds 70: its siblings a and c share the rest; within a, y makes up for x
    assert got == {("a", "x"): 10, ("a", "y"): 255, ("b", "x"): 30, ("b", "y"): 40, ("c", "x"): 265}


def test_levels_against_bisection(spark):
    import random

    rng = random.Random(5)
    supply = {(f"d{i}", f"s{j}"): rng.choice([0, 1, 7, 50, 400, 9000]) for i in range(6) for j in range(5)}
    weight = {f"d{i}": rng.choice([0.0, 1.0, 2.5, 7.0]) for i in range(6)}
    leaves = spark.createDataFrame([(*k, v) for k, v in supply.items()], "d string, s string, supply bigint")
    table = spark.createDataFrame(list(weight.items()), "d string, weight double")
    for total in (0, 1, 500, 20_000, 10**9):
        got = {(r.d, r.s): r.budget for r in budgets(leaves, ["d", "s"], total, {"d": table}, 1.5).collect()}
        caps = {k: int(v * 1.5) if weight[k[0]] else 0 for k, v in supply.items()}
        top = {d: (w, sum(c for k, c in caps.items() if k[0] == d)) for d, w in weight.items()}
        nodes = water(min(total, sum(caps.values())), top)
        assert sum(got.values()) == min(total, sum(caps.values()))
        for d in weight:
            want = water(nodes[d], {k: (1.0, c) for k, c in caps.items() if k[0] == d})
            assert all(abs(got[k] - want[k]) <= 3 for k in want), (total, d)


@pytest.mark.parametrize("total", [0, 300, 1700, 10**6])
def test_prefixes_against_brute_force(spark, total):
    rows = [(i, " ".join(["w"] * (i % 13)), "s" + str(i % 3) if i % 7 else None, "x") for i in range(200)] + [(5, "a b c", "s2", "x"), (None, None, None, "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, tokens string, epochs string")
    got = mix(docs, ["tokens"], total, epochs=2.5, seed=3)
    assert got.columns == ["doc_id", "text", "tokens", "epochs"]
    leaf = defaultdict(list)
    for i, t, s, _ in rows:
        leaf[s].append((i, len((t or "").split())))
    caps = {s: (1.0, int(2.5 * sum(n for _, n in x))) for s, x in leaf.items()}
    wanted = {s: b + 1e-6 for s, b in water(min(total, sum(c for _, c in caps.values())), caps).items()}
    taken = sorted(((r.doc_id is None, r.doc_id), r.epochs) for r in got.select("doc_id", "epochs").collect())
    want = []
    for s, x in leaf.items():
        supply, budget = sum(n for _, n in x), int(wanted[s])
        whole, rest = divmod(budget, supply)
        place = lambda i: int(md5(f"3:{whole}:{'null' if i is None else i}".encode()).hexdigest()[:15], 16)  # noqa: E731, B023
        sums = defaultdict(int)
        for i, n in x:
            sums[place(i)] += n
        through, fits = 0, set()
        for p in sorted(sums):
            through += sums[p]
            if not rest or through > rest:
                break
            fits.add(p)
        want += [((i is None, i), whole + (place(i) in fits)) for i, _ in x if whole + (place(i) in fits)]
    assert taken == sorted(want)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert mix(docs, ["lang"], 0.5).count() == 0
    assert mix(docs, ["lang"], 100).count() == 0

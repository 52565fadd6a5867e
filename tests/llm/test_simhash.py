from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from gaugework.llm import simhash
from gaugework.llm.simhash import near_duplicates, one_of_each


def brute_print(text, shingle=3):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, most=2):
    parent = list(range(len(prints)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= most:
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return [top(i) for i in range(len(prints))]


def test_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id")
    rows = docs.collect()
    prints = [brute_print(r.text) for r in rows]
    want = {r.doc_id: (p, rows[c].doc_id) for r, p, c in zip(rows, prints, brute_components(prints), strict=True)}
    got = {r.doc_id: (r.fp % 2**64, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == want


@pytest.mark.parametrize("most", [0, 1, 2])
def test_chains_of_bits(spark, monkeypatch, most):
    """Fingerprints one to three bits apart, planted directly, are joined as all pairs would join them."""
    from gaugework.llm import simhash

    base = [0x0123456789ABCDEF, 0, 0xFFFFFFFFFFFFFFFF]
    prints = [b ^ (m << s) for b in base for s in (0, 7, 31, 60) for m in (0, 1, 3, 7, 15)]
    prints = [p % 2**64 for p in prints]
    import numpy as np

    table = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in sorted(set(prints))], "fp bigint")
    links = simhash.pivot_table(table).repartition("key").sortWithinPartitions("key", "fp").mapInArrow(simhash._link(most), "a bigint, b bigint")
    found = {frozenset((a % 2**64, b % 2**64)) for a, b in links.collect()}
    assert all((max(p) ^ min(p)).bit_count() <= 2 * most * 16 for p in found)
    distinct = sorted(set(prints))
    index = {p: i for i, p in enumerate(distinct)}
    parent = list(range(len(distinct)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for pair in found:
        a, b = sorted(top(index[p]) for p in pair)
        parent[b] = a
    assert [top(i) for i in range(len(distinct))] == brute_components(distinct, most)


def test_nulls_empty_repeats_and_clashing_columns(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(5, "a b c d e f g"), (3, "A B  C\nd e f g"), (9, None), (8, ""), (7, " \t"), (None, "solo text without an id at all"), (1, long), (1, long), (2, long)]
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id bigint, text string, fp string, __id int")
    got = Counter((r.doc_id, r.component_id) for r in near_duplicates(docs).collect())
    assert got == Counter({(5, 3): 1, (3, 3): 1, (9, 7): 1, (8, 7): 1, (7, 7): 1, (None, None): 1, (1, 1): 2, (2, 1): 1})
    kept = one_of_each(docs.withColumnRenamed("__id", "node"))
    assert kept.columns == ["doc_id", "text", "fp", "node"]
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.select("doc_id").collect()) == [(False, 1), (False, 3), (False, 7), (True, None)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert near_duplicates(docs).count() == 0
    assert one_of_each(docs).count() == 0


def test_one_large_group_of_near_copies(spark):
    """Copies of one text with one changed word each: as many links as all pairs would give, few rows of links."""
    words = [f"word{i}" for i in range(400)]
    texts = [" ".join(words[:k] + [f"new{k}"] + words[k + 1 :]) for k in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = brute_components([brute_print(t) for t in texts])
    got = {r.doc_id: r.component_id for r in near_duplicates(docs).select("doc_id", F.col("component_id")).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_references_of_a_group_tell_all_its_values_apart():
    """Equal coordinates in six groups are equal bits there, so a key holds at most 2^16 fingerprints."""
    seen = {tuple((x ^ p).bit_count() - x.bit_count() for p in simhash.WITHIN_GROUP) for x in range(256)}
    assert len(seen) == 256

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from gaugework.llm import phrases
from gaugework.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(rows):
    counts = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            for n in (1, 2, 3):
                counts[lang or "und"].update(" ".join(words[i : i + n]) for i in range(len(words) - n + 1))
            counts[lang or "und"][""] += len(words)
    return counts


def brute(rows, least, percent, best):
    out = []
    for lang, f in brute_counts(rows).items():
        candidates = {p: a for p, a in f.items() if p and " " in p and a >= least}
        dropped = set()
        for p, a in candidates.items():
            w = p.split(" ")
            if len(w) == 3:
                dropped |= {q for q in (" ".join(w[:2]), " ".join(w[1:])) if 100 * a >= percent * f[q]}
        scored = []
        for p, a in candidates.items():
            if p in dropped:
                continue
            w = p.split(" ")
            cuts = [(1000000 * a * a // (f[" ".join(w[:k])] * f[" ".join(w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            scored.append((-score, -a, p.encode(), f[" ".join(w[:k])], f[" ".join(w[k:])]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:best], 1):
            out.append((lang, rank, p.decode(), -a, left, right, f[""], -score))
    return sorted(out)


def texts(seed, n):
    rng = random.Random(seed)
    vocabulary = ["The", "the", "OF", "ünd", "a", "b", "cd", "É", "é", "x-y", "1", "\x1f", "ß"]
    common = ["one two three", "one two", "b cd É 1", "Z z Z z z"]
    rows = []
    for _ in range(n):
        parts = [rng.choice([rng.choice(common), " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))]) for _ in range(rng.randint(0, 9))]
        rows.append((rng.choice(["en", "de", None, "und"]), rng.choice([" ", ". ", "\n", ", ", "\r\n", "\t"]).join(parts)))
    return [*rows, *rows[: n // 3], ("en", None), (None, ""), ("en", " .,;:!?\n"), ("xx", "lonely words"), ("en", "a" * 3000)]


@pytest.mark.parametrize("chunk", [1, 3, 8, 10**9])
def test_counts_against_brute_force(spark, chunk):
    rows = texts(chunk, 120)
    docs = spark.createDataFrame([(t, k, 1, "f") for k, t in rows], "text string, lang string, n int, f string")
    got = {(r.lang, r.phrase): r.f for r in phrases.phrase_counts(docs, chunk=chunk).collect()}
    want = {(k, p): n for k, f in brute_counts(rows).items() for p, n in f.items() if n}
    assert {k: v for k, v in got.items() if v} == want


@pytest.mark.parametrize(("bits", "least"), [(27, 4), (27, 2), (9, 4)])
def test_counts_of_frequent_phrases(spark, bits, least):
    """Triples are left out by the map of frequent pairs; a map that is nearly full leaves out none too many."""
    rows = texts(bits, 120)
    docs = spark.createDataFrame([(t, k) for k, t in rows], "text string, lang string")
    got = {(r.lang, r.phrase): r.f for r in phrases.phrase_counts(docs, least=least, map_bits=bits).collect()}
    assert got == {(k, p): n for k, f in brute_counts(rows).items() for p, n in f.items() if n >= least}


def test_fewer_triples_are_counted():
    chunks = pa.array(["a b c", "a b d e"])
    weights, final = np.array([3, 5]), np.array([True, True])
    bits = np.zeros(1 << (phrases.MAP_BITS - 3), np.uint8)
    digest = lambda w: phrases.word_digests(pa.array([w.encode()]))[:, 0]
    for one, two in ("ab", "bd"):
        place = int(phrases._pair_bits("en", digest(one), digest(two), phrases.MAP_BITS)[0])
        bits[place >> 3] |= 1 << (place & 7)
    found, counts = phrases.chunk_phrases(chunks, final, weights, (3,), "en", bits)
    assert dict(zip(found.to_pylist(), counts.tolist(), strict=True)) == {"a b d": 5}


@pytest.mark.parametrize(("least", "percent", "best"), [(10, 50, 2000), (3, 80, 7), (2, 10, 50)])
def test_collocations_against_brute_force(spark, least, percent, best):
    rows = texts(least, 150)
    docs = spark.createDataFrame([(t, k, 1, "f") for k, t in rows], "text string, lang string, n int, phrase string")
    got = phrases.collocations(docs, least=least, percent=percent, best=best)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, least, percent, best)


def test_very_long_text_and_empty_tables(spark):
    rng = np.random.default_rng(2)
    long = " ".join(f"w{x}" for x in rng.integers(0, 40, 400_000))
    docs = spark.createDataFrame([(long, "en")], "text string, lang string")
    assert sorted(tuple(r) for r in phrases.collocations(docs).collect()) == brute([("en", long)], 10, 50, 2000)
    assert phrases.collocations(docs.limit(0)).count() == 0
    assert phrases.collocations(spark.createDataFrame([("a b c", None)], "text string, lang string")).count() == 0


def test_scores_beyond_64_bits(spark, monkeypatch):
    counts = [("en", "", 10**13), ("en", "a", 3 * 10**12), ("en", "b", 7 * 10**11 + 1), ("en", "a b", 6 * 10**11 + 7)]
    table = spark.createDataFrame(counts, "lang string, phrase string, f bigint")
    monkeypatch.setattr(phrases, "phrase_counts", lambda *a: table)
    (row,) = phrases.collocations(table.withColumn("text", table.phrase)).collect()
    a, left, right = 6 * 10**11 + 7, 3 * 10**12, 7 * 10**11 + 1
    assert (row.a, row.l, row.r, row.n, row.score) == (a, left, right, 10**13, 10**6 * a * a // (left * right))


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in QUERIES["op13_prefix_free"](spark, sf).collect())
    assert got == brute(rows, 10, 50, 2000) and got

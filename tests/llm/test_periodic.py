import hashlib
import random
import zlib

import pyarrow as pa

from gaugework.llm import periodic
from gaugework.llm.queries import QUERIES


def brute(words, least=24, power=3):
    """All runs, by trying every period from the smallest at every place."""
    found = {}
    for q in range(1, len(words) // power + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, power * q):
                found.setdefault((start, i + q - start), q)
            i += i == start
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def runs_of(row):
    return [(r["start"], r["length"], r["period"]) for r in row["runs"]]


def test_runs_against_brute_force():
    rng = random.Random(5)
    for turn in range(300):
        least, power = rng.choice([(24, 3), (6, 3), (8, 4), (12, 3)])
        texts = [None, "", " \t\n"]
        for _ in range(rng.randint(1, 5)):
            words = []
            while rng.random() < 0.85 and len(words) < 200:
                base = [rng.choice("ab" if rng.random() < 0.5 else "abcdefgh") for _ in range(rng.randint(1, 9))]
                words += (base * rng.randint(1, 9))[: rng.randint(1, 60)]
            texts.append(rng.choice([" ", "\n", " \t "]).join(words))
        texts.append(texts[3])
        for text, row in zip(texts, periodic._measure(least, power)(pa.array(texts, pa.string())).to_pylist(), strict=True):
            words = (text or "").split()
            assert runs_of(row) == brute(words, least, power)
            assert row["collapsed"] == collapsed(words, brute(words, least, power)) and row["n_words"] == len(words)


def test_very_long_texts_of_one_word_and_of_nested_periods():
    texts = ["ü " * 200_000, ("a b a b a b a b c " * 9 + "x ") * 3000]
    one, nested = periodic._measure(24, 3)(pa.array(texts)).to_pylist()
    assert runs_of(one) == [(0, 200_000, 1)] and one["collapsed"] == "ü"
    assert len(nested["runs"]) == 3001 and (0, 82 * 3000, 82) in runs_of(nested)


def test_tables(spark):
    line = "a b c d e f g h "
    rows = [(1, line * 4), (1, line * 4), (None, line * 3), (2, None), (3, ""), (4, "x " * 23), (5, "x " * 24)]
    docs = spark.createDataFrame([(i, t, 7, "n") for i, t in rows], "doc_id int, text string, periodic int, runs string")
    got = periodic.periodic_runs(docs)
    assert got.columns == ["doc_id", "text", "periodic", "runs"]
    found = [(r.doc_id, r.text, r.runs, [tuple(x) for x in r.periodic.runs]) for r in got.collect()]
    want = [(0, 32, 8)], [(0, 32, 8)], [(0, 24, 8)], [], [], [], [(0, 24, 1)]
    assert found == [(i, t, "n", w) for (i, t), w in zip(rows, want, strict=True)]
    assert periodic.periodic_runs(docs.limit(0)).count() == 0
    best = got.select(periodic.strongest("periodic.runs").alias("b")).collect()
    assert [r.b and tuple(r.b) for r in best] == [w[0] if w else None for w in want]


def planted(id, text):
    words = (text or "").split()
    h, n = zlib.crc32(str(id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op11_maximal_pairs"](spark, sf).collect()}
    assert len(got) == len(docs)
    some = 0
    for d in docs:
        words = planted(d.doc_id, d.text)
        runs = brute(words)
        r = got[d.doc_id]
        best = None
        for s, n, q in runs:
            if best is None or n * best[2] > best[1] * q:
                best = s, n, q
        some += best is not None
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *(best or (None,) * 3))
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert some > 5


def test_repeats_of_nulls(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    docs = spark.createDataFrame([(ids[0], None, 1), (ids[1], "", 1), (ids[2], " ", 1), (None, "a b c", 1), (ids[3], "a b c d e", 1)], "doc_id int, text string, h int")
    got = [tuple(r) for r in periodic.with_repeats(docs).collect()]
    assert got == [(ids[0], None, 1), (ids[1], "", 1), (ids[2], " ", 1), (None, "a b c", 1), (ids[3], " ".join(planted(ids[3], "a b c d e")), 1)]

import hashlib
import random

import numpy as np
import pytest

from gaugework.llm import substrings
from gaugework.llm.queries import QUERIES


def brute(rows, length):
    """(words, removed, kept) of each (key, words), in any order of rows; equal keys are the same document."""
    first = {}
    for key, words in rows:
        for i in range(len(words) - length + 1):
            place = key, i
            window = tuple(words[i : i + length])
            first[window] = min(first.get(window, place), place)
    out = []
    for key, words in rows:
        gone = set()
        for i in range(len(words) - length + 1):
            if first[tuple(words[i : i + length])] < (key, i):
                gone |= set(range(i, i + length))
        out.append((len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return out


def texts(rng, n):
    phrases = [[rng.choice("abcdeé") for _ in range(rng.randint(3, 12))] for _ in range(6)]
    out = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 8)):
            words += rng.choice([rng.choice(phrases), [str(rng.randint(0, 50)) for _ in range(3)]])
        out.append(rng.choice([" ", "\n", " \t"]).join(words))
    return [*out, out[0], out[1], "a " * 300, "a b " * 100, "x" + " a" * 30, "z " * 5, "z z z z", ""]


@pytest.mark.parametrize(("length", "seed_words"), [(5, 2), (8, 4), (6, 1), (9, 8)])
def test_documents_against_all_windows(spark, length, seed_words):
    rng = random.Random(length)
    bodies = texts(rng, 50)
    ids = list(range(len(bodies)))
    rng.shuffle(ids)
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in zip(ids, bodies, strict=True)], "doc_id bigint, text string, d string, run int, seed int")
    got = {r.doc_id: tuple(r)[1:] for r in substrings.remove_later_repeats(docs, length=length, seed_words=seed_words).collect()}
    want = brute([(i, t.split()) for i, t in zip(ids, bodies, strict=True)], length)
    assert got == dict(zip(ids, want, strict=True))


def test_nulls_repeated_rows_and_empty_tables(spark):
    line = " ".join(f"w{i}" for i in range(30))
    rows = [(None, line), (7, line), (7, line), (8, "other " + line), (2, None), (3, ""), (4, " \n")]
    docs = spark.createDataFrame(rows, "n int, body string")
    got = sorted((r.n is None, r.n or 0, r.n_words, r.n_removed, r.kept) for r in substrings.remove_later_repeats(docs, "n", "body").collect())
    assert got == [(False, 2, 0, 0, ""), (False, 3, 0, 0, ""), (False, 4, 0, 0, ""), *[(False, 7, 30, 30, "")] * 2, (False, 8, 31, 30, "other"), (True, 0, 30, 0, line)]
    # rows with one id and text are one document: none of them is earlier
    alone = docs.filter("n = 7")
    assert [r.n_removed for r in substrings.remove_later_repeats(alone, "n", "body").collect()] == [0, 0]
    assert substrings.remove_later_repeats(docs.limit(0), "n", "body").count() == 0


def test_rows_with_one_id_and_other_texts(spark):
    line = " ".join(f"w{i}" for i in range(25))
    docs = spark.createDataFrame([(1, "a " + line), (1, "b " + line), (1, line + " c")], "doc_id int, text string")
    removed = [r.n_removed for r in substrings.remove_later_repeats(docs).collect()]
    assert sorted(removed) == [0, 25, 25]


def test_a_very_long_text_and_one_passage_in_all_documents(spark):
    rng = np.random.default_rng(3)
    passage = " ".join(f"p{i}" for i in range(60))
    bodies = [f"{' '.join(f'u{x}' for x in rng.integers(0, 10**9, 5))} {passage} {' '.join(f'v{x}' for x in rng.integers(0, 10**9, 5))}" for _ in range(300)]
    bodies.append(" ".join(f"q{x}" for x in rng.integers(0, 10**9, 300_000)) + " " + passage)
    docs = spark.createDataFrame(list(enumerate(bodies)), "doc_id int, text string")
    got = {r.doc_id: r.n_removed for r in substrings.remove_later_repeats(docs).select("doc_id", "n_removed").collect()}
    assert got == {i: 60 if i else 0 for i in range(301)}


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = brute([(r.doc_id, r.text.split()) for r in rows], 20)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op12_seed_extend"](spark, sf).collect()}
    assert got == {r.doc_id: (a, b, hashlib.sha256(k.encode()).hexdigest()) for r, (a, b, k) in zip(rows, want, strict=True)}
    assert any(w[1] for w in want)

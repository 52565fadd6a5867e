import hashlib
import random
from collections import Counter

import pytest

from gaugework.llm import suffix
from gaugework.llm.queries import QUERIES


def brute(texts, length):
    """(bytes, removed, spans, kept) of each text, from the count of every window."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(r), sum(gone), spans, kept))
    return out


def test_suffix_arrays_against_window_counts():
    rng = random.Random(1)
    for _ in range(150):
        length, alphabet = rng.choice([8, 16, 24]), rng.choice([b"a", b"ab", b"abc\xf4\x00"])
        contexts = [bytes(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(rng.randint(1, 12))]
        contexts += [contexts[0][3:] + b"x", contexts[-1]]
        seen = Counter(c[i : i + length] for c in contexts for i in range(len(c) - length + 1))
        want = [[seen[c[i : i + length]] > 1 for i in range(len(c) - length + 1)] for c in contexts]
        assert [f.tolist() for f in suffix.repeated_starts(contexts, length)] == want


def pieces(rng, n):
    phrases = ["".join(rng.choices("abcdeé ", k=rng.randint(10, 60))) for _ in range(8)]
    texts = ["".join(rng.choice([rng.choice(phrases), "".join(rng.choices("abñ", k=20))]) for _ in range(rng.randint(0, 8))) for _ in range(n)]
    return [*texts, texts[0], texts[1], None, "", "a" * 300, "ab" * 100, "x" + "a" * 30, phrases[0] * 2, "z" * 23, "z" * 23]


@pytest.mark.parametrize("most", [1, 8192])
def test_documents_against_window_counts(spark, monkeypatch, most):
    """With one context allowed, every open group takes the way by digests."""
    monkeypatch.setattr(suffix, "MOST_CONTEXTS", most)
    texts = pieces(random.Random(most), 60)
    docs = spark.createDataFrame([(i if i % 9 else None, i, t, "x", 1) for i, t in enumerate(texts)], "doc_id bigint, n int, text string, d string, run int")
    got = suffix.remove_repeats(docs, "n", "text", length=24, gram=8).collect()
    assert [tuple(r)[1:] for r in sorted(got, key=lambda r: r.n)] == brute(texts, 24)
    assert suffix.remove_repeats(docs, length=24, gram=8).filter("doc_id is null").count() == len([i for i in range(len(texts)) if i % 9 == 0])


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = {r.doc_id: (a, b, c, hashlib.sha256(k).hexdigest()) for r, (a, b, c, k) in zip(rows, brute([r.text for r in rows], 200), strict=True)}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op6_suffix_array"](spark, sf).collect()}
    assert got == want and any(w[1] for w in want.values())


def test_empty_table(spark):
    assert suffix.remove_repeats(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0

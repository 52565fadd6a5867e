import hashlib

import numpy as np

from gaugework.llm import multiset
from gaugework.llm.queries import QUERIES


def print_of(text):
    return multiset.packed(*multiset.vectors([text]))[0]


def test_order_insertion_and_deletion():
    paragraphs = [f"paragraph {i} with the word {i * i} and some more, again and again" for i in range(40)]
    whole = print_of("\n".join(paragraphs))
    assert whole == print_of("\n\n".join(reversed(paragraphs)))
    assert whole != print_of("\n".join(paragraphs[:-1])) != print_of("\n".join([*paragraphs[:-1], paragraphs[0]]))
    assert multiset.changed(print_of("\n".join(paragraphs[:30])), added=paragraphs[30:]) == whole
    assert multiset.changed(whole, removed=paragraphs[:10], added=["x y z"]) == print_of("\n".join([*paragraphs[10:], "x y z"]))
    assert multiset.changed(whole, removed=paragraphs) == print_of("") == print_of(None) == print_of(" \n\t")
    assert print_of("a b") != print_of("b a") and print_of("ab\nc") != print_of("a\nbc")


def test_likeness_follows_the_common_share():
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in rng.integers(0, 10**6, 3000)]
    lines = [" ".join(words[i : i + 30]) for i in range(0, 3000, 30)]
    for share in (0.0, 0.25, 0.5, 0.9, 1.0):
        k = int(len(lines) * share)
        other = lines[:k] + [x.upper() for x in lines[k:]]
        got = multiset.likeness(multiset.vectors(["\n".join(lines)]), multiset.vectors(["\n".join(other)]))[0]
        assert abs(got - share) < 0.2 and (share != 1 or got == 1)


def check(rows, docs):
    """rows: of the query by id; docs: (id, text) in the order in which documents follow each other."""
    for n, (id, text) in enumerate(docs):
        after = docs[(n + 1) % len(docs)][1]
        r, half = rows[id], len(text) // 2
        new = text[: len(text) - half] + after[:half]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == (print_of(text), print_of(new))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.near_next == 1) == (r.fingerprint == print_of(after))


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id", ascending=False).collect()]
    rows = {r.doc_id: r for r in QUERIES["op5_multiset_hash"](spark, sf).collect()}
    assert len(rows) == len(docs)
    check(rows, docs)
    nearer = [rows[i].near_edited > rows[i].near_next for i, t in docs if len(t) > 400]
    assert sum(nearer) > 0.97 * len(nearer)


def test_nulls_repeats_and_clashing_columns(spark):
    long = "ü line\n" * 30_000
    rows = [(4, "a b\nc d é"), (None, "null id"), (2, None), (3, ""), (1, long), (7, "same"), (7, "same")]
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id bigint, text string, fingerprint string, part int, role int")
    got = multiset.fingerprints(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((i is None, i or 0) for i, _ in rows)
    order = [(7, "same"), (4, "a b\nc d é"), (3, ""), (2, ""), (1, long), (None, "null id"), (7, "same")]
    by = {r.doc_id: r for r in got if r.doc_id != 7}
    for (id, text), (_, after) in zip(order[1:6], order[2:], strict=True):
        half = len(text) // 2
        assert by[id].edited_sha256 == hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()


def test_one_row_and_empty_table(spark):
    one = spark.createDataFrame([(1, "abcd")], "doc_id bigint, text string")
    assert multiset.fingerprints(one).first().edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    assert multiset.fingerprints(one.limit(0)).count() == 0


def test_likeness_of_long_repetitive_texts():
    for many, few in ((100_000, 50_000), (70_000, 35_000), (40_000, 20_000)):
        got = multiset.likeness(multiset.vectors(["word " * many]), multiset.vectors(["word " * few]))[0]
        assert abs(got - 0.8) < 0.001
    line = "word " * 100_000
    assert multiset.changed(print_of("a b\n" + line), removed=[line]) == print_of("a b")


def parity(n, flip):
    """Digit sums of the binary numbers below n, modulo 2: a and b; or the other way round."""
    return "".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(n))


def test_sequences_that_meet_in_every_polynomial_hash_modulo_2_64():
    for n in (1024, 4096):
        assert print_of(parity(n, 0)) != print_of(parity(n, 1))
        assert print_of(" ".join(parity(n, 0))) != print_of(" ".join(parity(n, 1)))


def sums(text):
    """The lanes by their definition."""
    total = [0] * multiset.LANES
    for line in text.split("\n"):
        if line.strip(" \t\r\x0b\x0c"):
            digest = hashlib.blake2b(line.encode()).digest()
            for lane in range(multiset.LANES):
                total[lane] = (total[lane] + int.from_bytes(digest[8 * lane : 8 * lane + 8], "little")) % 2**64
    return total


def test_lanes_against_their_definition():
    rng = np.random.default_rng(8)
    texts = ["", " \n\t", *("".join(rng.choice(list("ab é\n\t"), int(n))) for n in rng.integers(1, 400, 60)), "x y\n" * 40_000]
    dense, wide = multiset.vectors(texts)
    assert dense.tolist() == [sums(t) for t in texts]
    shingles = [sum(max(1, len(p) - multiset.SHINGLE + 1) for p in (line.split() for line in t.split("\n")) if p) for t in texts]
    signed = wide.view(np.int32).astype(np.int64)
    assert all((s - n) % 2 == 0 and abs(s) <= n for s, n in zip(signed.sum(axis=1), shingles, strict=True))
    again = multiset.unpacked(multiset.packed(dense, wide))
    assert np.array_equal(again[0], dense) and np.array_equal(again[1], wide)
    assert {p[0] for p in multiset.packed_bytes(dense, wide)} == {1, 4}

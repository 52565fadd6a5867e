import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from gaugework.llm import repair
from gaugework.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(docs):
    ids = np.concatenate(docs).astype(np.uint32)
    starts = np.cumsum([0, *(len(d) for d in docs[:-1])])
    symbols, rules, places = repair.compress(ids, starts)
    assert (rules < repair.BASE + np.arange(len(rules))[:, None]).all() and len(rules) <= repair.RULES
    assert np.array_equal(repair.expand(symbols, rules), ids)
    full = np.concatenate([np.ones(repair.BASE, np.int64), repair.expansion_lengths(rules)])
    assert full[symbols].sum() == len(ids)
    block = {"places": places.astype("<u4").tobytes(), "symbols": symbols.astype("<u2").tobytes(), "rules": rules.astype("<u2").tobytes()}
    block["expansions"] = repair.expansion_lengths(rules).astype("<u4").tobytes()
    rng = random.Random(1)
    for n in rng.sample(range(len(docs)), min(40, len(docs))):
        assert np.array_equal(repair.decode(block, n), docs[n])
        a, b = sorted(rng.randint(0, len(docs[n])) for _ in range(2))
        assert np.array_equal(repair.decode(block, n, a, b), docs[n][a:b])
        assert np.array_equal(repair.decode(block, n, a), docs[n][a:])
    return len(symbols) / len(ids)


def test_round_trips():
    rng = np.random.default_rng(3)
    assert check([np.zeros(10_000, int)]) < 0.05  # one run of equal ids: halves each round
    check([np.array([5])])
    check([rng.integers(0, repair.BASE, n) for n in (1, 2, 3000)])
    phrase = rng.integers(0, 50_257, 40)
    assert check([np.concatenate([phrase, rng.integers(0, 9, 5)]) for _ in range(300)]) < 0.2
    check([np.array([1, 1]), np.array([1, 1, 1]), np.array([1])] * 50)


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.001"
    tokenizer = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    want, before = [], 0
    for r in docs:
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((r.doc_id, before, len(ids), zlib.crc32(ids.tobytes())))
        before += len(ids)
    got = QUERIES["op4_re_pair"](spark, sf)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_nulls_repeats_small_blocks_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_TOKENS", 50)
    long = "one two three " * 2000
    rows = [(3, "b c"), (None, "x"), (1, None), (1, None), (2, ""), (2, long), (2, long)]
    docs = spark.createDataFrame([(i, t, "s", 4) for i, t in rows], "doc_id bigint, text string, symbols string, part int")
    files, found = repair.round_trip(docs, PATH)
    got = found.join(repair.block_starts(files), ["part", "block"]).collect()
    got = sorted((r.before + r.start, r.doc_id, r.n_tokens) for r in got)
    assert [g[1] for g in got] == [None, 1, 1, 2, 2, 2, 3]
    at = 0
    for start, _, n in got:
        assert start == at
        at += n


def test_empty_table(spark):
    files, found = repair.round_trip(spark.createDataFrame([], "doc_id bigint, text string"), PATH)
    assert found.count() == 0 and repair.block_starts(files).count() == 0


def test_rounds_go_on_while_pairs_are_frequent(monkeypatch):
    assert check([np.zeros(100_000, int)]) < 0.001
    phrase = np.random.default_rng(5).permutation(50_000)[:1000]
    assert check([phrase] * 300) < 0.004
    monkeypatch.setattr(repair, "TABLE_BITS", 3)  # nearly all pairs are hidden by others
    ids = np.concatenate([phrase] * 20)
    symbols, rules, _ = repair.compress(ids, np.array([0]))
    pairs = np.stack([symbols[:-1], symbols[1:]])
    assert np.unique(pairs, axis=1, return_counts=True)[1].max() < repair.LEAST_COUNT
    assert np.array_equal(repair.expand(symbols, rules), ids)

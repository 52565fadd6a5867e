import random
import zlib
from collections import defaultdict
from math import ceil

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from gaugework.llm import bpe
from gaugework.llm.packing import Bins, pack, token_pieces
from gaugework.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def ids_of(raw):
    return np.frombuffer(raw, "<u4").tolist()


@pytest.mark.parametrize("chunks", [3, 100_000])
def test_chunks_give_the_ids_of_whole_texts(plain, chunks):
    coder = bpe.Encoder(PATH, chunks)
    rng = random.Random(chunks)
    parts = ["a", "Bc", "été", " ", "  ", "\n", " \n", " ", "1", "!", "'s", "é", "😀", "\t", "<|endoftext|>", "\x1c", "　", ".", ",", "²", "x" * 80]
    texts = [None, ""] + ["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(3000)]
    for at in range(0, len(texts), 100):
        some = texts[at : at + 100]
        assert [ids_of(x) for x in coder.ids(some)] == [plain(t) for t in some]


def check_packing(rows, capacity=2048):
    """No gap, no overlap, none over capacity; returns the number of sequences."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_query_on_documents(spark, plain):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op3_best_fit"](spark, sf).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert by.keys() == texts.keys()
    for doc, pieces in by.items():
        ids = [*plain(texts[doc]), 0]
        pieces.sort(key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(ceil(len(ids) / 2048)))
        assert all(r.length == 2048 for r in pieces[1:])
        assert [r.start for r in pieces] == np.cumsum([0, *(r.length for r in pieces[:-1])]).tolist()
        assert sum(r.length for r in pieces) == len(ids)
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    total = sum(r.length for r in rows)
    assert check_packing(rows) <= 1.02 * ceil(total / 2048) + 1


def test_bins_against_a_plain_search():
    rng = random.Random(3)
    for most in (1, 2, 5, 1000):
        bins, open_bins, made = Bins(50, most), {}, 0
        for _ in range(3000):
            n = rng.randint(1, 50)
            bin_, offset = bins.put(n)
            fits = [f for f in open_bins.values() if f >= n]
            free = min(fits) if fits else 50
            if fits:
                assert open_bins.pop(bin_) == free
            else:
                assert bin_ == made
                made += 1
            assert offset == 50 - free
            if free > n:
                if len(open_bins) == most:
                    fullest = min(open_bins.values())
                    still = {b for stack in bins.by_free for b in stack}
                    closed = [b for b in open_bins if b not in still]
                    assert [open_bins.pop(b) for b in closed] == [fullest]
                open_bins[bin_] = free - n
        assert len(open_bins) == bins.open <= most


def test_nulls_repeats_long_texts_and_clashing_columns(spark, plain):
    long = "word number one, " * 3000
    rows = [(1, None), (1, None), (2, ""), (None, "a b"), (3, long), (3, long)]
    docs = spark.createDataFrame([(i, t, "x", 7) for i, t in rows], "doc_id bigint, text string, ids string, piece int")
    pieces = token_pieces(docs, PATH, 64)
    found = pack(pieces, docs.count(), ["doc_id", "piece"], 64, open_bins=2).collect()
    assert sum(r.length for r in found) == sum(len(plain(t)) + 1 for _, t in rows)
    assert len([r for r in found if r.doc_id == 1]) == 2
    check_packing(found, 64)
    by = sorted(found, key=lambda r: (r.sequence_id, r.offset))
    assert sorted(x for r in by for x in ids_of(r.ids)) == sorted(x for _, t in rows for x in [*plain(t), 0])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert pack(token_pieces(docs, PATH), 0, ["doc_id", "piece"]).count() == 0


def test_special_tokens_as_by_the_library(spark):
    tokenizer = Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y <|endoftext|> <|endo ftext|> plain words", "plain words", "<|endoftext|> plain words"]
    wanted = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert wanted[0] == [64, 220, 50256, 275]
    coder = bpe.encoder(PATH)
    for _ in range(2):
        assert [ids_of(x) for x in coder.ids(texts)] == wanted
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: ids_of(r.ids) for r in token_pieces(docs, PATH).collect()}
    assert got == {i: [*w, 0] for i, w in enumerate(wanted)}


def test_long_texts_without_spaces_and_many_slices(plain, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE", 40)
    coder = bpe.Encoder(PATH)
    texts = ["x" * 5000, "Ab. " * 700, "line.\nNext line, and\n\nmore " * 50, "é" * 3000, " ", "\n", " a", "a ", "  ", None, "1 2\t3 \u00a0 x"]
    for _ in range(2):
        assert [ids_of(x) for x in coder.ids(texts)] == [plain(t) for t in texts]


def test_bounded_memory_gives_the_same_pieces(spark):
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(60)) for _ in range(40)] + [None, "", "x" * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    wanted = sorted(map(str, token_pieces(docs, PATH, 50).collect()))
    assert sorted(map(str, token_pieces(docs, PATH, 50, remembered=30, slice_bytes=200).collect())) == wanted
    coder = bpe.encoder(PATH, 30, 200)
    sizes = []
    for _ in coder.encode(pa.array(texts, pa.large_string())):
        sizes.append(coder.memory.strings)
    assert max(sizes) <= 30 and len(sizes) > 20
    assert bpe.encoder(PATH) is not coder and bpe.encoder(PATH).most == bpe.CHUNKS


def test_memory_of_strings():
    rng = np.random.default_rng(4)
    memory, known = bpe.Memory(), {}
    for _ in range(40):
        new = rng.integers(0, 2**64, (int(rng.integers(0, 90)), 2), np.uint64)
        ids = [rng.integers(0, 50_000, int(rng.integers(0, 6))).astype("<u4").tobytes() for _ in new]
        memory.add(new, *memory.put(ids))
        known |= {tuple(d): i for d, i in zip(new.tolist(), ids, strict=True)}
        asked = np.array([*known, (1, 2)], np.uint64)
        for (a, n), wanted in zip(zip(*memory.find(asked), strict=True), [*known.values(), None], strict=True):
            assert n == -1 if wanted is None else memory.flat[a : a + n].tobytes() == wanted
    assert memory.strings == len(known) and len(memory.runs) < 12


class _Watched:
    """A tokenizer that notes how many texts it encodes with its search for pieces and without."""

    def __init__(self, inner):
        self.__dict__.update(inner=inner, searched=0, ready=0)

    def __getattr__(self, name):
        return getattr(self.inner, name)

    def __setattr__(self, name, value):
        setattr(self.inner, name, value)

    def encode_batch_fast(self, texts, **more):
        size = sum(map(len, texts))
        self.__dict__["searched" if "ByteLevel" in repr(self.inner.pre_tokenizer) else "ready"] += size
        return self.inner.encode_batch_fast(texts, **more)


def test_words_of_letters_need_no_search_for_pieces():
    coder = bpe.Encoder(PATH, special_as_text=False)
    coder.tokenizer = _Watched(coder.tokenizer)
    plain = Tokenizer.from_file(PATH)
    texts = [
        "the " + " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(600)).replace("0", ""),
        "Ж Übergrößen élan naïve 日本語 مرحبا ǅ ª", "a x1 don't o'clock, b\nc d<|endoftext|> e", "",
    ]
    for text, ids in zip(texts, coder.ids(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert coder.tokenizer.ready > 4000 and coder.tokenizer.searched < 200
    assert "ByteLevel" in repr(coder.tokenizer.pre_tokenizer)


def test_every_letter_in_a_word_is_encoded_as_by_the_library():
    letters = [chr(c) for c in range(0x110000) if chr(c).isalpha()]
    texts = [" ".join(f"a{c}b {c}" for c in letters[i : i + 2000]) for i in range(0, len(letters), 2000)]
    plain = Tokenizer.from_file(PATH).encode_batch_fast(texts, add_special_tokens=False)
    got = bpe.Encoder(PATH, special_as_text=False).ids(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [e.ids for e in plain]


def test_batches_of_long_texts_end_early(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.range(40).coalesce(1).selectExpr("id AS doc_id", "repeat('ab ', 200000) AS text", "'en' AS lang", "'s' AS source")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    largest = lambda: max(r.n for r in docs.select("text").mapInArrow(sizes, "n long").collect())
    assert largest() > 20_000_000
    corpus_pipeline.packing(spark, docs.limit(0), "")
    assert largest() < 6_000_000

"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A fingerprint is the sum of one vector for each paragraph: LANES lanes modulo 2^64, the 64 bytes of a BLAKE2b digest of the
paragraph, and WIDTH lanes modulo 2^32 to which each word shingle of the paragraph adds or subtracts 1 at one place. Sums do
not depend on the order of paragraphs, and paragraphs can be added to or taken from a fingerprint without the rest of the
text. It is written as the number of bytes in which every wide lane fits (1, 2 or 4), the lanes, and the wide lanes in that
width, so equal sums are equal bytes; strings are base64 of them.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugework.llm.common import between, running, slices, stored, word_bounds
from gaugework.llm.words import word_codes, word_digests

LANES = 8
WIDTH = 256
SHINGLE = 3
_WORDS = 0xA24BAED4963EE407
_WORDS_INVERSE = pow(_WORDS, -1, 2**64)


def _slice_vectors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    docs = len(offsets) - 1
    starts, ends = word_bounds(data, offsets)
    breaks = np.flatnonzero(data == 10)
    line_starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    line_ends = np.sort(np.concatenate([offsets[1:], breaks]), kind="stable")
    first_word, last_word = np.searchsorted(starts, line_starts), np.searchsorted(starts, line_ends)
    full = last_word > first_word
    line_starts, line_ends, first_word, last_word = line_starts[full], line_ends[full], first_word[full], last_word[full]
    line_doc = np.searchsorted(offsets, line_starts, "right") - 1
    raw = data.tobytes()
    digest = hashlib.blake2b
    hashed = b"".join([digest(raw[a:b]).digest() for a, b in zip(line_starts.tolist(), line_ends.tolist(), strict=True)])
    total = np.zeros((len(line_starts) + 1, LANES), np.uint64)
    np.cumsum(np.frombuffer(hashed, "<u8").reshape(-1, LANES), axis=0, out=total[1:])
    edge = np.searchsorted(line_doc, np.arange(docs + 1))
    dense = total[edge[1:]] - total[edge[:-1]]

    codes, different = word_codes(data, starts, ends)
    words = running(word_digests(different)[codes, 0] if len(codes) else np.zeros(0, np.uint64), _WORDS)
    width = np.minimum(last_word - first_word, SHINGLE)
    per_line = last_word - first_word - width + 1
    line = np.repeat(np.arange(len(width)), per_line)
    at = np.arange(len(line)) - np.repeat(np.cumsum(per_line) - per_line, per_line) + first_word[line]
    shingle = between(words, at, at + width[line], _WORDS_INVERSE)
    place = line_doc[line] * WIDTH + (shingle & np.uint64(WIDTH - 1)).astype(np.int64)
    sign = 1.0 - 2.0 * ((shingle >> np.uint64(40)) & np.uint64(1))
    wide = np.bincount(place, sign, docs * WIDTH).astype(np.int64).astype(np.uint32)
    return dense, wide.reshape(docs, WIDTH)


def vectors(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(dense, wide) of each text; its paragraphs are its lines with a word."""
    parts = [_slice_vectors(*piece) for piece in slices(pa.array(texts, pa.large_string()))]
    if not parts:
        return np.zeros((0, LANES), np.uint64), np.zeros((0, WIDTH), np.uint32)
    return np.concatenate([d for d, _ in parts]), np.concatenate([w for _, w in parts])


def packed_bytes(dense: np.ndarray, wide: np.ndarray) -> list[bytes]:
    signed = wide.view(np.int32)
    most = np.maximum(signed, ~signed).max(axis=1, initial=0)
    head = np.ascontiguousarray(dense, "<u8").view(np.uint8)
    out: list[bytes] = [b""] * len(dense)
    for width, rows in ((1, most < 1 << 7), (2, (most >= 1 << 7) & (most < 1 << 15)), (4, most >= 1 << 15)):
        at = np.flatnonzero(rows)
        lanes = np.ascontiguousarray(signed[at].astype(f"<i{width}")).view(np.uint8)
        raw = np.concatenate([np.full((len(at), 1), width, np.uint8), head[at], lanes], axis=1)
        for i, r in zip(at.tolist(), raw, strict=True):
            out[i] = r.tobytes()
    return out


def packed(dense: np.ndarray, wide: np.ndarray) -> list[str]:
    return [base64.b64encode(r).decode() for r in packed_bytes(dense, wide)]


def unpacked(prints: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raws = [base64.b64decode(p) for p in prints]
    dense = np.array([np.frombuffer(r, "<u8", LANES, 1) for r in raws], np.uint64).reshape(-1, LANES)
    wide = np.array([np.frombuffer(r, f"<i{r[0]}", WIDTH, 1 + 8 * LANES) for r in raws], np.int32).reshape(-1, WIDTH)
    return dense, wide.view(np.uint32)


def changed(fingerprint: str, added: list[str] = (), removed: list[str] = ()) -> str:
    """The fingerprint after insertion and deletion of paragraphs, the other paragraphs unseen."""
    dense, wide = unpacked([fingerprint])
    for texts, sign in ((added, 1), (removed, -1)):
        d, w = vectors(list(texts))
        dense = dense + np.uint64(sign % 2**64) * d.sum(axis=0, dtype=np.uint64)
        wide = wide + np.uint32(sign % 2**32) * w.sum(axis=0, dtype=np.uint32)
    return packed(dense, wide)[0]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """0 to 1 for each pair: 1 for equal fingerprints, else the estimated share of common shingles (repeats count)."""
    x, y = a[1].astype(np.int32).astype(np.int64), b[1].astype(np.int32).astype(np.int64)
    apart = ((x - y).astype(np.float64) ** 2).sum(axis=1)
    whole = (x.astype(np.float64) ** 2).sum(axis=1) + (y.astype(np.float64) ** 2).sum(axis=1)
    same = (a[0] == b[0]).all(axis=1) & (a[1] == b[1]).all(axis=1)
    share = np.clip(1 - np.divide(apart, whole, out=np.ones_like(apart), where=whole > 0), 0, 1)
    return np.where(same, 1.0, share)


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many (or all) of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


NAMES = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
FIELDS = "n_chars bigint, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _measured(texts: list[str]) -> list[pa.Array]:
    """Columns of NAMES for all texts but the last, which only follows."""
    changes = [edited(a, b) for a, b in zip(texts[:-1], texts[1:], strict=True)]
    dense, wide = vectors(texts)
    new = vectors(changes)
    own = dense[:-1], wide[:-1]
    return [
        pa.array([len(t) for t in texts[:-1]], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).digest() for t in changes], pa.binary()),
        pa.array(packed_bytes(*own), pa.binary()),
        pa.array(packed_bytes(*new), pa.binary()),
        pa.array(likeness(own, new)),
        pa.array(likeness(own, (dense[1:], wide[1:]))),
    ]


ROWS_AT_ONCE = 256


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Finished rows; the first text of the part (role 1) and its last row (role 2), which lacks the text that follows."""
    part = TaskContext.get().partitionId()
    waiting: tuple[pa.Array, str] | None = None
    names = ["role", "part", "id", "text", *NAMES]

    def open_row(role: int, id: pa.Array, text: str) -> pa.RecordBatch:
        empty = [pa.nulls(1, t) for t in (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64())]
        return pa.RecordBatch.from_arrays([pa.array([role], pa.int32()), pa.array([part], pa.int32()), id, pa.array([text], pa.string()), *empty], names)

    for batch in batches:
        for at in range(0, len(batch), ROWS_AT_ONCE):
            some = batch.slice(at, ROWS_AT_ONCE)
            ids, texts = some.column(0), [t or "" for t in some.column(1).to_pylist()]
            if waiting is None:
                yield open_row(1, ids.slice(0, 1), texts[0])
            else:
                ids, texts = pa.concat_arrays([waiting[0], ids]), [waiting[1], *texts]
            waiting = ids.slice(len(ids) - 1), texts[-1]
            n = len(texts) - 1
            if n:
                same = [pa.array([0] * n, pa.int32()), pa.array([part] * n, pa.int32()), ids.slice(0, n), pa.nulls(n, pa.string())]
                yield pa.RecordBatch.from_arrays([*same, *_measured(texts)], names)
    if waiting is not None:
        yield open_row(2, *waiting)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(len(batch)):
            row = batch.slice(i, 1)
            pair = [row.column(1)[0].as_py() or "", row.column(2)[0].as_py() or ""]
            yield pa.RecordBatch.from_arrays([row.column(0), *_measured(pair)], ["id", *NAMES])


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every document.

    The edited text takes its end from the next document in descending order of id; after the last comes the first. The
    texts are shuffled once, into ranges of ids; each task goes along its range, and only the first and the last text of
    each range meet in a second step, joined by range. Null and empty texts have no characters and the fingerprint of no
    paragraph; null ids come last; rows with equal ids follow each other in the order of their texts' hashes, then texts.
    Other columns are left out. An empty table gives an empty table; a single document follows itself. Memory follows the
    longest text.
    """
    kind = docs.schema[id].dataType.simpleString()
    narrow = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    order = [F.col("id").desc_nulls_last(), F.xxhash64("text"), F.col("text")]
    dealt = narrow.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    rows = stored(dealt.mapInArrow(_along, f"role int, part int, id {kind}, text string, {FIELDS}"), "fingerprints")
    heads = rows.filter("role = 1").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))
    # numbers of the parts only, one for each range of the shuffle
    parts = rows.filter("role = 1").select("part")
    follows = Window.orderBy("part")
    order_of = parts.select("part", F.lead("part").over(follows).alias("after"), F.first("part").over(follows).alias("top"))
    order_of = order_of.select("part", F.coalesce("after", "top").alias("next_part"))
    tails = rows.filter("role = 2").select("part", "id", "text").join(order_of, "part").join(heads, "next_part")
    last = tails.select("id", "text", "next_text").mapInArrow(_joined, f"id {kind}, {FIELDS}")
    found = rows.filter("role = 0").select("id", *NAMES).unionByName(last)
    text_of = {name: F.translate(F.base64(name), "\r\n", "") for name in ("fingerprint", "edited_fingerprint")}
    text_of["edited_sha256"] = F.lower(F.hex("edited_sha256"))
    return found.withColumns(text_of).withColumnRenamed("id", id)

"""Exact removal of repeated byte strings: content-defined runs of windows, settled by digests and by suffix arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.llm.common import between, byte_sums, mix, running, slices, stored

LENGTH = 200
GRAM = 40
#: Contexts with one string that are sorted in one array; where there are more, their windows are counted by digests.
MOST_CONTEXTS = 8192
SORT_BYTES = 1 << 20
_PLACE_BITS = 28


def window_runs(data: np.ndarray, offsets: np.ndarray, sums: np.ndarray, length: int, gram: int) -> dict[str, np.ndarray]:
    """Runs of consecutive windows of `length` bytes that share their smallest `gram`-byte string.

    Which string is smallest depends on the window alone, so equal windows anywhere have equal strings at equal places.
    For each run: doc, start of its first window in the doc, count of windows, place of the string after that start,
    `gram` hash, and hash of all the bytes of the run with that place.
    """
    n, span = len(data) - gram + 1, length - gram + 1
    empty = {k: np.zeros(0, np.uint64 if k in ("gram", "bytes") else np.int64) for k in ("doc", "start", "count", "place", "gram", "bytes")}
    if n < span:
        return empty
    at = np.arange(n)
    grams = between(sums, at, at + gram)
    keys = (grams >> np.uint64(_PLACE_BITS)) << np.uint64(_PLACE_BITS) | at.astype(np.uint64)
    padded = np.full(-(-n // span) * span, np.uint64(2**64 - 1))
    padded[:n] = keys
    blocks = padded.reshape(-1, span)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - span + 1
    lowest = np.minimum(right[:windows], left[span - 1 : span - 1 + windows])
    doc = np.searchsorted(offsets, np.arange(windows), "right") - 1
    whole = np.arange(windows) + length <= offsets[doc + 1]
    start = np.flatnonzero(whole)
    if not len(start):
        return empty
    place = (lowest[start] & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)]))
    count = np.diff(np.append(first, len(start)))
    begin, at = start[first], place[first]
    doc = doc[begin]
    return {
        "doc": doc,
        "start": begin - offsets[doc],
        "count": count,
        "place": at - begin,
        "gram": grams[at],
        "bytes": mix(between(sums, begin, begin + count + length - 1) + (at - begin).astype(np.uint64)),
    }


def _words(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes at each place as one number that orders like them."""
    view = np.ndarray((len(text) - 7,), ">u8", text.data, strides=(1,))
    return view[at].astype(np.uint64)


def _direct_sort(text: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """Places ordered by the `length` bytes that follow, eight at a time; only ties are looked at again."""
    order = places[np.argsort(_words(text, places), kind="stable")]
    key = _words(text, order)
    group = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
    for depth in range(8, length, 8):
        tied = np.zeros(len(order), bool)
        tied[1:] = group[1:] == group[:-1]
        tied[:-1] |= tied[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        key = _words(text, order[at] + depth)
        turn = np.lexsort((key, group[at]))
        order[at], key, own = order[at][turn], key[turn], group[at]
        new = np.zeros(len(order), np.int64)
        new[at[1:]] = (key[1:] != key[:-1]) & (own[1:] == own[:-1])
        group = group + np.cumsum(new)
    return order


def suffix_order(text: np.ndarray, wanted: np.ndarray, length: int) -> np.ndarray:
    """The wanted places in the order of their suffixes (to `length` bytes): two-stage sorting.

    text: bytes that end in `length` + 8 zeros and eight times 255. A suffix is small if it is smaller than its successor. Only small
    suffixes are sorted directly; each other suffix is put in its place by scanning the buckets of equal first bytes from
    the lowest, since its successor is smaller and comes before it. wanted: a mask; where it ends on a large suffix it is
    carried on to the next small one.
    """
    n = len(text)
    differs = np.flatnonzero(text[1:] != text[:-1])
    following = differs[np.minimum(np.searchsorted(differs, np.arange(n)), len(differs) - 1)]
    small = text[np.minimum(following + 1, n - 1)] > text
    edge = np.flatnonzero(wanted[:-1] & ~wanted[1:])
    smalls = np.flatnonzero(small)
    needed = wanted.copy()
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, edge, 1)
    np.add.at(step, smalls[np.searchsorted(smalls, edge)] + 1, -1)
    needed |= np.cumsum(step)[:n] > 0
    sorted_small = _direct_sort(text, np.flatnonzero(needed & small), length)
    large = needed & ~small
    bounds = np.searchsorted(text[sorted_small], np.arange(257))
    queues: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []

    def induce(scanned: np.ndarray, byte: int) -> np.ndarray:
        """Puts large predecessors into their buckets; returns those of the bucket that is being scanned."""
        before = scanned[scanned > 0] - 1
        before = before[large[before]]
        if not len(before):
            return before
        first = text[before]
        turn = np.argsort(first, kind="stable")
        before, first = before[turn], first[turn]
        cut = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]])).tolist()
        own = before[:0]
        for a, b in zip(cut, [*cut[1:], len(first)], strict=True):
            if first[a] == byte:
                own = before[a:b]
            else:
                queues[first[a]].append(before[a:b])
        return own

    for byte in range(256):
        wave = np.concatenate(queues[byte]) if queues[byte] else np.zeros(0, np.int64)
        while len(wave):
            out.append(wave)
            wave = induce(wave, byte)
        lower = sorted_small[bounds[byte] : bounds[byte + 1]]
        if len(lower):
            out.append(lower)
            induce(lower, byte)
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    return order[wanted[order]]


def repeated_starts(contexts: list[bytes], length: int) -> list[np.ndarray]:
    """For each byte string, which of its windows of `length` bytes also start anywhere else in the strings."""
    sizes = np.array([len(c) for c in contexts])
    # UTF-8 has no byte above 244: one more leaves 0 for the ends
    parts = [x for c in contexts for x in (np.frombuffer(c, np.uint8) + np.uint8(1), np.zeros(1, np.uint8))]
    text = np.concatenate([*parts, np.zeros(length + 8, np.uint8), np.full(8, 255, np.uint8)])
    first = np.cumsum(sizes + 1) - sizes - 1
    counts = np.maximum(sizes - length + 1, 0)
    step = np.zeros(len(text) + 1, np.int64)
    np.add.at(step, first, 1)
    np.add.at(step, first + counts, -1)
    wanted = np.cumsum(step)[: len(text)] > 0
    order = suffix_order(text, wanted, length)
    same = np.arange(max(len(order) - 1, 0))
    for depth in range(0, length, 8):  # common prefixes of neighbours, as far as `length`
        same = same[_words(text, order[same] + depth) == _words(text, order[same + 1] + depth)]
    found = np.zeros(len(text), bool)
    found[order[same]] = found[order[same + 1]] = True
    return [found[f : f + c] for f, c in zip(first, counts, strict=True)]


# A run is packed into one long: start, count of windows, place of its smallest string.
def _pack(start: np.ndarray, count: np.ndarray, place: np.ndarray) -> np.ndarray:
    return start << 20 | count << 10 | place


def _start(run: int) -> int:
    return run >> 20


def _count(run: int) -> int:
    return run >> 10 & 1023


def _runs(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digest, at = batch.column(0).to_numpy(), 0
            for data, offsets in slices(batch.column(1)):
                r = window_runs(data, offsets, byte_sums(data), length, gram)
                packed = _pack(r["start"], r["count"], r["place"])
                columns = [r["gram"].view(np.int64), r["bytes"].view(np.int64), digest[at + r["doc"]], packed]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gram", "bytes", "d", "run"])
                at += len(offsets) - 1

    return run


def _contexts(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(len(batch)):
                raw, d = (batch.column("text")[n].as_py() or "").encode(), batch.column("d")[n].as_py()
                wanted = batch.column("runs")[n].as_py()
                cut = [raw[_start(x["run"]) : _start(x["run"]) + _count(x["run"]) + length - 1] for x in wanted]
                columns = [pa.array([x[k] for x in wanted], pa.int64()) for k in ("gram", "run", "contexts")]
                yield pa.RecordBatch.from_arrays(
                    [columns[0], pa.array([d] * len(wanted), pa.int64()), *columns[1:], pa.array(cut, pa.binary())],
                    ["gram", "d", "run", "contexts", "context"],
                )

    return run


def _intervals(found: np.ndarray, start: int, length: int) -> tuple[list[int], list[int]]:
    """Bytes covered by the found windows of a run."""
    change = np.flatnonzero(np.diff(np.concatenate([[False], found, [False]])))
    return (change[::2] + start).tolist(), (change[1::2] + start + length - 1).tolist()


def _sorted_marks(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, int, bytes]] = []

        def marks() -> pa.RecordBatch:
            ds, los, his = [], [], []
            for (_, d, run_, _), found in zip(rows, repeated_starts([r[3] for r in rows], length), strict=True):
                if found.any():
                    lo, hi = _intervals(found, _start(run_), length)
                    ds += [d] * len(lo)
                    los += lo
                    his += hi
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (ds, los, his)], ["d", "lo", "hi"])

        size = 0
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in ("gram", "d", "run", "context")), strict=True):
                if rows and row[0] != rows[-1][0] and size >= SORT_BYTES:
                    yield marks()
                    rows, size = [], 0
                if rows and row[:3] == rows[-1][:3]:
                    continue  # the same place, from a repeated row
                rows.append(row)
                size += len(row[3])
        if rows:
            yield marks()

    return run


_SECOND = 0xC2B2AE3D27D4EB4F
_SECOND_INVERSE = pow(_SECOND, -1, 2**64)


def _windows(length: int):
    """Two digests of every window of the contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, run_, context in zip(*(batch.column(n).to_pylist() for n in ("d", "run", "context")), strict=True):
                data = np.frombuffer(context, np.uint8)
                at = np.arange(len(data) - length + 1)
                one = between(byte_sums(data), at, at + length)
                two = between(running(data.astype(np.uint64) + np.uint64(7), _SECOND), at, at + length, _SECOND_INVERSE)
                columns = [one.view(np.int64), two.view(np.int64), np.full(len(at), d), at + _start(run_)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["one", "two", "d", "lo"])

    return run


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, spans, kept = [], [], [], []
            for text, many, marks in zip(*(batch.column(n).to_pylist() for n in ("text", "many", "marks")), strict=True):
                raw = (text or "").encode()
                merged: list[list[int]] = []
                if many and len(raw) >= length:
                    merged = [[0, len(raw)]]
                elif marks and not many:
                    for lo, hi in sorted((x["lo"], x["hi"]) for x in marks):
                        if merged and lo <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], hi)
                        else:
                            merged.append([lo, hi])
                edges = [0, *(x for span in merged for x in span), len(raw)]
                sizes.append(len(raw))
                removed.append(sum(b - a for a, b in merged))
                spans.append(len(merged))
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            counts = [pa.array(x, pa.int64()) for x in (sizes, removed, spans)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *counts, pa.array(kept, pa.binary())], ["id", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) of every document: its UTF-8 bytes without those that stand in a string of
    `length` bytes which also starts anywhere else, in the same document or another.

    Windows are gathered into runs by their smallest `gram`-byte string; a window can only repeat where that string does.
    A run whose bytes all occur again is settled by its digest. The others, and one of each kind of run with the same
    string, are put into suffix arrays, a group of runs with one string always together; above MOST_CONTEXTS different
    runs the windows themselves are counted by two digests, before the shuffle. Texts that occur more than once go whole.
    A text is known by a 64-bit digest. Null and empty texts have no bytes; rows with equal texts have equal results
    whatever their ids; other columns are left out. `kept` is bytes, as a cut can split a character. Memory follows the
    longest text and MOST_CONTEXTS runs.
    """
    if length % 8 or not 0 < gram <= length:
        raise ValueError("length must be a multiple of 8, and no less than the string's")
    kind = docs.schema[id].dataType.simpleString()
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    base = docs.select(F.col(f"`{id}`").alias("id"), t.alias("text"), F.xxhash64(t).alias("d"))
    copies = stored(base.groupBy("d").agg(F.count("*").alias("n"), F.min("id").alias("keep")), "copies")
    runs = stored(base.select("d", "text").mapInArrow(_runs(length, gram), "gram bigint, bytes bigint, d bigint, run bigint"), "runs")
    # stored, so that the joins are between plain tables, whose skewed keys adaptive execution splits
    again = stored(runs.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram"), "again")
    rep = stored(runs.join(again, "gram"), "repeated")
    kinds = stored(rep.groupBy("gram", "bytes").agg(F.count("*").alias("n"), F.min(F.struct("d", "run")).alias("one")), "kinds")
    settled = rep.join(kinds.filter("n > 1").select("gram", "bytes"), ["gram", "bytes"])
    whole = settled.select("d", F.shiftright("run", 20).alias("lo"), (F.shiftright("run", 20) + F.shiftright("run", 10).bitwiseAND(F.lit(1023)) + length - 1).alias("hi"))

    open_ = kinds.groupBy("gram").agg(F.count("*").alias("contexts"), F.min("n").alias("least"))
    open_ = stored(open_.filter("contexts > 1 and least = 1"), "open")
    wanted = kinds.join(open_.select("gram", "contexts"), "gram").select("one.d", F.struct("gram", "one.run", "contexts").alias("r"))
    wanted = wanted.groupBy("d").agg(F.collect_list("r").alias("runs")).join(copies.select("d", "keep"), "d")
    texts = base.join(wanted, "d").filter(F.col("id").eqNullSafe(F.col("keep"))).select("text", "d", "runs")
    contexts = texts.mapInArrow(_contexts(length), "gram bigint, d bigint, run bigint, contexts bigint, context binary")
    contexts = stored(contexts, "contexts")
    small = contexts.filter(F.col("contexts") <= MOST_CONTEXTS).repartition("gram").sortWithinPartitions("gram", "d", "run")
    sorted_ = small.mapInArrow(_sorted_marks(length), "d bigint, lo bigint, hi bigint")
    large = contexts.filter(F.col("contexts") > MOST_CONTEXTS).dropDuplicates(["gram", "d", "run"])
    windows = large.mapInArrow(_windows(length), "one bigint, two bigint, d bigint, lo bigint")
    twice = windows.groupBy("one", "two").agg(F.count("*").alias("n")).filter("n > 1").select("one", "two")
    counted = windows.join(twice, ["one", "two"]).select("d", "lo", (F.col("lo") + length).alias("hi"))

    marks = whole.unionByName(sorted_).unionByName(counted).groupBy("d").agg(F.collect_set(F.struct("lo", "hi")).alias("marks"))
    side = stored(marks.join(copies.filter("n > 1").select("d", F.lit(True).alias("many")), "d", "full"), "marks")
    found = base.join(side, "d", "left").select("id", "text", F.coalesce("many", F.lit(False)).alias("many"), "marks")
    out = found.mapInArrow(_cut(length), f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    return out.withColumnRenamed("id", id)

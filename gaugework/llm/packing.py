"""Packing of documents into token sequences: bounded-space online best fit."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.llm.bpe import CHUNKS, SLICE, encoder

CAPACITY = 2048
OPEN_BINS = 4096
PIECES_PER_TASK = 50_000


def _cut(path: str, capacity: int, end_id: int, remembered: int, slice_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, remembered, slice_bytes)
        for batch in batches:
            at = 0
            for ids, offsets in coder.encode(batch.column(1), end_id):
                n = np.diff(offsets)
                first = (n - 1) % capacity + 1
                pieces = (n - first) // capacity + 1
                row = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = np.where(piece > 0, first[row] + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, first[row])
                places = np.append(offsets[:-1][row] + start, offsets[-1]) * 4
                raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(places), pa.py_buffer(ids.astype("<u4"))])
                columns = [batch.column(0).take(pa.array(at + row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), raw.cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "piece", "start", "length", "ids"])
                at += len(n)

    return run


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, id: str = "doc_id", text: str = "text",
    remembered: int = CHUNKS, slice_bytes: int = SLICE,
) -> DataFrame:
    """Pieces of at most `capacity` tokens: id, piece, start, length, ids (little-endian unsigned 32-bit).

    A document is the ids of its whole text and `end_id`; a null or empty text is the end id alone. Only longer documents
    are cut, so that all pieces but the first are full. Repeated rows give their pieces again; other columns are left out.
    A worker keeps the ids of up to `remembered` words and works on `slice_bytes` of texts at once, or on one longer text;
    less of either takes less memory and more time for the same pieces.
    """
    kind = docs.schema[id].dataType.simpleString()
    narrow = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    pieces = narrow.mapInArrow(_cut(tokenizer, capacity, end_id, remembered, slice_bytes), f"id {kind}, piece int, start bigint, length bigint, ids binary")
    return pieces.withColumnRenamed("id", id)


class Bins:
    """A fixed number of open bins; one bit for each free space that some open bin has."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.bits, self.open, self.made = 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        found = bins.pop()
        if not bins:
            self.bits ^= 1 << free
        self.open -= 1
        return found

    def put(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece: the open bin with the least sufficient space, else a new one. The fullest bin closes
        when there would be too many."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            found = self._take(free)
        else:
            free, found = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            if self.open == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
            if not self.by_free[left]:
                self.bits |= 1 << left
            self.by_free[left].append(found)
            self.open += 1
        return found, self.capacity - free


def _pack(capacity: int, most: int, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Bins(capacity, most)
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            if not len(batch):
                continue
            lengths = batch.column(at).to_pylist()
            if min(lengths) < 1 or max(lengths) > capacity:
                raise ValueError(f"pieces have 1 to {capacity} tokens")
            longest_first = np.argsort(-np.array(lengths), kind="stable")
            places = np.empty((len(lengths), 2), np.int64)
            for i in longest_first:
                places[i] = bins.put(lengths[i])
            more = [pa.array(base + places[:, 0]), pa.array(places[:, 1])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "sequence_id", "offset"])

    return run


def pack(pieces: DataFrame, rows: int, order: list[str], capacity: int = CAPACITY, open_bins: int = OPEN_BINS, length: str = "length") -> DataFrame:
    """The pieces with `sequence_id` and `offset`: no sequence over `capacity` tokens, no gap in front of a piece.

    `rows` is the number of pieces. They are dealt by a hash of all columns of `order` to one task for each PIECES_PER_TASK of
    them and come in that order, so that a repeated task packs alike. Each task leaves at most `open_bins` sequences unfilled. The
    bins are filled online, piece by piece but for one look-ahead: of the pieces in one Arrow batch
    (`spark.sql.execution.arrow.maxRecordsPerBatch`) the longest go first. A task holds one batch and its open bins. All
    columns of the pieces move with them: leave out what isn't needed. Rows that tie in `order` are dealt to one task and
    take places in turn.
    """
    tasks = max(1, ceil(rows / PIECES_PER_TASK))
    dealt = pieces.repartition(tasks, *order).sortWithinPartitions(*order)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return dealt.mapInArrow(_pack(capacity, open_bins, pieces.columns.index(length)), f"{fields}, sequence_id bigint, offset bigint")

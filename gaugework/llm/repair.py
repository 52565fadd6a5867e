"""Token-id files: grammar-compressed blocks of documents, each document decodable alone.

A block is one row of a Parquet table. Its documents follow each other in `symbols` (little-endian unsigned 16-bit), whose
values below BASE are token ids and above it rules; `rules` has the two symbols of each rule, `expansions` its number of
ids (unsigned 32-bit), `places` the first symbol of each document and `counts` its number of ids (both unsigned 32-bit).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugework.llm.bpe import encoder
from gaugework.session import scratch_path

BASE = 50_304  # no id of the vocabulary is as large
RULES = (1 << 16) - BASE
ROUNDS = 6  # a round makes at most this part of all rules
LEAST_COUNT = 8
BLOCK_TOKENS = 1 << 20
TABLE_BITS = 17
NONE = np.int32(2**31 - 1)
_SYMBOL, _FIRST, _LIVE = np.uint32(0xFFFF), np.uint32(1 << 16), np.uint32(1 << 17)


def _frequent(pairs: np.ndarray) -> np.ndarray:
    """The pairs that are frequent, counted exactly: falling by count, rising by pair."""
    ordered = np.sort(pairs)
    edge = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1, [len(ordered)]])
    counts = np.diff(edge)
    often = np.flatnonzero(counts >= LEAST_COUNT)
    # the pairs are in order, so a stable sort by count leaves them so
    return ordered[edge[often[np.argsort(-counts[often], kind="stable")]]]


def _ranks(pairs: np.ndarray, often: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(frequent pairs that have a slot of their own, rank among them at each place or NONE, whether the pair may be frequent).

    Pairs are looked up by a hash, in every turn another. Of two frequent pairs with one slot the less frequent waits for a
    later turn.
    """
    salt = np.uint32((0x9E3779B1 * (2 * turn + 1)) % 2**32)
    shift = np.uint32(32 - TABLE_BITS)
    slot = (often * salt) >> shift
    rank = np.full(1 << TABLE_BITS, NONE)
    rank[slot[::-1]] = np.arange(len(often) - 1, -1, -1, dtype=np.int32)
    own = np.flatnonzero(rank[slot] == np.arange(len(often)))
    often, slot = often[own], slot[own]
    rank[slot] = np.arange(len(own), dtype=np.int32)
    found = rank[(pairs * salt) >> shift]
    maybe = found != NONE
    found[maybe] = np.where(often[found[maybe]] == pairs[maybe], found[maybe], NONE)
    return often, found, maybe


def compress(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, rules, first symbol of each document) of a block: frequent pairs become rules, round by round,
    until no pair is frequent or the rules run out.

    No pair crosses from one document to the next. In a round many pairs are replaced at once: where two would overlap,
    the more frequent one is, and in a run of equal pairs every other one. A pair that is not frequent can only become so
    beside a new symbol, so each round counts the places that were frequent and those beside what the last one replaced.
    """
    # one number for each place: its symbol, whether it is the first of a document, whether its pair may be frequent
    places = ids.astype(np.uint32) | _LIVE
    places[starts] |= _FIRST
    rules: list[np.ndarray] = []
    made = turn = 0
    while len(places) > 1 and made < RULES:
        at = np.flatnonzero(places[:-1] & _LIVE)
        one, two = places[at], places[at + 1]
        inside = (two & _FIRST) == 0
        at, pairs = at[inside], ((one & _SYMBOL) << np.uint32(16) | (two & _SYMBOL))[inside]
        often = _frequent(pairs)
        if not len(often):
            break
        often, rank, maybe = _ranks(pairs, often, turn)
        chosen = often[: min(RULES - made, -(-RULES // ROUNDS))]
        turn += 1
        places[at[~maybe]] &= ~_LIVE
        some = np.flatnonzero(rank < len(chosen))
        at, own = at[some], rank[some]
        beside = at[1:] == at[:-1] + 1
        before, after = np.full(len(at), NONE), np.full(len(at), NONE)
        before[1:][beside], after[:-1][beside] = own[:-1][beside], own[1:][beside]
        place = np.arange(len(at), dtype=np.int32)
        even = (place - np.maximum.accumulate(np.where(own != before, place, 0))) % 2 == 0
        taken = even & (own <= before) & (own <= after)
        at, own = at[taken], own[taken]
        places[at] = (places[at] & _FIRST) | _LIVE | (BASE + made + own).astype(np.uint32)
        places[at - 1] |= _LIVE
        keep = np.ones(len(places), bool)
        keep[at + 1] = False
        places = places[keep]
        rules.append(np.stack([chosen >> np.uint32(16), chosen & _SYMBOL], axis=1))
        made += len(chosen)
    return places & _SYMBOL, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32), np.flatnonzero(places & _FIRST)


def expansion_lengths(rules: np.ndarray) -> np.ndarray:
    """Ids that each rule stands for. A rule refers to earlier rules only."""
    length = np.ones(len(rules), np.int64)
    while True:
        full = np.concatenate([np.ones(BASE, np.int64), length])
        new = full[rules[:, 0]] + full[rules[:, 1]]
        if np.array_equal(new, length):
            return length
        length = new


def expansions_of(rules: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all symbols one behind the other, first of each): BASE ids for themselves, then what the rules stand for.

    The rules are filled in by their depth, each from the two symbols it refers to.
    """
    size = np.concatenate([np.ones(BASE, np.int64), lengths])
    place = np.cumsum(size) - size
    flat = np.empty(int(size.sum()), np.uint32)
    flat[:BASE] = np.arange(BASE)
    depth = np.zeros(len(size), np.int64)
    while len(rules):
        new = np.maximum(depth[rules[:, 0]], depth[rules[:, 1]]) + 1
        if np.array_equal(new, depth[BASE:]):
            break
        depth[BASE:] = new
    for level in range(1, int(depth.max(initial=0)) + 1):
        some = np.flatnonzero(depth == level)
        for side in (0, 1):
            part = rules[some - BASE, side]
            to = place[some] + (size[rules[some - BASE, 0]] if side else 0)
            step = np.arange(int(size[part].sum())) - np.repeat(np.cumsum(size[part]) - size[part], size[part])
            flat[np.repeat(to, size[part]) + step] = flat[np.repeat(place[part], size[part]) + step]
    return flat, place


def expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray | None = None) -> np.ndarray:
    """Token ids of any stretch of symbols, such as those of one document."""
    lengths = expansion_lengths(rules) if lengths is None else lengths
    flat, place = expansions_of(rules, lengths)
    size = np.concatenate([np.ones(BASE, np.int64), lengths])[symbols]
    before = np.cumsum(size) - size
    return flat[np.repeat(place[symbols] - before, size) + np.arange(int(size.sum()))]


def decode(block: dict, n: int, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids `start` to `stop` (or the end) of the n-th document of a block read from a file.

    The stored expansion lengths of the document's symbols tell which of them the range lies in; only those are expanded.
    """
    places = np.frombuffer(block["places"], "<u4")
    rules = np.frombuffer(block["rules"], "<u2").reshape(-1, 2)
    lengths = np.frombuffer(block["expansions"], "<u4").astype(np.int64)
    symbols = np.frombuffer(block["symbols"], "<u2")[places[n] : places[n + 1] if n + 1 < len(places) else None]
    ends = np.cumsum(np.concatenate([np.ones(BASE, np.int64), lengths])[symbols])
    total = int(ends[-1]) if len(ends) else 0
    start, stop, _ = slice(start, stop).indices(total)
    if start >= stop:
        return np.zeros(0, np.uint32)
    a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop)
    before = int(ends[a - 1]) if a else 0
    part = symbols[a : b + 1]
    # rules refer to earlier rules only, so those behind the largest one are not needed
    used = max(int(part.max()) - BASE + 1, 0)
    return expand(part, rules[:used], lengths[:used])[start - before : stop - before]


FIELDS = "part int, block int, n_ids bigint, ids array<{}>, counts binary, places binary, rules binary, expansions binary, symbols binary"


def _write(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        part, made = TaskContext.get().partitionId(), 0
        names: list[pa.Array] = []
        parts: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        held = 0

        def block() -> pa.RecordBatch:
            counts = np.concatenate(sizes)
            ids = np.concatenate(parts)
            if len(ids) and int(ids.max()) >= BASE:
                raise ValueError(f"the file format holds ids below {BASE}")
            symbols, rules, places = compress(ids, np.cumsum(counts) - counts)
            blobs = [counts.astype("<u4"), places.astype("<u4"), rules.astype("<u2"), expansion_lengths(rules).astype("<u4"), symbols.astype("<u2")]
            all_names = pa.concat_arrays(names)
            column = pa.ListArray.from_arrays(pa.array([0, len(all_names)], pa.int32()), all_names)
            row = [pa.array([part], pa.int32()), pa.array([made], pa.int32()), pa.array([len(ids)], pa.int64()), column]
            row += [pa.array([b.tobytes()], pa.binary()) for b in blobs]
            return pa.RecordBatch.from_arrays(row, ["part", "block", "n_ids", "ids", "counts", "places", "rules", "expansions", "symbols"])

        for batch in batches:
            row = 0
            for ids, offsets in coder.encode(batch.column(1), end_id):
                docs, at = len(offsets) - 1, 0
                while at < docs:
                    # as many documents as complete the block
                    stop = min(int(np.searchsorted(offsets, offsets[at] + BLOCK_TOKENS - held)), docs)
                    stop = max(stop, at + 1)
                    names.append(batch.column(0).slice(row + at, stop - at))
                    parts.append(ids[offsets[at] : offsets[stop]])
                    sizes.append(np.diff(offsets[at : stop + 1]))
                    held += int(offsets[stop] - offsets[at])
                    at = stop
                    if held >= BLOCK_TOKENS:
                        yield block()
                        made += 1
                        names.clear(), parts.clear(), sizes.clear()
                        held = 0
                row += docs
        if names:
            yield block()

    return run


def write_ids(docs: DataFrame, tokenizer: str, path: str, end_id: int = 2, id: str = "doc_id", text: str = "text") -> None:
    """Writes the ids of every whole text, each with `end_id` behind it, in ascending order of the id column.

    Null and empty texts are the end id alone; null ids come first; rows with equal ids follow each other in the order of
    their texts' hashes and may stand in several parts. A part is the range of ids of one task, and its blocks count up
    within it. Blocks hold BLOCK_TOKENS ids or one longer document; memory follows that.
    """
    kind = docs.schema[id].dataType.simpleString()
    narrow = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    order = ["id", F.xxhash64("text")]
    dealt = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.mapInArrow(_write(tokenizer, end_id), FIELDS.format(kind)).write.parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for n in range(len(batch)):
            row = batch.slice(n, 1)
            names = row.column("ids").flatten()
            blob = lambda name, kind: np.frombuffer(row.column(name)[0].as_buffer(), kind)  # noqa: E731, B023
            counts = blob("counts", "<u4").astype(np.int64)
            rules = blob("rules", "<u2").reshape(-1, 2)
            ids = expand(blob("symbols", "<u2"), rules, blob("expansions", "<u4").astype(np.int64))
            ends = np.concatenate([[0], np.cumsum(counts)])
            texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(4 * ends), pa.py_buffer(ids.astype("<u4"))])
            same = lambda name, kind: pa.array([row.column(name)[0].as_py()] * len(names), kind)  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays(
                [same("part", pa.int32()), same("block", pa.int32()), names, pa.array(ends[:-1]), pa.array(counts), texts.cast(pa.binary())],
                ["part", "block", "id", "start", "n_tokens", "ids"],
            )


def read_ids(files: DataFrame, id: str = "doc_id") -> DataFrame:
    """Documents of the files: id, part, block, start (ids before it in its block), n_tokens, ids (unsigned 32-bit)."""
    kind = files.schema["ids"].dataType.elementType.simpleString()
    found = files.mapInArrow(_read, f"part int, block int, id {kind}, start bigint, n_tokens bigint, ids binary")
    return found.withColumnRenamed("id", id)


def block_starts(files: DataFrame) -> DataFrame:
    """(part, block, before): ids in all blocks before each. Only one row for each part meets in one task."""
    blocks = files.select("part", "block", "n_ids")
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("above"))
    within = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("inside", F.coalesce(F.sum("n_ids").over(within), F.lit(0)))
    return blocks.join(parts, "part").select("part", "block", (F.col("above") + F.col("inside")).alias("before"))


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2, id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Files written to the shared folder and read again: (table of blocks, table of documents)."""
    path = scratch_path(docs.sparkSession, "ids")
    write_ids(docs, tokenizer, path, end_id, id, text)
    files = docs.sparkSession.read.parquet(path)
    return files, read_ids(files, id)

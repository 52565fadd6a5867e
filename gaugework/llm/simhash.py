"""SimHash near-duplicates: fingerprints of word shingles, linked through tables of distances to reference fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugework.llm.common import slices, stored
from gaugework.llm.components import components

SEED = 42
GROUPS = 8
BLOCK = 1 << 16


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


#: The rows of a Hadamard matrix: the bits of a group that a reference fingerprint of that group has set. The distances to
#: all eight tell the 256 values of a group apart.
WITHIN_GROUP = (0b11111111, 0b11110000, 0b11001100, 0b10101010, 0b11000011, 0b10100101, 0b10011001, 0b10010110)
#: References that differ from the zero fingerprint in one group of eight bits only, by group.
GROUP_PIVOTS = [[_signed(bits << (8 * g)) for bits in WITHIN_GROUP] for g in range(GROUPS)]
#: References spread over all bits; their nine distances of seven bits fit one long.
WIDE_PIVOTS = [_signed(int(x)) for x in np.random.default_rng(SEED).integers(0, 2**64, 9, np.uint64)]
MOST_BITS = 2


def fingerprint(text: bytes, shingle: int) -> int:
    """Signed 64-bit SimHash of the text's word shingles."""
    words = text.lower().split()  # of bytes: A-Z only, and the white space of the contract
    if not words:
        return 0
    joined = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    width = min(shingle, len(words))
    total = len(words) - width + 1
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, total, BLOCK):
        last = min(at + BLOCK, total)
        hashes = b"".join([digest(joined[s : e - 1], SEED) for s, e in zip(starts[at:last], starts[at + width : last + width], strict=True)])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total).view(">i8")[0])


def _fingerprints(shingle: int):
    def of(texts: pa.Array) -> pa.Array:
        out = []
        for data, offsets in slices(texts):
            raw = data.tobytes()
            out += [fingerprint(raw[s:e], shingle) for s, e in zip(offsets[:-1], offsets[1:], strict=True)]
        return pa.array(out, pa.int64())

    return of


def _distance(x: Column, pivot: int) -> Column:
    return F.bit_count(x.bitwiseXOR(F.lit(pivot).cast("bigint")))


def pivot_table(prints: DataFrame) -> DataFrame:
    """One row for each fingerprint `fp` and pair of groups: `key`, `fp`, and nine packed distances `wide`.

    The distance to a group's reference less the distance to the zero fingerprint depends on the bits of that group
    alone. Two fingerprints at most two bits apart differ in at most two of the eight groups, so for some pair of groups
    all the other groups' coordinates are equal: equal keys miss no pair.
    """
    x = F.col("fp")
    zero = F.bit_count(x)
    group = [F.xxhash64(*[_distance(x, p) - zero for p in pivots]) for pivots in GROUP_PIVOTS]
    packed = F.lit(0).cast("bigint")
    for pivot in WIDE_PIVOTS:
        packed = F.shiftleft(packed, 7).bitwiseOR(_distance(x, pivot).cast("bigint"))
    table = prints.select("fp", packed.alias("wide"), *(g.alias(f"g{i}") for i, g in enumerate(group)))
    pairs = list(combinations(range(GROUPS), 2))
    keys = [F.xxhash64(F.lit(n), *(f"g{i}" for i in range(GROUPS) if i not in pair)) for n, pair in enumerate(pairs)]
    return table.select(F.explode(F.array(*keys)).alias("key"), "fp", "wide")


def _tree(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Labels joined along the links a-b until none changes."""
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def link_runs(key: np.ndarray, fp: np.ndarray, wide: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For rows sorted by key: (fingerprint, smallest fingerprint it is linked to within its key), a tree and not all pairs."""
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(edge, len(key)))
    keep = np.repeat(size > 1, size)
    fp, wide = fp[keep], wide[keep]
    size = size[size > 1]
    if not len(size):
        return fp[:0], fp[:0]
    end = np.repeat(np.cumsum(size), size)
    coordinates = np.stack([(wide >> (7 * i)) & 127 for i in range(len(WIDE_PIVOTS))], axis=1).astype(np.int8)
    label = np.arange(len(fp))
    at = np.arange(len(fp))
    for step in range(1, int(size.max())):
        at = at[at + step < end[at]]
        near = at[np.abs(coordinates[at] - coordinates[at + step]).max(axis=1) <= most]
        near = near[np.bitwise_count((fp[near] ^ fp[near + step]).view(np.uint64)) <= most]
        if len(near):
            label = _tree(len(fp), near, near + step, label)
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return fp[moved], fp[label[moved]]


def _link(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int64)] * 3

        def out(columns: list[np.ndarray]) -> pa.RecordBatch:
            a, b = link_runs(*columns, most)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            rows = [np.concatenate([r, c.to_numpy()]) for r, c in zip(rest, batch.columns, strict=True)]
            last = int(np.searchsorted(rows[0], rows[0][-1])) if len(rows[0]) else 0
            rest = [c[last:] for c in rows]
            if last:
                yield out([c[:last] for c in rows])
        if len(rest[0]):
            yield out(rest)

    return run


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, most: int = MOST_BITS) -> DataFrame:
    """(id, fp, component_fp, component_id) of every document: its fingerprint, the smallest fingerprint and the smallest
    id that it reaches over linked fingerprints.

    Fingerprints of at most `most` (0 to 2) differing bits are linked. Equal fingerprints are one row from the start. The
    distances of each fingerprint to 73 references are computed once; candidates share the coordinates of all but two
    groups of references, go when any other coordinate differs by more than `most`, and are verified bit by bit. Rows
    under one key differ in sixteen bits at most, so they are 65,536 at most whatever the input.

    Null and empty texts have fingerprint 0 and are linked like any other. Repeated rows and ids stay as they are; a null
    id is never the smallest unless a component has no other. An empty table gives an empty table. Other columns are
    not looked at. Memory follows the longest text.
    """
    if not 0 <= most <= 2:
        raise ValueError("the reference groups are complete for up to two bits")
    rows = stored(docs.select(F.col(f"`{id}`").alias("id"), F.arrow_udf(_fingerprints(shingle), "bigint")(F.col(f"`{text}`")).alias("fp")), "prints")
    prints = rows.groupBy("fp").agg(F.min("id").alias("low"))
    dealt = pivot_table(prints).repartition("key").sortWithinPartitions("key", "fp")
    links = dealt.mapInArrow(_link(most), "a bigint, b bigint")
    joined = components(links, "a", "b")
    named = prints.join(joined, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("component", "fp").alias("component"))
    named = stored(named, "named")
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    found = named.join(lowest, "component").select("fp", F.col("component").alias("component_fp"), "component_id")
    return rows.join(found, "fp").select(F.col("id").alias(id), "fp", "component_fp", "component_id")


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, most: int = MOST_BITS) -> DataFrame:
    """The document with the smallest id of each component; of several rows with that id one stays.

    A component whose ids are all null keeps one of its documents.
    """
    found = near_duplicates(docs, id, text, shingle, most)
    ids = found.filter(F.col(f"`{id}`") == F.col("component_id")).select(F.col(f"`{id}`").alias("__id")).distinct()
    nulls = found.filter("component_id is null and fp = component_fp").select(F.col("fp").alias("__fp")).distinct()
    columns = [F.col(f"`{c}`") for c in docs.columns]
    shielded = docs.select(F.struct(*columns).alias("__row"), F.col(f"`{id}`").alias("__id"), F.col(f"`{text}`").alias("__text"))
    first = Window.partitionBy("__id").orderBy(F.xxhash64("__text"), "__text")
    whole = shielded.join(ids, "__id")
    whole = whole.withColumn("__n", F.row_number().over(first)).filter("__n = 1").select("__row.*")
    print_of = F.arrow_udf(_fingerprints(shingle), "bigint")
    lost = shielded.filter("__id is null").withColumn("__fp", print_of(F.col("__text"))).join(nulls, "__fp")
    once = Window.partitionBy("__fp").orderBy(F.xxhash64("__text"), "__text")
    lost = lost.withColumn("__n", F.row_number().over(once)).filter("__n = 1").select("__row.*")
    return whole.unionByName(lost)

"""Periodic runs of words, found as maximal pairs in the LCP-interval tree of each document's suffixes."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.llm.common import slices, word_bounds
from gaugework.llm.words import joined, word_codes

LEAST_LENGTH = 24
LEAST_POWER = 3
RUN = "struct<start:bigint,length:bigint,period:bigint>"
SCHEMA = f"struct<n_words:bigint,runs:array<{RUN}>,collapsed:string>"


def suffix_ranks(keys: np.ndarray, longest: int | None = None) -> list[np.ndarray]:
    """Rank of every suffix by its first 1, 2, 4, ... keys; the last ranks differ, as every sequence ends in a key of its own.

    A rank is the place of the first suffix with that beginning, so a suffix that is alone keeps its rank and only the
    others are sorted again.
    """
    order = np.argsort(keys, kind="stable")
    place = np.arange(len(keys))
    new = np.concatenate([[True], keys[order][1:] != keys[order][:-1]])
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, place, 0))
    levels = [rank]
    while True:
        ranks = rank[order]
        alone = np.concatenate([ranks[1:] != ranks[:-1], [True]]) & np.concatenate([[True], ranks[1:] != ranks[:-1]])
        order, ranks = order[~alone], ranks[~alone]
        if not len(order):
            return levels
        step = 1 << (len(levels) - 1)
        pair = ranks << 32 | rank[order + step]
        turn = np.argsort(pair, kind="stable")
        order, pair, ranks = order[turn], pair[turn], ranks[turn]
        place = np.arange(len(order))
        group = np.maximum.accumulate(np.where(np.concatenate([[True], ranks[1:] != ranks[:-1]]), place, 0))
        part = np.maximum.accumulate(np.where(np.concatenate([[True], pair[1:] != pair[:-1]]), place, 0))
        rank = rank.copy()
        rank[order] = ranks + part - group
        levels.append(rank)


def common_prefixes(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many keys the suffixes at a and b have in common at their beginnings."""
    length = np.zeros(len(a), np.int64)
    for n in range(len(levels) - 1, -1, -1):
        length += (levels[n][a + length] == levels[n][b + length]).astype(np.int64) << n
    return length


def maximal_pairs(places: list[int], common: list[int], left: np.ndarray, power: int) -> list[tuple[int, int, int]]:
    """(place, later place, common length) of the maximal pairs at most common / (power - 1) apart.

    places: suffixes in order; common: common lengths of neighbours. The intervals of the tree are merged bottom-up, the
    smaller child into the larger; a pair from two children differs in the word behind its common part, and counts if the
    words to its left differ as well. The places of a child are in ascending order. Occurrences of the common part within
    its half are a progression, and all of them but the first have the same word to their left: a list falls into
    stretches of one left word, and in reach of a place only the first of a stretch needs to be looked at.
    """
    pairs: list[tuple[int, int, int]] = []

    def merge(one: list[int], two: list[int], length: int) -> list[int]:
        few, many = (one, two) if len(one) < len(two) else (two, one)
        reach = length // (power - 1)
        for x in few:
            at = bisect_left(many, x - reach)
            if at < len(many) and many[at] < x and left[many[at]] != left[x]:
                pairs.append((many[at], x, length))
            at = bisect_right(many, x)
            if at < len(many) and many[at] <= x + reach and left[many[at]] != left[x]:
                pairs.extend((x, y, length) for y in many[at : bisect_right(many, x + reach)])
        if len(few) == 1:
            insort(many, few[0])
        else:
            many += few
            many.sort()
        return many

    open_: list[tuple[int, list[int]]] = []
    for place, after in zip(places, [*common, -1], strict=True):
        node = [place]
        while open_ and open_[-1][0] > after:
            length, child = open_.pop()
            node = merge(child, node, length)
        if open_ and open_[-1][0] == after:
            length, child = open_.pop()
            node = merge(child, node, length)
        open_.append((after, node))
    return pairs


def find_runs(codes: np.ndarray, doc: np.ndarray, docs: int, least: int = LEAST_LENGTH, power: int = LEAST_POWER) -> np.ndarray:
    """Rows (doc, start, length, period) in that order, of the words of `docs` documents one behind the other.

    A run of smallest period q is the maximal pair q apart whose common length is the run's less q. Multiples of q give the
    same stretch again, so the smallest distance of a stretch is its period.
    """
    nothing = np.zeros((0, 4), np.int64)
    if not len(codes):
        return nothing
    # each document ends in a key of its own, and no key occurs in two documents
    count = np.bincount(doc, minlength=docs)
    first = np.cumsum(count + 1) - count - 1
    keys = np.empty(len(codes) + docs, np.int64)
    at = np.arange(len(codes)) + doc
    keys[at] = doc << 32 | codes
    keys[first + count] = np.arange(docs) << 32 | 0xFFFFFFFF
    levels = suffix_ranks(keys)
    shortest = -(-least * (power - 1) // power)
    level = shortest.bit_length() - 1
    if len(levels) <= level:
        return nothing
    shared = levels[level]
    several = np.bincount(shared, minlength=len(keys))[shared] > 1
    order = np.flatnonzero(several)
    order = order[np.argsort(levels[-1][order], kind="stable")]
    if not len(order):
        return nothing
    left = np.concatenate([[-1], keys[:-1]])

    # a group with one word to the left of all, or with no two places near enough, has no such pair
    group = shared[order]
    edge = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    many_left = np.minimum.reduceat(left[order], edge) != np.maximum.reduceat(left[order], edge)
    order = order[np.repeat(many_left, np.diff(np.append(edge, len(order))))]
    if not len(order):
        return nothing
    group = shared[order]
    edge = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.append(edge, len(order)))
    common = common_prefixes(levels, order, np.append(order[1:], order[0]))
    common[edge[1:] - 1] = -1
    common[-1] = -1
    by_place = np.lexsort((order, group))
    gaps = np.append(np.diff(order[by_place]), len(keys))
    gaps[edge[1:] - 1] = len(keys)
    near = np.minimum.reduceat(gaps, edge) * (power - 1) <= np.maximum.reduceat(common, edge)
    found: list[tuple[int, int, int]] = []
    for a, size in zip(edge[near].tolist(), sizes[near].tolist(), strict=True):
        found += maximal_pairs(order[a : a + size].tolist(), common[a : a + size - 1].tolist(), left, power)
    if not found:
        return nothing
    one, two, length = np.array(found, np.int64).T
    period = two - one
    whole = length + period
    rows = np.stack([np.searchsorted(first, one, "right") - 1, one, whole, period], axis=1)[whole >= least]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1]))]
    keep = np.ones(len(rows), bool)
    keep[1:] = (rows[1:, 1:3] != rows[:-1, 1:3]).any(axis=1)
    rows = rows[keep]
    rows[:, 1] -= first[rows[:, 0]]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _measure(least: int, power: int):
    def of(texts: pa.Array) -> pa.Array:
        counts, runs, sizes, collapsed = [], [], [], []
        for data, offsets in slices(texts):
            docs = len(offsets) - 1
            starts, ends = word_bounds(data, offsets)
            doc = np.searchsorted(offsets, starts, "right") - 1
            codes, _ = word_codes(data, starts, ends)
            rows = find_runs(codes, doc, docs, least, power)
            words = np.bincount(doc, minlength=docs)
            before = np.cumsum(words) - words
            step = np.zeros(len(starts) + 1, np.int64)
            begin = before[rows[:, 0]] + rows[:, 1]
            np.add.at(step, begin + rows[:, 3], 1)
            np.add.at(step, begin + rows[:, 2], -1)
            counts.append(words)
            runs.append(rows[:, 1:])
            sizes.append(np.bincount(rows[:, 0], minlength=docs))
            collapsed.append(joined(data, offsets, starts, ends, np.cumsum(step[:-1]) == 0))
        if not counts:
            return pa.StructArray.from_arrays([pa.array([], t) for t in _TYPES], _NAMES)
        rows = np.concatenate(runs)
        structs = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(3)], ["start", "length", "period"])
        places = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
        texts = pa.concat_arrays([c.cast(pa.string()) for c in collapsed])
        return pa.StructArray.from_arrays([pa.array(np.concatenate(counts)), pa.ListArray.from_arrays(pa.array(places), structs), texts], _NAMES)

    return of


_NAMES = ["n_words", "runs", "collapsed"]
_TYPES = [pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])), pa.string()]


def periodic_runs(docs: DataFrame, text: str = "text", least: int = LEAST_LENGTH, power: int = LEAST_POWER) -> DataFrame:
    """The documents with the struct column `periodic`: n_words, runs (start, length, period) and the collapsed text.

    A run is a stretch of words with smallest period q that is at least `least` words and `power` (3 or more) periods long
    and that no neighbouring word extends. Runs are ordered by start, then period. The collapsed text has the words, one
    space apart, that no run contains after its first period. Every whole text is one sequence of exact word codes; its
    suffixes are sorted by doubling ranks, and nothing is shuffled.

    Null and empty texts have no words, no runs and an empty collapsed text. Equal rows and extra columns pass through; a
    column `periodic` is replaced. An empty table gives an empty table. Memory follows the longest text, some 8 bytes a
    word for every doubling of its longest repeat.
    """
    if power < 3 or least < power:
        raise ValueError("runs have three periods or more, and a word in each")
    return docs.withColumn("periodic", F.arrow_udf(_measure(least, power), SCHEMA)(F.col(f"`{text}`")).alias("periodic"))


def strongest(runs: str) -> Column:
    """The run with the greatest exact length / period, the first of them in order; null without runs."""
    return F.expr(
        f"""aggregate({runs}, cast(null AS {RUN}),
        (best, x) -> CASE WHEN best IS NULL OR x.length * best.period > best.length * x.period THEN x ELSE best END)"""
    )


def with_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, the end of every tenth one (by crc32 of its id) replaced by repetitions of its first words.

    With h the crc32, g = h div 10 and n words: words from a = g mod n on repeat with period 1 + (n - a) div (3 + g mod 8).
    Texts without words, and rows with a null id, stay as they are.
    """
    words = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    shielded = docs.select("*", F.crc32(F.col(f"`{id}`").cast("string")).alias("__h"))
    chosen = F.col("__h") % 10 == 0
    shielded = shielded.withColumn("__w", F.when(chosen, words))
    repeated = F.expr(
        """array_join(concat(
            slice(__w, 1, cast((__h div 10) % size(__w) AS int)),
            transform(
                sequence(0, size(__w) - 1 - cast((__h div 10) % size(__w) AS int)),
                i -> __w[cast((__h div 10) % size(__w) AS int)
                    + i % (1 + (size(__w) - cast((__h div 10) % size(__w) AS int)) div (3 + cast((__h div 10) % 8 AS int)))])), ' ')"""
    )
    changed = F.when(F.size("__w") > 0, repeated).otherwise(F.col(f"`{text}`"))
    return shielded.withColumn(text, changed).select(*(f"`{c}`" for c in docs.columns))

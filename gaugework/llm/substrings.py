"""Substring dedup by seed and extend: documents meet on winnowed anchors, matches are extended to both sides, and every
repeat of at least the wanted number of words is removed from all places but its first."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.llm.common import discard, slices, stored, word_bounds
from gaugework.llm.words import chained, joined, word_codes, word_digests

LENGTH = 20
SEED_WORDS = 4
_PLACE_BITS = 28
# A stretch of windows is packed into one long: its first word, its number of windows, its anchor's place in it.
_FIELD = 12
_MASK = (1 << _FIELD) - 1
# What a document is told about its stretches and windows; of one stretch the largest holds.
AGAIN, ONLY, OPEN, FIRST = 0, 1, 2, 3


def _slice_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, document, two digests) of the words."""
    starts, ends = word_bounds(data, offsets)
    codes, different = word_codes(data, starts, ends)
    digests = word_digests(different)[codes] if len(codes) else np.zeros((0, 2), np.uint64)
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1, digests


def _lowest(keys: np.ndarray, span: int) -> np.ndarray:
    """The smallest of every `span` neighbouring keys: the end of one block and the beginning of the next."""
    padded = np.full(-(-len(keys) // span) * span, np.uint64(2**64 - 1))
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, span)
    head = np.minimum.accumulate(blocks, axis=1).ravel()
    tail = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(keys) - span + 1
    return np.minimum(tail[:n], head[span - 1 : span - 1 + n])


def anchors(doc: np.ndarray, digests: np.ndarray, length: int, seed_words: int) -> dict[str, np.ndarray]:
    """The anchors of the documents' words: of every `length` words the seed with the smallest digest, the first of equal ones.

    Which seed that is depends on the window alone, so equal windows anywhere have equal anchors at equal places. Windows
    that follow each other and have the same anchor are one stretch: doc, start (word in the document), count of windows,
    place of the anchor after the start, `seed` digest, and `whole` digest of all its words.
    """
    none = {k: np.zeros(0, np.uint64 if k in ("seed", "whole") else np.int64) for k in ("doc", "start", "count", "place", "seed", "whole")}
    n = len(doc) - seed_words + 1
    span = length - seed_words + 1
    if n < span:
        return none
    seeds = np.zeros(n, np.uint64)
    for j in range(seed_words):
        seeds = chained(seeds, digests[j : j + n, 0])
    keys = (seeds >> np.uint64(_PLACE_BITS)) << np.uint64(_PLACE_BITS) | np.arange(n, dtype=np.uint64)
    lowest = _lowest(keys, span)
    windows = len(lowest)
    window = np.flatnonzero(doc[:windows] == doc[length - 1 : length - 1 + windows])
    if not len(window):
        return none
    anchor = (lowest[window] & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(window)))
    begin, anchor = window[first], anchor[first]
    place = anchor - begin
    whole = chained((place << _FIELD | count).astype(np.uint64), seeds[anchor])
    for j in range(length - 1 + int(count.max())):
        more = j < length - 1 + count
        whole[more] = chained(whole[more], digests[begin[more] + j, 1])
    word = np.searchsorted(doc, doc[begin])
    return {"doc": doc[begin], "start": begin - word, "count": count, "place": place, "seed": seeds[anchor], "whole": whole}


def _stretches(length: int, seed_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for data, offsets in slices(batch.column(2)):
                _, _, doc, digests = _slice_words(data, offsets)
                found = anchors(doc, digests, length, seed_words)
                row = pa.array(at + found["doc"])
                packed = found["start"] << 2 * _FIELD | found["count"] << _FIELD | found["place"]
                columns = [pa.array(found["seed"].view(np.int64)), pa.array(found["whole"].view(np.int64))]
                columns += [batch.column(0).take(row), batch.column(1).take(row), pa.array(packed)]
                yield pa.RecordBatch.from_arrays(columns, ["seed", "whole", "id", "d", "run"])
                at += len(offsets) - 1

    return run


def _lists(column: pa.Array, a: int, b: int) -> tuple[np.ndarray, pa.Array]:
    """(row of each element, elements) of the lists in rows a to b; null is an empty list."""
    part = column.slice(a, b - a)
    sizes = np.nan_to_num(part.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    return np.repeat(np.arange(b - a), sizes), part.flatten()


def _extended(length: int):
    """Digests of the windows of the asked stretches: from the anchor word by word to the left and to the right."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for data, offsets in slices(batch.column(2)):
                docs = len(offsets) - 1
                _, _, doc, digests = _slice_words(data, offsets)
                owner, runs = _lists(batch.column(3), at, at + docs)
                runs = runs.to_numpy(zero_copy_only=False)
                before = np.searchsorted(doc, owner)
                start, count, place = runs >> 2 * _FIELD, runs >> _FIELD & _MASK, runs & _MASK
                anchor = before + start + place
                # right[j]: from the anchor on j words; left[j]: j words before it, the nearest first
                n = len(runs)
                right, left = np.zeros((2, length + 1, n), np.uint64)
                for j in range(length):
                    right[j + 1] = chained(right[j], digests[np.minimum(anchor + j, len(doc) - 1), 0])
                    left[j + 1] = chained(left[j], digests[np.maximum(anchor - 1 - j, 0), 1])
                which = np.repeat(np.arange(n), count)
                step = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
                back = place[which] - step
                a, b = left[back, which], right[length - back, which]
                one = chained(chained(a, b), back.astype(np.uint64))
                two = chained(chained(b + np.uint64(0x2545F4914F6CDD1D), a), digests[anchor[which], 1])
                row = pa.array(at + owner[which])
                columns = [pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), batch.column(0).take(row), batch.column(1).take(row)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(start[which] + step)], ["one", "two", "id", "d", "start"])
                at += docs

    return run


def repeated_words(docs: int, doc: np.ndarray, owner: np.ndarray, value: np.ndarray, told: np.ndarray, length: int) -> np.ndarray:
    """Which words stand in a window that is not the first of its kind."""
    before = np.searchsorted(doc, owner)
    runs = (told == AGAIN) | (told == OPEN)
    begin = before[runs] + (value[runs] >> 2 * _FIELD)
    step = np.zeros(len(doc) + 1, np.int64)
    np.add.at(step, begin, 1)
    np.add.at(step, begin + (value[runs] >> _FIELD & _MASK), -1)
    again = np.cumsum(step[:-1]) > 0
    first = told == FIRST
    again[before[first] + value[first]] = False
    windows = np.flatnonzero(again)
    step = np.zeros(len(doc) + 1, np.int64)
    step[windows] += 1
    step[windows + length] -= 1
    return np.cumsum(step[:-1]) > 0


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for data, offsets in slices(batch.column(1)):
                docs = len(offsets) - 1
                starts, ends = word_bounds(data, offsets)
                doc = np.searchsorted(offsets, starts, "right") - 1
                owner, marks = _lists(batch.column(2), at, at + docs)
                value, told = (marks.field(i).to_numpy(zero_copy_only=False) for i in range(2))
                gone = repeated_words(docs, doc, owner, value, told, length)
                kept = joined(data, offsets, starts, ends, ~gone)
                columns = [batch.column(0).slice(at, docs), pa.array(np.bincount(doc, minlength=docs))]
                columns += [pa.array(np.bincount(doc[gone], minlength=docs)), kept.cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_removed", "kept"])
                at += docs

    return run


def _same_document() -> Column:
    return F.col("id").eqNullSafe(F.col("__id")) & (F.col("d") == F.col("__d"))


def remove_later_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, seed_words: int = SEED_WORDS
) -> DataFrame:
    """(id, n_words, n_removed, kept) of every document: its words, one space apart, without those that stand in a window of
    `length` words which also starts earlier, in a document with a smaller id or further up in the same.

    Of every window the seed of `seed_words` words with the smallest digest is its anchor (winnowing); consecutive windows
    with one anchor are a stretch. Documents meet on the anchors' seeds. Where all words of a stretch were met before, so
    were its windows: the first of each kind stays, the others are settled. First stretches that share a seed and differ
    are extended from the anchor to the left and to the right, word by word, as far as a window reaches, and the smallest
    place of each extended match is its first. All this is counted before it is shuffled and no occurrences are paired, so
    a seed, stretch or match in a third of all documents is one row for each task. Seeds and words are known by 64-bit
    digests that are used in pairs, so two of them have to meet at once.

    Null ids come first. Rows with the same id and text are the same document: none is earlier than the other. Rows with
    the same id and other texts follow in the order of their texts' hashes. Null and empty texts have no words; other
    columns are left out; an empty table gives an empty table. Memory follows the longest text.
    """
    if not 0 < seed_words < length <= _MASK:
        raise ValueError(f"a window has more words than its seed, and up to {_MASK}")
    kind = docs.schema[id].dataType.simpleString()
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    base = docs.select(F.col(f"`{id}`").alias("id"), F.xxhash64(body).alias("d"), body.alias("text"))
    place = f"id {kind}, d bigint"
    runs = base.mapInArrow(_stretches(length, seed_words), f"seed bigint, whole bigint, {place}, run bigint")
    runs = stored(runs, "stretches")
    # stored, so that the join is between plain tables, whose skewed keys adaptive execution splits
    shared = stored(runs.groupBy("seed").agg(F.count("*").alias("n")).filter("n > 1").select("seed"), "seeds")
    met = stored(runs.join(shared, "seed"), "met")
    discard(runs, shared)
    kinds = stored(met.groupBy("seed", "whole").agg(F.min(F.struct("id", "d", "run")).alias("one")), "kinds")
    several = kinds.groupBy("seed").agg(F.count("*").alias("n")).filter("n > 1").select("seed", F.lit(True).alias("several"))
    first = stored(kinds.join(several, "seed", "left").select("one.*", F.coalesce("several", F.lit(False)).alias("several")), "first")
    discard(kinds)

    asked = first.filter("several").groupBy(F.col("id").alias("__id"), F.col("d").alias("__d")).agg(F.collect_list("run").alias("runs"))
    texts = base.join(asked, _same_document()).select("id", "d", "text", "runs")
    windows = texts.mapInArrow(_extended(length), f"one bigint, two bigint, {place}, start bigint")
    starts = windows.groupBy("one", "two").agg(F.min(F.struct("id", "d", "start")).alias("at")).select("at.*")

    told = met.select("id", "d", F.col("run").alias("value"), F.lit(AGAIN).alias("told")).unionByName(
        first.select("id", "d", F.col("run").alias("value"), F.when(F.col("several"), OPEN).otherwise(ONLY).alias("told"))
    )
    told = told.groupBy("id", "d", "value").agg(F.max("told").alias("told")).filter(F.col("told") != ONLY)
    told = told.unionByName(starts.select("id", "d", F.col("start").alias("value"), F.lit(FIRST).alias("told")))
    marks = told.groupBy(F.col("id").alias("__id"), F.col("d").alias("__d")).agg(F.collect_list(F.struct("value", "told")).alias("marks"))
    marks = stored(marks, "marks")
    discard(met, first)
    found = base.join(marks, _same_document(), "left").select("id", "text", "marks")
    out = found.mapInArrow(_cut(length), f"id {kind}, n_words bigint, n_removed bigint, kept string")
    return out.withColumnRenamed("id", id)


def later_repeats_sql(length: int = LENGTH) -> str:
    """DuckDB SQL over `documents` for tables with different ids: every window is spelled out."""
    return f"""
WITH words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents)
), windows AS (
  SELECT doc_id, i, list(word) OVER w AS win FROM words
  WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {length - 1} FOLLOWING)
), ordered AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1 AS again FROM windows WHERE len(win) = {length}
), covered AS (
  SELECT doc_id, i, word,
    coalesce(max(CASE WHEN again THEN i END) OVER (PARTITION BY doc_id ORDER BY i), -{length}) + {length} > i AS gone
  FROM words LEFT JOIN ordered USING (doc_id, i)
), cut AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
  FROM covered GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN cut USING (doc_id)"""

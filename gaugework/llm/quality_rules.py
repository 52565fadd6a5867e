"""Quality rules: how much of a text stands inside repeated word windows and repeated lines."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.llm.common import between, mix, running, slices, word_bounds
from gaugework.llm.words import word_codes, word_digests

LENGTHS = (5, 6, 7, 8, 9, 10)
BASE_LENGTH = 8
_WORDS = 0xA24BAED4963EE407
_WORDS_INVERSE = pow(_WORDS, -1, 2**64)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "dup_line_chars", "n_repeat_words"]
MEASURES = [*COUNTS, *(f"dup_{n}gram_chars" for n in LENGTHS)]
SCHEMA = "struct<" + ",".join(f"{name}:bigint" for name in MEASURES) + ">"


@dataclass(frozen=True)
class Limits:
    """Largest shares that a kept text may have; word windows are given with their length."""

    dup_lines: float = 0.30
    dup_line_chars: float = 0.20
    dup_ngram_chars: dict[int, float] = field(default_factory=lambda: {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10})


def _equal_earlier(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose key occurs twice or more, in ascending order, and which of them are not its first place."""
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    places = np.flatnonzero(twice[at] == keys)
    found = at[places]
    _, first = np.unique(found, return_index=True)
    later = np.ones(len(places), bool)
    later[first] = False
    return places, later


def _covered(places: np.ndarray, length: int, n: int) -> np.ndarray:
    """Words inside a window of `length` words that begins at one of the places."""
    step = np.zeros(n + length + 1, np.int32)
    np.add.at(step, places, 1)
    np.add.at(step, places + length, -1)
    return np.cumsum(step)[:n] > 0


def measure_slice(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    docs = len(offsets) - 1
    per_doc = lambda doc, weights=None: np.bincount(doc, weights, docs).astype(np.int64)
    doc_of = lambda at: np.searchsorted(offsets, at, "right") - 1
    starts, ends = word_bounds(data, offsets)
    doc = doc_of(starts)
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    chars = points[ends] - points[starts]
    out = {"n_words": per_doc(doc), "word_chars": per_doc(doc, chars), "n_symbols": per_doc(doc_of(np.flatnonzero(_SYMBOL[data])))}

    breaks = np.flatnonzero(data == 10)
    line_starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    line_ends = np.sort(np.concatenate([offsets[1:], breaks]), kind="stable")
    with_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends = line_starts[with_word], line_ends[with_word]
    line_doc = doc_of(line_starts)
    # lines of any length are told apart by their bytes, words by 64 bits of a digest of them
    line_codes, _ = word_codes(data, line_starts, line_ends)
    places, later = _equal_earlier(line_doc << 32 | line_codes)
    again = places[later]
    out["n_lines"] = per_doc(line_doc)
    out["n_dup_lines"] = per_doc(line_doc[again])
    out["dup_line_chars"] = per_doc(line_doc[again], points[line_ends[again]] - points[line_starts[again]])

    out["n_repeat_words"] = np.zeros(docs, np.int64)
    codes, different = word_codes(data, starts, ends)
    rolled = running(word_digests(different)[codes, 0] if len(codes) else np.zeros(0, np.uint64), _WORDS)
    salt = mix(np.arange(1, docs + 1, dtype=np.uint64))
    candidates = np.arange(len(starts))
    for length in LENGTHS:
        name = f"dup_{length}gram_chars"
        out[name] = np.zeros(docs, np.int64)
        candidates = candidates[candidates + length <= len(starts)]
        candidates = candidates[doc[candidates] == doc[candidates + length - 1]]
        places, later = _equal_earlier(mix(between(rolled, candidates, candidates + length, _WORDS_INVERSE) + salt[doc[candidates]]))
        places = candidates[places]
        again = _covered(places[later], length, len(starts))
        out[name] = per_doc(doc[again], chars[again])
        if length == BASE_LENGTH:
            out["n_repeat_words"] = per_doc(doc[_covered(places, length, len(starts))])
        # a longer window can only repeat where both shorter windows in it do
        candidates = places[np.isin(places + 1, places, assume_unique=True)]
    return out


def measure(texts: pa.Array) -> pa.Array:
    parts = [measure_slice(*piece) for piece in slices(texts)]
    columns = [np.concatenate([p[name] for p in parts]) if parts else np.zeros(0, np.int64) for name in MEASURES]
    return pa.StructArray.from_arrays([pa.array(c) for c in columns], MEASURES)


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole)), F.lit(0.0))


def repetition(docs: DataFrame, text: str = "text", limits: Limits | None = None) -> DataFrame:
    """The documents with the struct column `quality`: the measures and the verdict of each whole text.

    Every word window of each length is hashed by rolling sums over digests of its words; lines are compared by their bytes.
    What equals an earlier window or line of the same text counts with its characters. `quality.base_failed`: under 20 words, or over 30 % of the words in
    eight-word windows that occur twice or more. `quality.kept`: not failed and no share above its limit.

    Null and empty texts have no words and fail. Equal rows and extra columns pass through; a column `quality` is
    replaced. An empty table gives an empty table. Memory follows the longest text.
    """
    limits = limits or Limits()
    measured = docs.withColumn("quality", F.arrow_udf(measure, SCHEMA)(F.col(text)).alias("quality"))
    q = lambda name: f"quality.{name}"
    failed = (F.col(q("n_words")) < 20) | (100 * F.col(q("n_repeat_words")) > 30 * F.col(q("n_words")))
    good = (_share(q("n_dup_lines"), q("n_lines")) <= limits.dup_lines) & (_share(q("dup_line_chars"), q("word_chars")) <= limits.dup_line_chars)
    for length, most in limits.dup_ngram_chars.items():
        if length not in LENGTHS:
            raise ValueError(f"windows have {LENGTHS} words")
        good = good & (_share(q(f"dup_{length}gram_chars"), q("word_chars")) <= most)
    return measured.withColumn("quality", F.col("quality").withField("base_failed", failed).withField("kept", ~failed & good))


def keep_good(docs: DataFrame, text: str = "text", limits: Limits | None = None) -> DataFrame:
    """Only the documents that the rules keep, with their own columns (also one named `quality`)."""
    narrow = docs.withColumn("__kept_text", F.col(text))
    shielded = narrow.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), "__kept_text")
    return repetition(shielded, "__kept_text", limits).filter("quality.kept").select("__row.*")

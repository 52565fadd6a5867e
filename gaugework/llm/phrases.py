"""Collocations counted on a prefix-free parse: texts are cut where their content says so, equal chunks are counted once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugework.llm.common import free_shuffles, slices, stored
from gaugework.llm.words import chained, word_codes, word_digests

MOST_WORDS = 3
#: Words that a chunk shares with the next: no phrase is longer than these and one.
OVERLAP = MOST_WORDS - 1
#: One in so many windows of OVERLAP words ends a chunk.
CHUNK = 16
LEAST_COUNT = 10
SUBSUMED_PERCENT = 50
BEST = 2000
SALTS = 64
PARSE_BYTES = 3 << 20
#: Bits of the map of frequent pairs: 4 MB whatever the input; where it fills up, more triples are counted, none is lost.
MAP_BITS = 25
_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_GAP = _BREAK.copy()
_GAP[[9, 32]] = True


def piece_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, piece) of the words; pieces are numbered in order, over all texts."""
    inside = ~_GAP[data]
    cut = np.zeros(len(data) + 1, np.int64)
    np.add.at(cut, offsets[1:-1], 1)
    edge = cut[:-1] > 0
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:] & ~edge[1:]
    ends = np.flatnonzero(inside & ~after) + 1
    piece = np.cumsum(cut[:-1] + _BREAK[data])
    return starts, ends, piece[starts]


def parse(piece: np.ndarray, digests: np.ndarray, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, last word, whether it ends its piece) of every chunk.

    A window of OVERLAP words whose digest says so is the end of a chunk and the beginning of the next; the window says it
    wherever it stands, so equal stretches of text are cut alike.
    """
    n = len(piece)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    window = np.zeros(max(n - OVERLAP + 1, 0), np.uint64)
    for j in range(OVERLAP):
        window = chained(window, digests[j : j + len(window)])
    at = np.flatnonzero(window % np.uint64(chunk) == 0)
    last = np.append(np.flatnonzero(piece[1:] != piece[:-1]), n - 1)
    first = np.concatenate([[0], last[:-1] + 1])
    # the window lies in one piece and is not its end
    at = at[(piece[at] == piece[np.minimum(at + OVERLAP, n - 1)]) & (at + OVERLAP < n)]
    begins = np.sort(np.concatenate([first, at]), kind="stable")
    ends = np.sort(np.concatenate([last, at + OVERLAP - 1]), kind="stable")
    return begins, ends, np.isin(ends, last)


def _chunks(chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, at = batch.column(0), 0
            for data, offsets in slices(batch.column(1)):
                lower = data + (((data >= 65) & (data <= 90)) * np.uint8(32))
                starts, ends, piece = piece_words(lower, offsets)
                codes, different = word_codes(lower, starts, ends)
                digests = word_digests(different)[codes, 0] if len(codes) else np.zeros(0, np.uint64)
                begin, end, final = parse(piece, digests, chunk)
                size = end - begin + 1
                word = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
                places = np.concatenate([[0], np.cumsum(size)])
                named = different.cast(pa.large_string()).cast(pa.string())
                listed = pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), named.take(pa.array(codes[word])))
                row = at + np.searchsorted(offsets, starts[begin], "right") - 1
                columns = [langs.take(pa.array(row)), pc.binary_join(listed, " "), pa.array(final)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "chunk", "final"])
                at += len(offsets) - 1

    return run


def _weighted(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(different keys, sum of their weights, number of each key among them); sums are exact."""
    order = np.argsort(keys, kind="stable")
    sorted_ = keys[order]
    new = np.concatenate([[True], sorted_[1:] != sorted_[:-1]]) if len(keys) else np.zeros(0, bool)
    edge = np.flatnonzero(new)
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return sorted_[edge], np.add.reduceat(weights[order], edge) if len(edge) else weights[:0], number


def _pair_bits(lang: str, first: np.ndarray, second: np.ndarray, size: int) -> np.ndarray:
    """Place in a map of 2^size bits of each pair of words, given by their digests."""
    salt = np.full(len(first), xxhash.xxh3_64_intdigest(lang), np.uint64)
    return chained(chained(salt, first), second) >> np.uint64(64 - size)


def _chunk_words(chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """(code of each word, its chunk, the different words, end of each word's chunk) of texts with single spaces."""
    chunks = chunks.cast(pa.large_string())
    _, ends, raw = chunks.buffers()
    offsets = np.frombuffer(ends, np.int64, len(chunks) + 1 + chunks.offset)[chunks.offset :]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    space = data == 32
    starts = np.flatnonzero(~space & (edge[:-1] | np.concatenate([[True], space[:-1]])))
    stops = np.flatnonzero(~space & (edge[1:] | np.concatenate([space[1:], [True]]))) + 1
    codes, different = word_codes(data, starts, stops)
    chunk = np.searchsorted(offsets, starts, "right") - 1
    return codes, chunk, different, np.searchsorted(chunk, chunk, "right")


def chunk_phrases(
    chunks: pa.Array, final: np.ndarray, weights: np.ndarray, sizes: tuple[int, ...], lang: str = "", frequent: np.ndarray | None = None
) -> tuple[pa.Array, np.ndarray]:
    """(phrases of the given sizes, their weighted counts) of different chunks; the phrase of size 0 has all words.

    A phrase belongs to the chunk in which it begins before the shared words, so that it is counted once. With `frequent`,
    a map of pairs, phrases with a pair that is not in it are left out.
    """
    codes, chunk, different, stop = _chunk_words(chunks)
    own = final[chunk] | (np.arange(len(codes)) + OVERLAP < stop)
    at = np.flatnonzero(own)
    weight = weights[chunk]
    phrases, counts = [pa.array([], pa.large_string())], [np.zeros(0, np.int64)]
    if 0 in sizes:
        phrases.append(pa.array([""], pa.large_string()))
        counts.append(np.array([weight[at].sum()], np.int64))
    if frequent is not None and len(codes):
        digests = word_digests(different)[codes, 0]
        bits = _pair_bits(lang, digests[:-1], digests[1:], len(frequent).bit_length() + 2)
        known = np.append((frequent[bits >> np.uint64(3)] >> (bits & np.uint64(7)).astype(np.uint8)) & 1 > 0, False)
        at = at[(at + max(sizes) <= stop[at])]
        for step in range(max(sizes) - 1):
            at = at[known[at + step]]
    different = different.cast(pa.large_string())
    texts, prefix = None, np.zeros(len(codes), np.int64)
    for n in range(1, max(sizes) + 1):
        at = at[at + n <= stop[at]]
        keys, sums, number = _weighted(prefix[at] << 32 | codes[at + n - 1], weight[at])
        word = different.take(pa.array(keys & 0xFFFFFFFF))
        texts = word if texts is None else pc.binary_join_element_wise(texts.take(pa.array(keys >> 32)), word, pa.scalar(" ", pa.large_string()))
        prefix[at] = number
        if n in sizes:
            phrases.append(texts)
            counts.append(sums)
    return pa.concat_arrays(phrases), np.concatenate(counts)


def _counts(sizes: tuple[int, ...], frequent: Broadcast | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            for lang in pc.unique(table.column("lang")).to_pylist():
                some = table.filter(pc.equal(table.column("lang"), lang)).combine_chunks()
                chunks, final, n = (some.column(name).chunk(0) for name in ("chunk", "final", "n"))
                known = None if frequent is None else frequent.value
                phrases, counts = chunk_phrases(chunks, final.to_numpy(zero_copy_only=False), n.to_numpy(), sizes, lang, known)
                for a in range(0, len(phrases), 1 << 17):
                    part = phrases.slice(a, 1 << 17).cast(pa.string())
                    columns = [pa.array([lang] * len(part), pa.string()), part, pa.array(counts[a : a + (1 << 17)])]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "f"])

        for batch in batches:
            if len(batch):
                held.append(batch)
                size += batch.nbytes
            if size >= PARSE_BYTES:
                yield from out()
                held.clear()
                size = 0
        if held:
            yield from out()

    return run


def _bits_of_pairs(size: int):
    """(place of 64 bits in the map, those bits) of the pairs of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang in pc.unique(batch.column(0)).to_pylist():
                pairs = batch.column(1).filter(pc.equal(batch.column(0), lang))
                codes, _, different, _ = _chunk_words(pairs)
                digests = word_digests(different)[codes, 0]
                bits = _pair_bits(lang, digests[::2], digests[1::2], size)
                masks = np.uint64(1) << (bits & np.uint64(63))
                yield pa.RecordBatch.from_arrays([pa.array((bits >> np.uint64(6)).astype(np.int32)), pa.array(masks.view(np.int64))], ["place", "bits"])

    return run


def _map_of_pairs(pairs: DataFrame, size: int) -> Broadcast:
    """Map of 2^size bits on every executor. The driver gets one row for 64 of them at most."""
    rows = pairs.mapInArrow(_bits_of_pairs(size), "place int, bits bigint").groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(1 << (size - 6), np.int64)
    words[rows.column("place").to_numpy()] = rows.column("bits").to_numpy()
    return pairs.sparkSession.sparkContext.broadcast(words.astype("<i8").view(np.uint8))


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", chunk: int = CHUNK, least: int = 1, map_bits: int = MAP_BITS) -> DataFrame:
    """(lang, phrase, f) of the phrases of up to MOST_WORDS words that occur `least` times; the empty phrase has the number
    of all words.

    Texts are lower-cased (A-Z), split at `.,;:!?` and line ends into pieces, and parsed into chunks that overlap in
    OVERLAP words. The parse is counted: one row for each different chunk of a language. Phrases are counted inside the
    different chunks, weighted by their frequency; both counts are partial before each shuffle. Where `least` is more
    than 1, words and pairs are counted first, and of the triples only those whose pairs may both be so frequent, by a map
    of bits without false negatives.
    """
    words = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text"))
    parsed = words.mapInArrow(_chunks(chunk), "lang string, chunk string, final boolean")
    dictionary = stored(parsed.groupBy("lang", "chunk", "final").agg(F.count("*").alias("n")), "chunks")
    free_shuffles(docs.sparkSession)

    def counted(sizes: tuple[int, ...], frequent: Broadcast | None = None) -> DataFrame:
        rows = dictionary.mapInArrow(_counts(sizes, frequent), "lang string, phrase string, f bigint")
        return rows.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)

    if least <= 1:
        return counted(tuple(range(MOST_WORDS + 1)))
    short = stored(counted(tuple(range(MOST_WORDS))), "phrases")
    free_shuffles(docs.sparkSession)
    frequent = _map_of_pairs(short.filter(F.size(F.split("phrase", " ")) == MOST_WORDS - 1).select("lang", "phrase"), map_bits)
    return short.unionByName(counted((MOST_WORDS,), frequent))


def _part(first: int, n: int | None = None):
    words = F.split("phrase", " ")
    return F.array_join(F.slice(words, first, F.size(words) - first + 1 if n is None else F.lit(n)), " ")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST_COUNT, percent: int = SUBSUMED_PERCENT, best: int = BEST
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `best` phrases of two or three words of each language.

    a: occurrences of the phrase, `least` or more; l and r: those of its two parts, cut where floor(10^6 a a / (l r)) is
    smallest, at the first such place; that is its score. n: all words of the language. A phrase is left out if a longer
    candidate that contains it occurs at least `percent` percent as often. Order: score and a descending, then phrase by
    its bytes.

    Null texts have no words; a null language is `und`. Repeated rows count again; other columns are not looked at; an
    empty table, or one without frequent phrases, gives no rows. Products are decimals of 38 digits, exact for counts up
    to 10^16. The best are taken from SALTS parts of a language first, so that no task sees all of its phrases.
    """
    counts = stored(phrase_counts(docs, text, lang, CHUNK, least).filter(F.col("f") >= least), "phrases")
    size = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    sized = counts.withColumn("size", size)
    known = sized.filter("size between 1 and 2").select("lang", F.col("phrase").alias("part"), F.col("f").alias("of"))
    candidates = sized.filter("size > 1").withColumnRenamed("f", "a")

    def with_part(df: DataFrame, part, name: str) -> DataFrame:
        return df.withColumn("part", part).join(known.withColumnRenamed("of", name), ["lang", "part"]).drop("part")

    wide = lambda name: F.col(name).cast("decimal(19,0)")
    cuts = [(2, 1), (3, 1), (3, 2)]
    scored = None
    for words, k in cuts:
        some = with_part(with_part(candidates.filter(F.col("size") == words), _part(1, k), "l"), _part(k + 1), "r")
        some = some.withColumn("l", wide("l")).withColumn("r", wide("r")).withColumn("__a", wide("a"))
        some = some.withColumn("score", F.expr("(1000000BD * __a * __a) div (l * r)")).withColumn("k", F.lit(k))
        scored = some if scored is None else scored.unionByName(some)
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "size")).alias("cut")).select("lang", "phrase", "cut.*")

    longer = candidates.filter(F.col("size") == MOST_WORDS).withColumn("part", F.explode(F.array(_part(1, 2), _part(2))))
    longer = longer.groupBy("lang", F.col("part").alias("phrase")).agg(F.max("a").alias("longer"))
    left = lowest.join(longer, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(percent) * F.col("a")))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = left.withColumn("__part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    rank = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    some = salted.withColumn("rank", rank("lang", "__part")).filter(F.col("rank") <= best)
    ranked = some.withColumn("rank", rank("lang").cast("bigint")).filter(F.col("rank") <= best)
    total = counts.filter("phrase = ''").select("lang", F.col("f").alias("n"))
    numbers = [F.col(c).cast("bigint").alias(c) for c in ("a", "l", "r")]
    return ranked.join(total, "lang").select("lang", "rank", "phrase", *numbers, "n", "score")


def collocations_sql(least: int = LEAST_COUNT, percent: int = SUBSUMED_PERCENT, best: int = BEST) -> str:
    """DuckDB SQL over `documents`."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{upper}', '{lower}') AS t FROM documents
), pieces AS (
  SELECT row_number() OVER () AS id, lang, piece FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts)
), words AS (
  SELECT id, lang, unnest(w) AS w1, unnest(range(len(w))) AS i
  FROM (SELECT id, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces)
), following AS (
  SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3 FROM words WINDOW p AS (PARTITION BY id ORDER BY i)
), counts AS (
  SELECT lang, 1 AS size, w1 AS phrase, count(*) AS f FROM following GROUP BY ALL
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM following WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM following WHERE w3 IS NOT NULL GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size > 1 AND f >= {least}
), cuts AS (
  SELECT c.lang, c.size, c.phrase, c.a, c.k, x.f AS l, y.f AS r, 1000000::HUGEINT * c.a * c.a // (x.f::HUGEINT * y.f) AS score
  FROM (
    SELECT *, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1 : size], ' ') AS tail
    FROM candidates, (VALUES (1), (2)) s(k) WHERE k < size
  ) c JOIN counts x ON x.lang = c.lang AND x.phrase = c.head JOIN counts y ON y.lang = c.lang AND y.phrase = c.tail
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), parts AS (
  SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM candidates WHERE size = 3
), longer AS (
  SELECT lang, phrase, max(a) AS most FROM parts GROUP BY lang, phrase
), ranked AS (
  SELECT lang, phrase, a, l, r, score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most < {percent} * a
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= {best}"""

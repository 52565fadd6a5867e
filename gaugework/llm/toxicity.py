"""Toxicity: a convolutional text classifier over hashed words, trained in numpy, with a threshold for each language.

Words are lower-cased, stripped of signs at their ends and hashed twice, to two of BUCKETS embeddings each, which are added:
two words that meet in one bucket hardly do in the other. Filters of several widths slide
over the embeddings of the whole text; the largest response of each filter goes into a logistic output.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.llm.common import between, byte_sums, mix, slices, word_bounds

BUCKETS = 1 << 16
DIMENSION = 8
FILTERS = 12
WIDTHS = (1, 2, 3)
EPOCHS = 8
BATCH = 64
#: Bound of the labelled sample for each label: the rows with the smallest digests of their ids.
SAMPLE_PER_LABEL = 3_000
CHUNK_WORDS = 1 << 16
#: Standard errors up to which a difference may be chance among so many buckets.
CHANCE = 5.0
DECISION = 0.7

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_EDGE = np.ones(256, bool)
_EDGE[48:58] = _EDGE[65:91] = _EDGE[97:123] = _EDGE[128:] = False

#: Letters that tell the languages apart, and the most frequent short words; texts with neither are of language 0.
LANGUAGE_MARKS = {
    "en": ["the", "and", "of", "to", "is", "that", "was", "in"],
    "de": ["und", "der", "die", "das", "ist", "nicht", "ä", "ö", "ü", "ß"],
    "fr": ["le", "les", "une", "est", "pour", "avec", "è", "ê", "ç", "à", "ù"],
    "es": ["el", "los", "una", "que", "por", "con", "ñ", "ó", "í", "á", "ú", "¿", "¡"],
}
LANGUAGES = list(LANGUAGE_MARKS)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(both buckets of each word in one unsigned 32-bit number, document of each word)."""
    lower = _LOWER[data]
    starts, ends = word_bounds(data, offsets)
    edge = _EDGE[lower]
    for _ in range(4):  # signs at either end
        short = ends - starts > 1
        starts = starts + (short & edge[starts])
        short = ends - starts > 1
        ends = ends - (short & edge[ends - 1])
    hashed = between(byte_sums(lower), starts, ends)
    return (hashed >> np.uint64(16)).astype(np.uint32), np.searchsorted(offsets, starts, "right") - 1


def both(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the two embeddings of each word: the second half of the table is for the second hash."""
    return (words & 0xFFFF).astype(np.int64), (words >> 16).astype(np.int64) + BUCKETS


def _mark_bucket(mark: str) -> int:
    raw = np.frombuffer(mark.encode(), np.uint8)
    return int(words_of(raw, np.array([0, len(raw)]))[0][0])


def languages(data: np.ndarray, offsets: np.ndarray, buckets: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Language of each text, guessed from the text alone: the marks that are most frequent."""
    docs = len(offsets) - 1
    votes = np.zeros((docs, len(LANGUAGES)))
    pairs = data[:-1].astype(np.int32) << 8 | data[1:] if len(data) > 1 else np.zeros(0, np.int32)
    lead = np.flatnonzero((pairs >> 8 == 0xC3) | (pairs >> 8 == 0xC2))
    place = np.searchsorted(offsets, lead, "right") - 1
    inside = lead + 1 < offsets[place + 1]
    for n, marks in enumerate(LANGUAGE_MARKS.values()):
        whole = np.isin(buckets, np.array([_mark_bucket(m) for m in marks if m.isascii()], np.uint32))
        votes[:, n] += np.bincount(doc[whole], minlength=docs)
        signs = [int.from_bytes(m.encode()) for m in marks if not m.isascii()]
        votes[:, n] += np.bincount(place[inside & np.isin(pairs[lead], signs)], minlength=docs)
    return votes.argmax(axis=1)


@dataclass
class Model:
    """embedding: buckets x dimension; filters: for each width, width x dimension x filters; bias, out, out_bias; the
    shift of each language puts its calibrated threshold at DECISION."""

    embedding: np.ndarray
    filters: dict[int, np.ndarray]
    bias: dict[int, np.ndarray]
    out: np.ndarray
    out_bias: float
    shift: np.ndarray

    def tables(self) -> dict[int, list[np.ndarray]]:
        """Response of each bucket at each place of a filter: a convolution is then a sum of rows."""
        return {w: [(self.embedding @ f[j]).astype(np.float32) for j in range(w)] for w, f in self.filters.items()}

    def logits(self, buckets: np.ndarray, doc: np.ndarray, docs: int, tables: dict[int, list[np.ndarray]]) -> np.ndarray:
        """Before calibration, of each text; a text of no words has empty filters."""
        one, two = both(buckets)
        total = np.full(docs, self.out_bias)
        for k, (w, rows) in enumerate(tables.items()):
            top = np.zeros((docs, FILTERS), np.float32)  # responses below 0 count as 0
            for at in range(0, max(len(buckets) - w + 1, 0), CHUNK_WORDS):
                n = min(CHUNK_WORDS, len(buckets) - w + 1 - at)
                here = doc[at : at + n]
                sums = self.bias[w].astype(np.float32) + rows[0][one[at : at + n]] + rows[0][two[at : at + n]]
                for j in range(1, w):
                    sums += rows[j][one[at + j : at + j + n]]
                    sums += rows[j][two[at + j : at + j + n]]
                sums[here != doc[at + w - 1 : at + w - 1 + n]] = 0
                first = np.flatnonzero(np.concatenate([[True], here[1:] != here[:-1]]))
                top[here[first]] = np.maximum(top[here[first]], np.maximum.reduceat(sums, first, axis=0))
            total += top @ self.out[k * FILTERS : (k + 1) * FILTERS]
        return total


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def train(texts: list[np.ndarray], labels: np.ndarray, seed: int = 5, epochs: int = EPOCHS) -> Model:
    """Adagrad on the logistic loss; texts are arrays from `words_of`. Both classes weigh the same. Deterministic.

    The first dimension starts at each bucket's standardised difference in text frequency between the labels, so that the
    filters begin at words that tell them apart and not at chance; all is then trained together.
    """
    rng = np.random.default_rng(seed)
    labels = np.asarray(labels, float)
    rows_of = [both(text) for text in texts]
    seen = [np.zeros(2 * BUCKETS), np.zeros(2 * BUCKETS)]
    for pair, y in zip(rows_of, labels, strict=True):
        for rows in pair:
            seen[int(y)][np.unique(rows)] += 1
    n = [max((labels == v).sum(), 1) for v in (0, 1)]
    rate = (seen[0] + seen[1] + 1) / (sum(n) + 2)
    apart = (seen[1] / n[1] - seen[0] / n[0]) / np.sqrt(rate * (1 - rate) * (1 / n[0] + 1 / n[1]))
    embedding = rng.normal(0, 0.02, (2 * BUCKETS, DIMENSION))
    # differences that chance alone brings about in so many buckets start at 0
    embedding[:, 0] = np.clip((np.abs(apart) - CHANCE) / CHANCE, 0, 1) * np.sign(apart)
    filters = {w: rng.normal(0, 0.2, (w, DIMENSION, FILTERS)) for w in WIDTHS}
    for f in filters.values():
        f[:, 0] = np.abs(f[:, 0]) + 0.3 / len(f)
    bias = {w: np.full(FILTERS, -0.2) for w in WIDTHS}
    out, out_bias = np.abs(rng.normal(0, 0.3, FILTERS * len(WIDTHS))), np.full(1, -3.0)
    memory = {id(x): np.full(x.shape, 1e-4) for x in [embedding, out, out_bias, *filters.values(), *bias.values()]}
    share = labels.mean() if len(labels) else 0.5
    weight = np.where(labels == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))

    def step(x: np.ndarray, grad: np.ndarray, rate: float, rows: np.ndarray | None = None) -> None:
        m = memory[id(x)]
        if rows is None:
            m += grad**2
            x -= rate * grad / np.sqrt(m)
        else:
            m[rows] += grad**2
            x[rows] -= rate * grad / np.sqrt(m[rows])

    for epoch in range(epochs):
        rate = 0.04 * (1 - epoch / epochs) + 0.004
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            grad_out, grad_bias = np.zeros_like(out), np.zeros(1)
            grad_filters = {w: np.zeros_like(f) for w, f in filters.items()}
            grad_fbias = {w: np.zeros(FILTERS) for w in WIDTHS}
            rows, row_grads = [], []
            for i in some:
                text = rows_of[i]
                top, where = [], []
                vectors = embedding[text[0]] + embedding[text[1]]
                for w, f in filters.items():
                    n = len(text[0]) - w + 1
                    if n < 1:
                        top.append(np.zeros(FILTERS))
                        where.append(None)
                        continue
                    sums = bias[w] + sum(vectors[j : j + n] @ f[j] for j in range(w))
                    best = sums.argmax(axis=0)
                    top.append(np.maximum(sums[best, np.arange(FILTERS)], 0))
                    where.append(best)
                hidden = np.concatenate(top)
                # a fifth of the filters rests in each step, so that no single one carries a class
                alive = rng.random(len(hidden)) < 0.8
                hidden = hidden * alive / 0.8
                error = weight[i] * (sigmoid(hidden @ out + out_bias)[0] - labels[i]) / len(some)
                grad_out += error * hidden
                grad_bias += error
                back = error * out * alive / 0.8 * (hidden > 0)
                for k, (w, f) in enumerate(filters.items()):
                    if where[k] is None:
                        continue
                    g = back[k * FILTERS : (k + 1) * FILTERS]
                    grad_fbias[w] += g
                    for j in range(w):
                        at_j = where[k] + j
                        grad_filters[w][j] += vectors[at_j].T * g
                        for half in text:
                            rows.append(half[at_j])
                            row_grads.append((f[j] * g).T)
            if rows:
                flat, back = np.concatenate(rows), np.concatenate(row_grads)
                own, which = np.unique(flat, return_inverse=True)
                summed = np.zeros((len(own), DIMENSION))
                np.add.at(summed, which, back)
                step(embedding, summed + 1e-4 * embedding[own], rate / 10, own)
            for w in WIDTHS:
                step(filters[w], grad_filters[w] + 1e-5 * filters[w], rate)
                step(bias[w], grad_fbias[w], rate)
            step(out, grad_out + 1e-5 * out, rate)
            step(out_bias, grad_bias, rate)
    return Model(embedding, filters, bias, out, float(out_bias[0]), np.zeros(len(LANGUAGES)))


def calibrate(model: Model, logits: np.ndarray, labels: np.ndarray, language: np.ndarray, rarity: float) -> None:
    """Sets each language's shift: the threshold with the best F1 over labelled texts, in the middle of its gap.

    rarity: how many unseen negatives one negative of the sample stands for. A language with under 20 texts of either
    label takes the threshold of all.
    """

    def best(x: np.ndarray, y: np.ndarray) -> float:
        order = np.argsort(-x, kind="stable")
        x, y = x[order], y[order]
        hits, alarms = np.cumsum(y == 1), np.cumsum(y == 0) * rarity
        f1 = 2 * hits / (hits + alarms + (y == 1).sum())
        f1[:-1][x[:-1] == x[1:]] = -1  # no threshold between equal scores
        k = int(f1.argmax())
        return float((x[k] + x[k + 1]) / 2) if k + 1 < len(x) else float(x[k]) - 1.0

    target = np.log(DECISION / (1 - DECISION))
    overall = best(logits, labels) if len(logits) else 0.0
    for n in range(len(LANGUAGES)):
        own = language == n
        enough = min((labels[own] == 1).sum(), (labels[own] == 0).sum()) >= 20
        model.shift[n] = target - (best(logits[own], labels[own]) if enough else overall)


def _features(texts: pa.Array) -> pa.Array:
    """Buckets and language of each text, for the sample."""
    buckets, language = [], []
    for data, offsets in slices(texts):
        words, doc = words_of(data, offsets)
        edge = np.searchsorted(doc, np.arange(len(offsets)))
        buckets += [words[a:b].astype("<u4").tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)]
        language += languages(data, offsets, words, doc).tolist()
    return pa.StructArray.from_arrays([pa.array(buckets, pa.binary()), pa.array(language, pa.int32())], ["words", "language"])


def _scorer(raw: bytes) -> Callable[[pa.Array], pa.Array]:
    state: dict = {}

    def score(texts: pa.Array) -> pa.Array:
        if not state:
            state["model"] = pickle.loads(raw)
            state["tables"] = state["model"].tables()
        model, out = state["model"], []
        for data, offsets in slices(texts):
            words, doc = words_of(data, offsets)
            logits = model.logits(words, doc, len(offsets) - 1, state["tables"])
            out.append(sigmoid(logits + model.shift[languages(data, offsets, words, doc)]))
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return score


def held_out(id: str) -> Column:
    """One third of the ids, by the crc32 of the id as text; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", per_label: int = SAMPLE_PER_LABEL) -> Model:
    """Trains on the labelled texts whose id is not held out: of each label the `per_label` with the smallest digests.

    The sample's ids are at most 2 x `per_label`, so they are broadcast and no text is shuffled; the driver gets the word
    buckets of these texts. Its texts are split in four: three parts train, one calibrates the thresholds.
    Null labels, ids without a text and ids not found are passed over. Without both labels every score is 0.5.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(id).isNotNull() & ~held_out(id))
    known = known.select(F.col(id).alias("__id"), F.col(label).cast("int").alias("__label"))
    digest = F.xxhash64(F.lit("sample"), "__id")
    counts = {r["__label"]: r["count"] for r in known.groupBy("__label").count().collect()}
    some = [known.filter(F.col("__label") == v).orderBy(digest, "__id").limit(per_label) for v in (0, 1)]
    chosen = F.broadcast(some[0].unionByName(some[1]).dropDuplicates(["__id"]))
    texts = docs.select(F.col(f"`{id}`").alias("__id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text")).join(chosen, "__id")
    features = F.arrow_udf(_features, "struct<words:binary,language:int>")(F.col("__text"))
    rows = texts.select("__id", "__label", digest.alias("place"), features.alias("f")).select("__id", "place", "__label", "f.*").collect()
    rows = sorted(rows, key=lambda r: (r["place"], str(r["__id"]), bytes(r["words"])))
    words = [np.frombuffer(bytes(r["words"]), "<u4") for r in rows]
    y, language = np.array([r["__label"] for r in rows]), np.array([r["language"] for r in rows])
    if len(set(y.tolist())) < 2:
        model = train([], np.zeros(0), epochs=0)
        model.out[:] = 0
        return model
    rarity = (counts[0] / (y == 0).sum()) / (counts[1] / (y == 1).sum())
    aside = np.arange(len(y)) % 4 == 3

    def logits(model: Model, which: np.ndarray) -> np.ndarray:
        picked = [words[i] for i in np.flatnonzero(which)]
        doc = np.repeat(np.arange(len(picked)), [len(w) for w in picked])
        return model.logits(np.concatenate(picked) if picked else np.zeros(0, np.uint32), doc, len(picked), model.tables())

    if min(np.bincount(y[~aside], minlength=2)) and aside.any():
        model = train([words[i] for i in np.flatnonzero(~aside)], y[~aside])
        calibrate(model, logits(model, aside), y[aside], language[aside], rarity)
        return model
    model = train(words, y)
    calibrate(model, logits(model, np.ones(len(y), bool)), y, language, rarity)
    return model


def score(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """Score from 0 to 1 of each whole text; null and empty texts get the score of no words."""
    slim = Model(model.embedding.astype(np.float32), model.filters, model.bias, model.out, model.out_bias, model.shift)
    return F.arrow_udf(_scorer(pickle.dumps(slim)), "double")(F.coalesce(F.col(f"`{text}`"), F.lit("")))

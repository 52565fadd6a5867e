import numpy as np
import pyarrow as pa

from gaugework.llm import toxicity
from gaugework.llm.queries import QUERIES


def plain(model, words):
    """Logit of one text by a loop over its windows."""
    vectors = model.embedding[(words & 0xFFFF).astype(int)] + model.embedding[(words >> 16).astype(int) + toxicity.BUCKETS]
    total, k = model.out_bias, 0
    for w, f in model.filters.items():
        top = np.zeros(toxicity.FILTERS)
        for i in range(len(words) - w + 1):
            top = np.maximum(top, model.bias[w] + sum(vectors[i + j] @ f[j] for j in range(w)))
        total += top @ model.out[k : k + toxicity.FILTERS]
        k += toxicity.FILTERS
    return total


def test_convolution_against_a_loop(monkeypatch):
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 2**32, n, np.uint64).astype(np.uint32) for n in (0, 1, 2, 3, 40, 200)]
    model = toxicity.train(texts, np.array([0, 1, 0, 1, 0, 1]), epochs=2)
    want = [plain(model, t) for t in texts]
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    for size in (1 << 16, 7):
        monkeypatch.setattr(toxicity, "CHUNK_WORDS", size)
        got = model.logits(np.concatenate(texts), doc, len(texts), model.tables())
        assert np.allclose(got, want, atol=1e-3)


def test_words_and_languages():
    f = toxicity._features(pa.array(["The IDIOT!! (idiot)", "", None, "der und die straße ß", "el niño ñ que", "le garçon est très ç"]))
    words = [np.frombuffer(x.as_py(), "<u4") for x in f.field(0)]
    assert words[0][1] == words[0][2] and [len(w) for w in words[1:3]] == [0, 0]
    assert [toxicity.LANGUAGES[i.as_py()] for i in f.field(1)] == ["en", "en", "en", "de", "es", "fr"]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op7_convolution"](spark, sf)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    known = rows.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert rows.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [r for r in known if r.held_out]
    clean = [r.predicted for r in held if r.toxic == 0]
    toxic = [r.predicted for r in held if r.toxic == 1]
    assert len(toxic) > 10 and np.mean(toxic) > 0.6 and np.mean(clean) < 0.03
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in known)


def test_nulls_empty_and_missing_labels(spark):
    rows = [(i, t) for i, t in enumerate([None, "", "you trash", "fine words", "you trash", "x " * 50_000])] + [(None, "you trash")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(2, 1), (3, 0), (77, 1), (None, 1), (4, None)], "doc_id bigint, toxic int")
    for known in (labels, labels.limit(0)):
        model = toxicity.fit(docs, known)
        got = docs.select("doc_id", toxicity.held_out("doc_id").alias("h"), toxicity.score(docs, model).alias("score")).collect()
        assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    empty = toxicity.fit(docs.limit(0), labels)
    assert docs.limit(0).select(toxicity.score(docs, empty)).count() == 0

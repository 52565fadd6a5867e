import random
import re

import pyarrow as pa
import pytest

from gaugework.llm import quality_rules as Q
from gaugework.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    """All measures of one text, from its definition."""
    text = text or ""
    words = WORD.findall(text)
    out = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    again = [line for i, line in enumerate(lines) if line in lines[:i]] if len(lines) < 2000 else _again(lines)
    out |= {"n_lines": len(lines), "n_dup_lines": len(again), "dup_line_chars": sum(map(len, again))}
    for n in (8, *Q.LENGTHS):
        places = {}
        for i in range(len(words) - n + 1):
            places.setdefault(tuple(words[i : i + n]), []).append(i)
        several = [p for p in places.values() if len(p) > 1]
        if "n_repeat_words" not in out:
            out["n_repeat_words"] = len({j for p in several for i in p for j in range(i, i + n)})
        later = {j for p in several for i in p[1:] for j in range(i, i + n)}
        out[f"dup_{n}gram_chars"] = sum(len(words[j]) for j in later)
    return out


def _again(lines):
    seen, out = set(), []
    for line in lines:
        if line in seen:
            out.append(line)
        seen.add(line)
    return out


def verdict(m, limits):
    failed = m["n_words"] < 20 or 100 * m["n_repeat_words"] > 30 * m["n_words"]
    share = lambda a, b: m[a] / m[b] if m[b] else 0.0
    good = share("n_dup_lines", "n_lines") <= limits.dup_lines and share("dup_line_chars", "word_chars") <= limits.dup_line_chars
    good = good and all(share(f"dup_{n}gram_chars", "word_chars") <= most for n, most in limits.dup_ngram_chars.items())
    return failed, not failed and good


def texts(seed, n):
    rng = random.Random(seed)
    parts = ["a", "b", "été", "#", "<x>", "😀", "one two three four five six", "a b c d e f g h i j k l", "\x1c", " "]
    gaps = [" ", " ", " ", "\n", "\t", "  ", "\r\n", "\n\n"]
    out = ["".join(rng.choice(parts) + rng.choice(gaps) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return [None, "", " \n", "\n", "x", *out, out[0], "same line\n" * 30, ("a b c d e f g h i j " * 3).strip()]


def test_measures_against_brute_force():
    for seed in range(6):
        some = texts(seed, 120)
        got = Q.measure(pa.array(some, pa.string())).to_pylist()
        for text, row in zip(some, got, strict=True):
            assert row == brute(text), text


def test_windows_do_not_cross_texts():
    line = "a b c d e f g h i j k l m n o p"
    for some in ([line] * 3, [line, "x\n" + line, line + " y"]):
        assert all(row == brute(text) for text, row in zip(some, Q.measure(pa.array(some)).to_pylist(), strict=True))


def test_a_text_of_ten_megabytes():
    rng = random.Random(1)
    lines = [" ".join(f"w{rng.randint(0, 10**7)}" for _ in range(12)) for _ in range(90_000)]
    text = "\n".join([*lines, *lines[:7000]])
    assert len(text) > 10_000_000
    (row,) = Q.measure(pa.array([text], pa.large_string())).to_pylist()
    assert row == brute(text) and row["n_dup_lines"] == 7000


def parity(n, flip):
    return "".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(n))


@pytest.mark.parametrize("n", [1024, 4096])
def test_sequences_that_meet_in_every_polynomial_hash_modulo_2_64(n):
    text = f"{parity(n, 0)}\n{parity(n, 1)}\n{' '.join(parity(n, 0))}\n{' '.join(parity(n, 1))}"
    (row,) = Q.measure(pa.array([text])).to_pylist()
    assert row["n_dup_lines"] == 0 and row == brute(text)


def test_tables(spark):
    good = " ".join(f"word{i}" for i in range(40))
    rows = [(1, good), (1, good), (None, good + " "), (2, None), (3, ""), (4, "few words"), (5, (good + "\n") * 3), (6, "x y z w " * 30)]
    docs = spark.createDataFrame([(i, t, "q", 9) for i, t in rows], "doc_id int, text string, quality string, n_words int")
    kept = Q.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text, r.quality, r.n_words) for r in kept.collect()) == [(0, good + " ", "q", 9), *[(1, good, "q", 9)] * 2]
    measured = Q.repetition(docs).collect()
    limits = Q.Limits()
    assert [(r.quality.base_failed, r.quality.kept) for r in measured] == [verdict(brute(t), limits) for _, t in rows]
    assert Q.keep_good(docs.limit(0)).count() == 0 and Q.repetition(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="windows"):
        Q.repetition(docs, limits=Q.Limits(dup_ngram_chars={3: 0.1}))


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op1_repetition"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    limits = Q.Limits()
    for d in docs:
        m = brute(d.text)
        row = got[d.doc_id].asDict()
        assert (row["base_failed"], row["kept"]) == verdict(m, limits)
        assert {k: v for k, v in row.items() if k in m} == {k: v for k, v in m.items() if k in row}
    assert 0 < sum(r.kept for r in got.values()) < len(got)

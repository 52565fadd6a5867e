import hashlib
import random
import re
import string
import time
from itertools import accumulate

from pyspark.sql import functions as F

from gaugework.llm import pii
from gaugework.llm.queries import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = [int(c) for c in value if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        twice = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(twice) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    found = []
    for n, (kind, pattern) in enumerate(PATTERNS.items()):
        found += [(m.start(), n, m.end()) for m in re.finditer(pattern, text or "") if valid(kind, m[0])]
    return sorted(found)


CASES = [
    None, "", "a@b.c_d@e.f x@@y.z foo@.com a@b-c.d.e. ..@a.b", "1.2.3.4.5.6.7.8 0255.001.1.1 256.1.1.1 1.2.3",
    "4111 1111-1111 1111 and 4111111111111112 0000000000000000", "+1 (017) 555-7713 +12 +1 23 45 67 89 01 ++44(0)20 7946 0958.",
    "é😀 +1 (017) 555-7713 ñ a.b@c.de 10.0.0.1", "9" * 5000, "x" * 50_000 + "@", "a.b" * 20_000, "1." * 20_000, "+1" + " " * 30_000 + "5",
    "mail m%1@x.y, 4012888888881881 12.34.56.78 +49 30 1234567 12.34.56.78 token = \"0f\"",
]


def test_base_spans_against_python(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(CASES)], "doc_id bigint, text string")
    model = pii.fit(docs)
    got = {r.doc_id: [(x.start, x.kind, x.end) for x in r.base_spans] for r in pii.find(docs, model).collect()}
    assert got == {i: brute(t) for i, t in enumerate(CASES)}


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op9_weak_supervision"](spark, sf).collect()
    assert len(rows) == len(texts)
    names = list(PATTERNS)
    for r in rows:
        want = brute(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, k, _ in want) for n in range(4)]
        base = [f"{names[k]}:{s}:{e}" for s, k, e in want]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(base) <= set(spans)
        secrets = [texts[r.doc_id][int(x.split(":")[1]) : int(x.split(":")[2])] for x in spans if x.startswith("secret")]
        assert sorted(secrets) == sorted(re.findall(r'(?:token|TOKEN) = "([0-9a-fA-F]{40})"', texts[r.doc_id]))


def test_reliabilities_are_recovered():
    """Votes drawn from known rates: the estimates come back, and a useless labeler is found out."""
    import itertools

    true_hit = {"shape": 0.95, "cue": 0.8, "assigned": 0.9, "varied": 0.5}
    true_alarm = {"shape": 0.05, "cue": 0.1, "assigned": 0.2, "varied": 0.5}
    counts = []
    for votes in itertools.product([0, 1], repeat=4):
        v = dict(zip(pii.VOTES, votes, strict=True))
        yes, no = 0.3, 0.7
        for name in pii.VOTES:
            yes *= true_hit[name] if v[name] else 1 - true_hit[name]
            no *= true_alarm[name] if v[name] else 1 - true_alarm[name]
        counts.append((v, 1e6 * (yes + no)))
    prior, hit, alarm, _ = pii.estimate(counts, 5000)
    assert abs(prior - 0.3) < 0.02
    assert all(abs(hit[v] - true_hit[v]) < 0.03 and abs(alarm[v] - true_alarm[v]) < 0.03 for v in pii.VOTES)


def test_redaction_and_clashing_columns(spark):
    rows = [(1, "mail a@b.cd, ip 10.0.0.1 é", "x", [1]), (1, "mail a@b.cd, ip 10.0.0.1 é", "x", [1]), (None, None, None, None), (2, "", "y", [])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string, row array<int>")
    got = pii.redact(docs, pii.fit(docs))
    assert got.columns == docs.columns
    assert [r.text for r in got.orderBy("doc_id").collect()] == [None, "mail <email>, ip <ip> é", "mail <email>, ip <ip> é", ""]


def test_empty_table_and_native_plan(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    found = pii.find(docs, pii.fit(docs))
    assert found.count() == 0
    plan = found._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_running_results(spark):
    for n in (0, 1, 2, 3, 10, 101):
        values = [(i * 7919) % 101 for i in range(n)]
        row = spark.createDataFrame([(values,)], "v array<bigint>").select(
            *(F.expr(pii._running("v", *how)).alias(name) for name, how in (("s", pii._SUM), ("m", pii._MOST), ("l", pii._LEAST)))
        ).first()
        assert row.s == list(accumulate(values)) and row.m == list(accumulate(values, max)) and row.l == list(accumulate(values, min))


def noise(rng, n):
    return " ".join("".join(rng.choices("aeiounstrlm", k=rng.randint(1, 14))).capitalize() if rng.random() < 0.1 else "".join(rng.choices("aeiounstrlm", k=rng.randint(1, 24))) for _ in range(n))


def test_secrets_of_several_shapes_are_found_and_prose_is_not(spark):
    """Recall and precision of the kind `secret` on planted credentials."""
    rng = random.Random(2)
    hexa, mixed, letters = "0123456789abcdef", string.ascii_letters + string.digits, string.ascii_letters
    make = [
        lambda: f'token = "{"".join(rng.choices(hexa, k=40))}"',
        lambda: f"api key: {''.join(rng.choices(mixed, k=32))}",
        lambda: f"token = {''.join(rng.choices(letters, k=80))}{''.join(rng.choices(hexa, k=40))}",
        lambda: f"secret='{''.join(rng.choices(mixed, k=24))}'",
        lambda: f"password = {''.join(rng.choices(string.ascii_lowercase, k=25))}",
    ]
    docs, planted = [], 0
    for i in range(600):
        parts = [noise(rng, rng.randint(5, 60))]
        if i % 3 == 0:
            parts += [make[i // 3 % len(make)](), noise(rng, 20)]
            planted += 1
        docs.append((i, " ".join(parts)))
    docs.append((1000, "password = correcthorsebatterystaple"))
    df = spark.createDataFrame(docs, "doc_id int, text string")
    found = {r.doc_id: [x.value for x in r.spans if x.kind == 4] for r in pii.find(df, pii.fit(df)).collect()}
    hits = sum(len(found[i]) == 1 and found[i][0] in docs[i][1] and len(found[i][0]) >= 24 for i in range(0, 600, 3))
    assert hits >= 0.95 * planted
    assert sum(bool(found[i]) for i in range(600) if i % 3) <= 2
    assert found[1000] == ["correcthorsebatterystaple"]


def test_many_matches_in_one_text(spark):
    numbers = " ".join(f"+1 555 {i:07d} word{i:06d}" for i in range(32_000))
    df = spark.createDataFrame([(1, numbers)], "doc_id int, text string")
    model = pii.fit(df)
    start = time.perf_counter()
    (row,) = pii.find(df, model).select(F.size("base_spans").alias("n"), F.element_at("base_spans", -1).alias("x")).collect()
    assert row.n == 32_000 and row.x.value == f"+1 555 {31999:07d}" and numbers[row.x.start : row.x.end] == row.x.value
    assert time.perf_counter() - start < 60


def test_candidates_beside_and_inside_base_spans(spark):
    texts = ["longname8.more@host-name.org abcdefgh12", "abcdefgh1234 1.2.3.4 x 4111 1111 1111 1111 abcdefgh12345", "4111-1111-1111-1111", "a@b.c " * 50 + "zzzzzzzz9"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for r in pii.with_base(df, "text").collect():
        base = [(x.start, x.end) for x in r["__base"]]
        want = [
            (m.start(), m.end(), texts[r.doc_id][max(0, m.start() - 32) : m.start()].lower())
            for m in re.finditer(r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{8,}", texts[r.doc_id])
            if not any(a < m.end() and m.start() < b for a, b in base)
        ]
        assert [(x.span.start, x.span.end, x.before) for x in r["__maybe"]] == want


def test_redaction_of_overlapping_spans(spark):
    text = "a1@b.cd +49 30 1234567 4111 1111 1111 1111 é 10.0.0.1, x@1.2.3.4 end"
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    model = pii.fit(df)
    spans = pii.find(df, model).first().spans
    out, at = "", 0
    for x in spans:
        if x.start >= at:
            out += text[at : x.start] + f"<{pii.KINDS[x.kind]}>"
        at = max(at, x.end)
    assert pii.redact(df, model).first().text == out + text[at:]

from gaugework.llm import licenses
from gaugework.llm.queries import ORACLES, QUERIES
from tests.compare import database, difference


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op2_canonical_digest"](spark, sf)
    assert difference(found, database(sf), ORACLES["op2_canonical_digest"]) is None
    assert found.filter("lines > 0").count() > 5


def test_variants_of_a_known_text(spark):
    name, mit = licenses.KNOWN[1]
    variants = [
        mit,
        "Copyright (c) 2019 A. Holder\n\n" + mit.upper(),
        "(c) someone\nAll rights reserved.\n" + mit.replace(", ", " ,\n * ").replace('"', "'"),
        mit.replace("sublicense", "sublicence") + "\n",
    ]
    others = [mit + " And more.", mit[1:], None, "", "licence licence licence", "Licenced under the Apache Licence, version 2.0!"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(variants + others)], "doc_id bigint, text string, license string")
    got = {r.doc_id: (r.license, r.notices) for r in licenses.scan(docs, licenses.known_texts(spark)).collect()}
    assert [got[i][0] for i in range(len(variants))] == [name] * len(variants)
    assert [got[i] for i in range(4, 9)] == [(None, "")] * 5
    assert got[9] == ("Apache-2.0", "Apache-2.0")


def test_repeats_null_ids_and_empty_tables(spark):
    known = licenses.known_texts(spark)
    line = "Released under the MIT License."
    rows = [(1, f"a\n{line}\n{line}"), (1, f"a\n{line}\n{line}"), (1, "b"), (None, line), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((str(r.doc_id), str(r.license), r.lines, r.notices) for r in licenses.scan(docs, known).collect())
    assert got == [("1", "None", 0, ""), ("1", "None", 2, "MIT,MIT"), ("1", "None", 2, "MIT,MIT"), ("None", "MIT", 1, "MIT"), ("None", "None", 0, "")]
    assert licenses.scan(docs.limit(0), known).count() == 0
    assert licenses.scan(docs, known.limit(0)).filter("license is not null or lines > 0").count() == 0


def test_usual_files_of_common_licenses(spark):
    by = dict(reversed(licenses.known_licenses()))
    mit, texts = licenses.KNOWN[1][1], {f.stem: f.read_text() for f in licenses.Path(licenses.__file__).with_name("license_texts").glob("*.txt")}
    wrapped = {n: "\n".join(licenses.re.sub(r"(.{1,60})(?: |$)", r"\1\n", p) for p in texts[n].split("\n")) for n in ("BSD-2-Clause", "BSD-3-Clause", "ISC")}
    cases = [
        ("MIT", "MIT License\n\nCopyright (c) 2020 A. Holder\n\n" + mit),
        ("MIT", "Copyright (c) 2020 A. Holder\n\nThe MIT License (MIT)\n\n" + mit.replace("sublicense", "sub-license")),
        ("MIT", mit.replace("sublicense", "sub\nlicense")),
        ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright 2021, B\nAll rights reserved.\n\n" + wrapped["BSD-3-Clause"]),
        ("BSD-3-Clause", texts["BSD-3-Clause"].replace("HOLDER OR", "OWNER OR").replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")),
        ("BSD-2-Clause", wrapped["BSD-2-Clause"]),
        ("ISC", "ISC License\n\n" + wrapped["ISC"]),
        ("Apache-2.0", texts["Apache-2.0"]),
        ("Apache-2.0", texts["Apache-2.0"].split("   APPENDIX")[0]),
        *((n, t) for n, t in texts.items()),
        (None, "MIT License"),
        (None, "Apache License\n\n" + mit),
        (None, texts["GPL-3.0"].replace("free software", "software", 1)),
    ]
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MIT"} <= by.keys()
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)], "doc_id bigint, text string")
    got = {r.doc_id: r.license for r in licenses.scan(docs, licenses.known_texts(spark)).collect()}
    assert [got[i] for i in range(len(cases))] == [n for n, _ in cases]


def test_texts_without_the_usual_words_and_empty_ones_in_the_table(spark):
    known = spark.createDataFrame([("WTFPL", "You just do what the fuck you want to."), ("none", "Copyright (c) 2020 X")], "license string, text string")
    docs = spark.createDataFrame([(1, "a\nYou just DO what the fuck you want to"), (2, "\n\n"), (3, "you just do what the fuck you want to")], "doc_id bigint, text string")
    got = {r.doc_id: (r.license, r.lines, r.notices) for r in licenses.scan(docs, known).collect()}
    assert got == {1: (None, 1, "WTFPL"), 2: (None, 0, ""), 3: ("WTFPL", 1, "WTFPL")}

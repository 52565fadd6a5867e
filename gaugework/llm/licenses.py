"""Licence scan: whole texts and their notices are brought to a canonical form and looked up by digest."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugework.llm.common import stored

#: Short licences in full and usual notices; the SQL below looks up these alone.
KNOWN = [
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
]

#: Spellings that licence matching guidelines treat as equal, after lower-casing and the loss of punctuation.
EQUAL = {
    "licence": "license", "licenced": "licensed", "licences": "licenses", "acknowledgement": "acknowledgment", "analogue": "analog",
    "authorisation": "authorization", "authorised": "authorized", "behaviour": "behavior", "centre": "center", "favour": "favor",
    "fulfil": "fulfill", "initialise": "initialize", "judgement": "judgment", "labour": "labor",
    "modelling": "modeling", "noncommercial": "non commercial", "organisation": "organization", "organisations": "organizations",
    "percent": "per cent", "practise": "practice", "recognise": "recognize", "redistribution": "redistribution", "sublicence": "sublicense",
    "utilisation": "utilization", "whilst": "while", "wilful": "willful", "http": "https",
}

#: More of them, which the SQL below does without. All parts of a word are brought to two words, so that a hyphen is no matter.
MORE_EQUAL = {
    "analyse": "analyze", "artefact": "artifact", "artefacts": "artifacts", "authorisations": "authorizations", "calibre": "caliber",
    "cancelled": "canceled", "capitalisations": "capitalizations", "catalogue": "catalog", "categorise": "categorize",
    "defence": "defense", "emphasised": "emphasized", "favourite": "favorite", "fulfilment": "fulfillment", "honour": "honor",
    "initialised": "initialized", "judgements": "judgments", "labelling": "labeling", "licencing": "licensing", "licencor": "licensor",
    "licencee": "licensee", "maximise": "maximize", "modelled": "modeled",
    "noninfringement": "non infringement", "offence": "offense", "optimise": "optimize", "organise": "organize", "programme": "program",
    "realise": "realize", "recognised": "recognized", "signalling": "signaling", "sublicense": "sub license",
    "sublicensed": "sub licensed", "sublicenced": "sub licensed", "sublicenses": "sub licenses", "sublicences": "sub licenses",
    "sublicensing": "sub licensing", "sublicencing": "sub licensing", "sublicensable": "sub licensable",
    "sublicensee": "sub licensee", "sublicensees": "sub licensees", "utilise": "utilize",
}

# Lines that name a holder and not a licence, bounded by line breaks or the ends of the text.
_HOLDER = r"(?m)^[ \t>*#/;-]*(?:copyright\b|\(c\)|©|all rights reserved)[^\n]*$"
# The same without lines of a wrapped licence that begin with such a word, and with the addresses in the GNU licences.
_GOES_ON = (
    r"(?![ \t,.;:)'\"-]*(?:$|(?:holders?|owners?|notices?|licen[cs]es?|licensors?|laws?|interests?|treaty|statements?|disclaimers?|claims?|status|protection"
    r"|permission|doctrine|and|or|in|on|to|for|under|if|any|each|an|all|of|you|your|that|this|these|such|is|are|may|must|shall|will|with|as|not|other|it|its"
    r"|(?:the|a) (?:software|program|work|library|licen[cs]e|source|entire|modified|name|date|fact|recipient|copyright|covered|terms))\b))"
)
_HOLDERS = rf"(?m)^[ \t>*#/;-]*(?:(?:copyright\b|\(c\)){_GOES_ON}|©|all rights reserved|51 franklin st|59 temple pl|675 mass ave)[^\n]*$"
_MARKS = r"[^\p{L}\p{N}]+"
_MARKS_IN_LINE = r"[^\p{L}\p{N}\n]+"
#: The SQL below looks only at texts and lines with one of these words.
HINT = r"(?i)licen[cs]|copyright|warrant|permission"


def _words(text: Column) -> Column:
    """Lower-case words with two blanks between them and single line breaks."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), _HOLDERS, " "), _MARKS_IN_LINE, "  ")
    return F.concat(F.lit(" "), F.replace(plain, F.lit("\n"), F.lit(" \n ")), F.lit(" "))  # every word has blanks of its own


def _usual(words: Column) -> Column:
    """Of a text or a line: equal spellings as one, an owner of copyright as a holder, one blank between words."""
    for spelling, usual in (EQUAL | MORE_EQUAL).items():
        words = F.replace(words, F.lit(f" {spelling} "), F.lit(f" {usual.replace(' ', '  ')} "))
    return F.trim(F.replace(F.regexp_replace(words, "[ \n]+", " "), F.lit(" copyright owner"), F.lit(" copyright holder")))


def _spelled_once(words: Column) -> Column:
    """All words but those that `_usual` changes or puts in: equal for texts of one canonical form, and one regex."""
    by: dict[str, list[str]] = {}
    for word in sorted({w for pair in (EQUAL | MORE_EQUAL).items() for phrase in pair for w in phrase.split()}):
        by.setdefault(word[0], []).append(word[1:])
    listed = "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in by.items())
    return F.regexp_replace(F.regexp_replace(words, f" (?:{listed}|(?:owner|holder)[^ \n]*) ", " "), " +", " ")


def canonical(text: Column) -> Column:
    """Lower case, no copyright lines, punctuation and white space as one blank, equal spellings as one."""
    return _usual(_words(text))


def canonical_sql(text: str) -> str:
    """The same in plain SQL, with the spellings in EQUAL and the plain rule for copyright lines."""
    plain = f"' ' || regexp_replace(regexp_replace(lower({text}), '{_HOLDER}', ' ', 'g'), '{_MARKS}', '  ', 'g') || ' '"
    for spelling, usual in EQUAL.items():
        plain = f"replace({plain}, ' {spelling} ', ' {usual} ')"
    return f"trim(regexp_replace({plain}, ' +', ' ', 'g'))"


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def _mark(rest: Column) -> Column:
    """One of MARKS short digests of what `_spelled_once` leaves, as a filter in front of the long ones."""
    return F.crc32(rest.cast("binary")) % MARKS


MARKS = 1 << 16


def known_digests(known: DataFrame) -> DataFrame:
    """(license, digest, mark) of a table (license, text); of licences with one canonical text the first name stands, and
    texts of no words are left out."""
    plain = known.select("license", canonical(F.col("text")).alias("plain")).filter("plain <> ''")
    apart = F.concat(F.lit(" "), F.replace("plain", F.lit(" "), F.lit("  ")), F.lit(" "))
    rows = plain.select("license", F.sha2("plain", 256).alias("digest"), _mark(F.trim(_spelled_once(apart))).alias("mark"))
    return rows.groupBy("digest", "mark").agg(F.min("license").alias("license"))


#: Titles under which short licences stand; the long ones have theirs in the text.
TITLES = {
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "BSD 0-Clause License", "Zero-Clause BSD License (0BSD)", "0BSD License"],
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "License: MIT", "MIT", "Expat License", "The Expat License", "MIT/X11 License"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)", "ISC"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "BSD 2-Clause \"Simplified\" License", "Simplified BSD License", "FreeBSD License", "BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "BSD 3-Clause \"New\" or \"Revised\" License", "New BSD License", "Modified BSD License", "Revised BSD License", "BSD License"],
}


def forms(license: str, text: str) -> list[str]:
    """The forms in which a licence is handed on: with and without title, numbers of its clauses, and what follows its terms."""
    ends = re.search(r"END OF TERMS AND CONDITIONS", text)
    bodies = [text, *([text[: ends.end()], text[: ends.start()]] if ends else [])]
    if license in TITLES:
        bodies += [re.sub(r"(?m)^[0-9][.)] ", "", b) for b in bodies]
        return [*bodies, *(f"{t}\n\n{b}" for t in TITLES[license] for b in bodies)]
    # the long ones: their first block of lines is the title
    return [*bodies, *(rest for b in bodies for rest in re.split(r"\n[ \t]*\n", b.lstrip(), maxsplit=1)[1:])]


def known_licenses() -> list[tuple[str, str]]:
    """KNOWN and the whole texts beside this file, in all their forms."""
    files = sorted(Path(__file__).with_name("license_texts").glob("*.txt"))
    whole = [(f.stem, f.read_text("utf-8")) for f in files] + [(name, text) for name, text in KNOWN if "\n" in text]
    return [*KNOWN, *((name, form) for name, text in whole for form in forms(name, text))]


def known_texts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(known_licenses(), "license string, text string")


def scan(docs: DataFrame, known: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, license, lines, notices) of every document: the licence that its entire text is, or null; how many of its
    lines are a licence's entire text; and the licences of these lines, in order, joined by commas.

    `known` is a table (license, text), titles included where texts come with them; digests are joined, and Spark
    broadcasts the table only where it knows it to be small. Every text and every line is looked up, a line as a text of its
    own: those whose words apart from the spellings have a short digest that is none of the table's cannot match. Null and empty texts
    have no licence and no lines. Repeated rows have equal results; rows with one id and different texts have their own.
    Other columns are left out. The texts are read once and not shuffled: only digests are.
    """
    codes = stored(known_digests(known), "licenses")
    marks = [r.mark for r in codes.select("mark").distinct().collect()]  # at most MARKS numbers
    codes = codes.drop("mark")
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    plain = docs.select(F.col(f"`{id}`").alias("id"), F.xxhash64(t).alias("of"), _words(t).alias("words"))
    plain = plain.withColumn("rest", _spelled_once(F.col("words")))
    plain = plain.withColumn("whole", F.trim(F.regexp_replace("rest", "[ \n]+", " "))).withColumn("parts", F.split("rest", "\n"))
    hits = F.transform("parts", lambda x: _mark(F.trim(x)).isin(marks))
    plain = plain.withColumn("hits", hits).withColumn("any", F.exists("hits", lambda x: x))
    lines = F.filter(F.split("words", "\n"), lambda x, i: F.get("hits", i))
    rows = plain.select(
        "id",
        "of",
        F.when(_mark(F.col("whole")).isin(marks), F.sha2(_usual(F.col("words")), 256)).alias("whole"),
        F.when(F.col("any"), F.transform(lines, lambda x: F.sha2(_usual(x), 256))).alias("wanted"),
    )
    rows = stored(rows, "digests")
    exploded = rows.filter("size(wanted) > 0").select("id", "of", F.posexplode("wanted").alias("at", "digest"))
    matched = exploded.join(codes, "digest").distinct().groupBy("id", "of").agg(F.sort_array(F.collect_list(F.struct("at", "license"))).alias("m"))
    notices = matched.select(
        F.col("id").alias("m_id"),
        F.col("of").alias("m_of"),
        F.size("m").cast("bigint").alias("lines"),
        F.array_join(F.transform("m", lambda x: x["license"]), ",").alias("notices"),
    )
    found = rows.join(codes.withColumnsRenamed({"digest": "whole"}), "whole", "left")
    found = found.join(notices, F.col("id").eqNullSafe(F.col("m_id")) & (F.col("of") == F.col("m_of")), "left")
    return found.select(F.col("id").alias(id), "license", F.coalesce("lines", F.lit(0)).alias("lines"), F.coalesce("notices", F.lit("")).alias("notices"))


def scan_sql(documents: str = "documents") -> str:
    """The scan with KNOWN alone, in plain SQL; every doc_id is taken to be one row."""
    known = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in KNOWN)
    hint = HINT.replace("(?i)", "")
    return f"""
WITH codes AS (SELECT min(license) AS license, digest FROM (SELECT license, sha256({canonical_sql("text")}) AS digest FROM (VALUES {known}) k(license, text)) GROUP BY digest),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM {documents} WHERE regexp_matches(text, '{hint}', 'i')),
notices AS (SELECT doc_id, count(*) AS lines, string_agg(license, ',' ORDER BY pos) AS notices
  FROM (SELECT doc_id, pos, sha256({canonical_sql("line")}) AS digest FROM lines WHERE regexp_matches(line, '{hint}', 'i')) JOIN codes USING (digest) GROUP BY doc_id),
texts AS (SELECT doc_id, CASE WHEN regexp_matches(coalesce(text, ''), '{hint}', 'i') THEN sha256({canonical_sql("text")}) END AS digest FROM {documents})
SELECT doc_id, license, coalesce(lines, 0)::BIGINT AS lines, coalesce(notices, '') AS notices
FROM texts LEFT JOIN codes USING (digest) LEFT JOIN notices USING (doc_id)"""

"""Personal data by weak supervision: labelers vote on candidates, expectation-maximisation weighs them, a classifier decides.

Everything that touches rows is a column expression. The driver sees one table of counts by votes and features, whose
size is bounded by their number of values.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns, each as in the contract but tried once for each run of characters: a match can only begin where a run
# begins or where the match before ended (\G), and possessive quantifiers give nothing back, so long runs cost linear time.
BASE = {
    "email": ("@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (".", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (None, r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": ("+", r"\+[0-9][\x20().0-9-]+[0-9]"),
}
SECRET = "secret"
KINDS = [*BASE, SECRET]

BEFORE = 32
#: Gazetteer of words that announce a credential, in the four languages of the corpus.
CUES = ["token", "secret", "password", "passwd", "pwd", "key", "auth", "bearer", "credential", "passwort", "kennwort", "schlüssel",
        "jeton", "clé", "mot de passe", "clave", "contraseña", "session", "cookie", "signature"]
_RUN = "[A-Za-z0-9_+/-]"
# Words, also with hyphens or slashes, in lower case, capitalised or in upper case.
_PLAIN = "(?:[-/]*+[A-Z]?[a-z]*+(?:[-/]++[A-Z]?[a-z]*+)*+|[A-Z/-]*+)"
_CUE = f"(?i:{'|'.join(CUES)})[^\\p{{L}}0-9]{{1,12}}"
_LEFT = "(^|[^\\p{L}])"
_ASSIGNED = "[=:][ \\t]{0,4}[\"'`]?"
#: A candidate is a whole run of eight or more such characters that some labeler or feature says something of: it is no plain
#: word, or it stands behind a cue, an assignment or a quote.
_BEGIN = f"(?<!{_RUN})(?={_RUN}{{8}})(?:(?!{_PLAIN}(?!{_RUN}))|(?<=[\"'`])|(?<={_ASSIGNED})"
CANDIDATE = f"{_BEGIN}|(?<={_CUE})){_RUN}++"
#: The same for texts without any cue, where looking behind every word for one is left out.
UNCUED = f"{_BEGIN}){_RUN}++"
#: A text without any of these has no candidate but behind a cue: a run without them is a plain word, and unassigned.
_MAYBE = "[0-9_+=:\"'`]|[A-Za-z][A-Z]"
#: Least lengths of the classes of candidates.
_LENGTHS = (8, 16, 32, 48)
VOTES = ["shape", "cue", "assigned", "varied"]
FEATURES = ["length", "digits", "quoted", "hex", "cue", "assigned"]


def _spans(text: Column, patterns: list[tuple[Column, str]], kind: int) -> Column:
    """The matches, and what lies between them, of the first pattern whose gate is open; none without."""
    empty = F.array().cast("array<string>")
    found = parts = F
    for gate, pattern in patterns:
        found = found.when(gate, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
        parts = parts.when(gate, F.split(text, pattern, -1))
    found, parts = found.otherwise(empty), parts.otherwise(empty)
    return F.struct(found.alias("found"), parts.alias("parts"), F.lit(kind).alias("kind"))


SPAN = "struct<start:bigint,kind:int,end:bigint,value:string>"


def _let(name: str, value: str, body: str) -> str:
    """SQL: `body` with `name` for a value that is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _running(values: str, step: str, first: str) -> str:
    """SQL: running results of `step` (of `{a}` so far and the next `x`) over an array of bigint, beginning with `first`.

    An array grows by copies; blocks of the square root of its size keep these few for any number of matches.
    """
    grown = f"(r, x) -> concat(r, array({step.format(a='try_element_at(r, -1)')}))"
    blocks = f"transform(sequence(0, (size(v) - 1) div w), k -> aggregate(slice(v, cast(k * w + 1 AS int), cast(w AS int)), array({first}), {grown}))"
    heads = f"aggregate(b, array({first}), (r, y) -> {_let('x', 'element_at(y, -1)', 'concat(r, array(' + step.format(a='element_at(r, -1)') + '))')})"
    joined = f"flatten(transform(b, (y, k) -> transform(slice(y, 2, size(y) - 1), x -> {step.format(a='h[k]')})))"
    body = _let("b", blocks, _let("h", heads, joined))
    body = _let("w", "ceil(sqrt(size(v)))", body)
    return _let("v", values, f"CASE WHEN size(v) = 0 THEN v ELSE {body} END")


_SUM = ("{a} + x", "0L")
_MOST = ("greatest({a}, x)", "-1L")
_LEAST = ("least({a}, x)", "9223372036854775807L")


def _list(pair: str, more: str = "", kind: str = SPAN) -> Column:
    """The matches with their places, from the lengths of matches and of what lies between them."""
    last = f"size({pair}.found) - 1"
    lengths = f"transform(sequence(0, {last}), i -> cast(length({pair}.parts[i]) + length({pair}.found[i]) AS bigint))"
    span = f"""named_struct('start', e[i] - length({pair}.found[i]), 'kind', {pair}.kind, 'end', e[i], 'value', {pair}.found[i])"""
    span = more.format(span=span) if more else span
    placed = _let("e", _running(lengths, *_SUM), f"transform(sequence(0, {last}), i -> {span})")
    return F.expr(f"CASE WHEN size({pair}.found) = 0 THEN cast(array() AS array<{kind}>) ELSE {placed} END")


# Which matches of the base patterns count, as SQL on a span x.
_DIGITS = "regexp_replace(x.value, '[^0-9]', '')"
_LUHN = f"""aggregate(sequence(1, length({_DIGITS})), 0, (s, i) -> s + CASE WHEN i % 2 = 1
    THEN cast(substring({_DIGITS}, -i, 1) AS int)
    ELSE cast(substring({_DIGITS}, -i, 1) AS int) * 2 - CASE WHEN cast(substring({_DIGITS}, -i, 1) AS int) > 4 THEN 9 ELSE 0 END END) % 10 = 0"""
VALID = {
    "email": "true",
    "ip": r"forall(split(x.value, '[.]'), p -> length(ltrim('0', p)) <= 3 AND coalesce(try_cast(ltrim('0', p) AS int), 0) <= 255)",
    "card": f"CASE WHEN length({_DIGITS}) BETWEEN 14 AND 19 THEN {_LUHN} ELSE false END",
    "phone": f"length({_DIGITS}) BETWEEN 10 AND 15",
}


CANDIDATE_SPAN = f"struct<span:{SPAN},before:string>"
#: A candidate with the BEFORE characters in front of it: four candidates back there are at least as many.
_BEFORE = "concat_ws('', " + ", ".join(f"get(__candidate.{x}, i - {n})" for n in (4, 3, 2, 1) for x in ("parts", "found")) + ", __candidate.parts[i])"
_WITH_BEFORE = "named_struct('span', {span}, 'before', " + f"lower(right({_BEFORE}, {BEFORE})))"


def _apart() -> str:
    """SQL: the candidates that overlap no base span.

    Both are put in order of their starts. A candidate overlaps one that begins no later if that ends behind its start (the
    largest end so far), or one that begins later if that begins before its end (the smallest start from there on).
    """
    merged = """array_sort(concat(
        transform(__base, b -> named_struct('start', b.start, 'type', 0, 'end', b.end, 'i', -1)),
        transform(__candidate, (c, i) -> named_struct('start', c.span.start, 'type', 1, 'end', c.span.end, 'i', i))))"""
    ends = _running("transform(m, x -> CASE WHEN x.type = 0 THEN x.end ELSE -1L END)", *_MOST)
    starts = f"reverse({_running('reverse(transform(m, x -> CASE WHEN x.type = 0 THEN x.start ELSE 9223372036854775807L END))', *_LEAST)})"
    kept = "filter(m, (x, j) -> x.type = 1 AND before[j] <= x.start AND after[j] >= x.end)"
    chosen = _let("m", merged, _let("before", ends, _let("after", starts, f"transform({kept}, x -> __candidate[x.i])")))
    return f"CASE WHEN size(__base) = 0 OR size(__candidate) = 0 THEN __candidate ELSE {chosen} END"


def with_base(docs: DataFrame, text: str) -> DataFrame:
    """Adds `__base`, the valid base spans in order, and `__maybe`, the candidates that overlap none of them."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    digit = t.rlike("[0-9]")
    pairs = []
    for n, (kind, (sign, pattern)) in enumerate(BASE.items()):
        gate = t.contains(sign) if sign == "@" else digit if sign is None else digit & t.contains(sign)
        pairs.append(_spans(t, [(gate, pattern)], n).alias(f"__{kind}"))
    lower = F.lower(t)
    cued = reduce(lambda a, b: a | b, [lower.contains(c) for c in CUES])
    pairs.append(_spans(t, [(cued, CANDIDATE), (t.rlike(_MAYBE), UNCUED)], len(BASE)).alias("__candidate"))
    found = docs.select("*", *pairs)
    lists = [_list(f"__{k}").alias(f"__{k}") for k in BASE]
    found = found.select(*docs.columns, *lists, _list("__candidate", _WITH_BEFORE, CANDIDATE_SPAN).alias("__candidate"))
    valid = F.concat(*(F.expr(f"filter(__{k}, x -> {VALID[k]})") for k in BASE))
    found = found.select(*docs.columns, F.array_sort(valid).alias("__base"), "__candidate")
    return found.select(*docs.columns, "__base", F.expr(_apart()).alias("__maybe"))


def _sql(pattern: str) -> str:
    """A pattern inside a string literal of SQL."""
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def _signals(m: str) -> dict[str, str]:
    """SQL of the labelers' votes and the classifier's features on a candidate."""
    value, before = f"{m}.span.value", f"{m}.before"
    digits = f"length(regexp_replace({value}, '[^0-9]', '')) / length({value})"
    # plain words have no shape of a credential however long and varied they are
    plain = f"({value} rlike '^{_PLAIN}$')"
    return {
        "shape": f"(NOT {plain} AND {value} rlike '^([0-9a-f]{{32,}}|[0-9A-F]{{32,}}|(?=.*[A-Za-z])[A-Za-z0-9_+/-]{{20,}})$')",
        "cue": f"({before} rlike '{_sql(_LEFT + _CUE + '$')}')",
        "assigned": f"({before} rlike '{_sql(_ASSIGNED + '$')}')",
        "varied": f"(NOT {plain} AND size(array_distinct(split(lower({value}), ''))) >= 10)",
        "length": "CASE " + " ".join(f"WHEN length({value}) < {n} THEN {i}" for i, n in enumerate(_LENGTHS[1:])) + " ELSE 3 END",
        "digits": f"CASE WHEN {digits} = 0 THEN 0 WHEN {digits} < 0.25 THEN 1 WHEN {digits} < 0.85 THEN 2 ELSE 3 END",
        "quoted": f"({before} rlike '[\"\\'`]$')",
        "hex": f"(lower({value}) rlike '^[0-9a-f]+$' AND {value} rlike '[A-Fa-f]')",
    }


@dataclass(frozen=True)
class Model:
    """prior: share of personal data among candidates; hit and alarm: each labeler's rate of votes on it and on the rest;
    weights: log-odds of the classifier by feature and value; bias: its constant."""

    prior: float
    hit: dict[str, float]
    alarm: dict[str, float]
    weights: dict[str, dict[int, float]]
    bias: float


def estimate(counts: list[tuple[dict[str, int], float]], rounds: int = 200) -> tuple[float, dict[str, float], dict[str, float], list[float]]:
    """Expectation-maximisation over vote patterns. A prior of eight right votes to two keeps the two classes in place."""
    total = sum(n for _, n in counts)
    prior, hit, alarm = 0.5, dict.fromkeys(VOTES, 0.8), dict.fromkeys(VOTES, 0.2)
    post: list[float] = []
    for _ in range(rounds):
        post = []
        for votes, _n in counts:
            yes, no = prior, 1 - prior
            for v in VOTES:
                yes *= hit[v] if votes[v] else 1 - hit[v]
                no *= alarm[v] if votes[v] else 1 - alarm[v]
            post.append(yes / (yes + no))
        on = sum(p * n for p, (_, n) in zip(post, counts, strict=True))
        last = prior
        prior = (on + 1) / (total + 2)
        for v in VOTES:
            hit[v] = (sum(p * n for p, (x, n) in zip(post, counts, strict=True) if x[v]) + 8) / (on + 10)
            alarm[v] = (sum((1 - p) * n for p, (x, n) in zip(post, counts, strict=True) if x[v]) + 2) / (total - on + 10)
        if abs(prior - last) < 1e-12:
            break
    return prior, hit, alarm, post


def fit(docs: DataFrame, text: str = "text") -> Model:
    """Learns from all runs of all whole texts, without labels: one aggregation of the candidates, one row for each mix of
    values, and one that counts the other runs under and from 16 characters, for which no labeler votes."""
    names = list(dict.fromkeys([*VOTES, *FEATURES]))
    # the outer form: for the inner one a filter on the list is put below, which would compute it once more
    maybe = with_base(docs.select(F.col(f"`{text}`").alias("text")), "text").select(F.explode_outer("__maybe").alias("m"))
    maybe = maybe.filter("m is not null")
    signals = _signals("m")
    rows = maybe.select(*(F.expr(signals[n]).cast("int").alias(n) for n in names)).groupBy(*names).count().collect()
    rows = [r.asDict() for r in rows]
    t = F.col(f"`{text}`")
    at_least = [F.sum(F.regexp_count(t, F.lit(f"(?<!{_RUN}){_RUN}{{{n},}}+"))) for n in _LENGTHS[:2]]
    runs = [n or 0 for n in docs.agg(*at_least).first()]
    for i, n in enumerate(runs):
        others = n - (runs[i + 1] if i + 1 < len(runs) else 0) - sum(r["count"] for r in rows if r["length"] == i)
        if others > 0:
            rows.append({**dict.fromkeys(names, 0), "length": i, "count": others})
    rows = sorted(rows, key=lambda r: tuple(r[n] for n in names))
    prior, hit, alarm, post = estimate([({v: r[v] for v in VOTES}, r["count"]) for r in rows])
    weights: dict[str, dict[int, float]] = {}
    on = sum(p * r["count"] for p, r in zip(post, rows, strict=True))
    off = sum((1 - p) * r["count"] for p, r in zip(post, rows, strict=True))
    for f in FEATURES:
        values = range({"length": 4, "digits": 4}.get(f, 2))
        yes = {v: 1 + sum(p * r["count"] for p, r in zip(post, rows, strict=True) if r[f] == v) for v in values}
        no = {v: 1 + sum((1 - p) * r["count"] for p, r in zip(post, rows, strict=True) if r[f] == v) for v in values}
        weights[f] = {v: math.log(yes[v] / (on + len(values))) - math.log(no[v] / (off + len(values))) for v in values}
    return Model(prior, hit, alarm, weights, math.log((on + 1) / (off + 1)))


def _score(model: Model, m: str) -> str:
    signals = _signals(m)
    terms = [repr(model.bias)]
    for f, by_value in model.weights.items():
        cases = " ".join(f"WHEN {v} THEN {w!r}" for v, w in by_value.items())
        terms.append(f"CASE cast(({signals[f]}) AS int) {cases} ELSE 0 END")
    return " + ".join(f"cast({t} AS double)" for t in terms)


def find(docs: DataFrame, model: Model, text: str = "text", odds: float = 0.0) -> DataFrame:
    """The documents with `base_spans` and `spans`: arrays of (start, kind, end, value) by start, then kind.

    `kind` counts the names in KINDS. Base spans are the valid matches of the base patterns; `spans` adds the candidates
    whose log-odds under the classifier exceed `odds`. A candidate is a run of eight or more letters, digits and `_+/-`
    that is no plain word or stands behind a cue, an assignment or a quote; of other runs no labeler says anything. Null and empty texts have empty arrays; repeated rows and extra columns
    pass through, columns of the two names are replaced. Matches are found row by row: nothing is shuffled. Work grows with
    the text, and with the number of matches to the power of 1.5.
    """
    keep = [c for c in docs.columns if c not in ("base_spans", "spans")]
    shielded = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("__row"), F.col(f"`{text}`").alias("__text"))
    found = with_base(shielded, "__text")
    more = F.expr(f"transform(filter(__maybe, m -> {_score(model, 'm')} > {odds!r}D), m -> m.span)")
    return found.select("__row.*", F.col("__base").alias("base_spans"), F.array_sort(F.concat("__base", more)).alias("spans"))


def named(spans: str) -> Column:
    """kind:start:end of each span, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.col(spans), lambda x: F.concat_ws(":", F.element_at(kinds, x["kind"] + 1), x["start"], x["end"])), ",")


def redact(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents with <kind> in place of every span; of overlapping spans the first names the whole stretch.

    A null text stays null. All columns keep their names, types and order.
    """
    shielded = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("text"))
    kinds = ", ".join(f"'<{k}>'" for k in KINDS)
    # each span is cut out by the places of the text between spans; of overlapping spans only those that begin behind all ends
    ends = _running("transform(spans, x -> x.end)", *_MOST)
    outer = "filter(spans, (x, i) -> i = 0 OR x.start >= e[i - 1])"
    reach = "transform(filter(sequence(0, size(spans) - 1), i -> i = size(spans) - 1 OR spans[i + 1].start >= e[i]), i -> e[i])"
    piece = "concat(substring(text, cast(u[i - 1] + 1 AS int), cast(o[i].start - u[i - 1] AS int)), element_at(array({kinds}), o[i].kind + 1))"
    masked = F.expr(
        "CASE WHEN size(spans) = 0 THEN text ELSE "
        + _let(
            "e", ends,
            _let("o", outer, _let("u", reach, f"""concat(
                substring(text, 1, cast(o[0].start AS int)), element_at(array({kinds}), o[0].kind + 1),
                CASE WHEN size(o) = 1 THEN '' ELSE array_join(transform(sequence(1, size(o) - 1), i -> {piece.format(kinds=kinds)}), '') END,
                substring(text, cast(element_at(u, -1) + 1 AS int)))""")),
        )
        + " END"
    )
    found = find(shielded, model, "text").select("row", masked.alias("masked"))
    return found.select(*(F.col("masked").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def count_of(kind: str) -> Column:
    """How many of the base spans are of the kind."""
    at = KINDS.index(kind)
    return F.size(F.filter("base_spans", lambda x: x["kind"] == at)).cast("bigint")


__all__ = ["BASE", "KINDS", "Model", "count_of", "estimate", "find", "fit", "named", "redact"]

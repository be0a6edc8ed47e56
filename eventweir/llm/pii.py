"""Personal data by weak supervision, in DataFrame functions only.

Strict patterns give the ``base`` spans, which always stay; looser patterns give candidates that might
be personal data too.  Every span is voted on by four labelers: the strict pattern, a gazetteer
(domain endings, calling codes, issuer numbers, reserved networks), the words before it, and its
form.  Votes are counted by kind and pattern over all documents, at most 81 patterns a kind, and
expectation-maximisation estimates from these counts how reliable each labeler is and how likely
each pattern is personal data.  With these probabilities as soft labels a naive Bayes classifier is
trained on features of the spans that are no votes: their shape, length and neighbouring words,
hashed to ``BUCKETS``.  It decides which of the looser candidates are added.

Candidates are written once, so texts are read a single time; what reaches the driver are the
pattern counts and one row per bucket, however large the corpus.

Matches are leftmost and do not overlap within a kind; positions are code points.  The Java patterns
find what the plain ones in their comments find, but in linear time: a run of characters is entered
at its beginning only, or where the last match ended, and given up as a whole.  Null texts count as
empty.  An empty table gives an empty result; repeated rows are judged each on their own; other
columns are passed over.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from eventweir.workspace import materialise

KINDS = ("email", "ip", "card", "phone")

# Base patterns.  email: [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
# ip: [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)   card: [0-9]([\x20-]?[0-9])+
# phone: \+[0-9][\x20().0-9-]+[0-9]
_LOCAL, _LABEL = r"A-Za-z0-9._%+\-", r"[A-Za-z0-9\-]++"
_BASE = {
    "email": rf"(?=[{_LOCAL}])(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@{_LABEL}(?:\.{_LABEL})++",
    "ip": r"(?=[0-9])(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?=[0-9])(?<![0-9])(?<![0-9][ \-])[0-9](?:[ \-]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9\-]+[0-9]",
}
#: A text without this has no match.
_NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
# Looser forms: addresses that are spelled out, IPv6, short cards, numbers without calling code.
_LOOSE = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]{{1,64}} ?[(\[{{](?i:at)[)\]}}] ?{_LABEL}"
    rf"(?: ?(?:\.|[(\[{{](?i:dot)[)\]}}]) ?{_LABEL}){{1,8}}",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])(?<![0-9][ \-])[0-9]{4}[ \-]?[0-9]{3}[ \-]?[0-9]{3}[ \-]?[0-9]{3}(?![ \-]?[0-9])",
    "phone": r"(?<![0-9+(])(?:\([0-9]{3}\) ?|[0-9]{3}[.\-])[0-9]{3}[.\-][0-9]{4}(?![0-9])",
}
# Gazetteers (fixed values): what a kind's span should begin or end with.
_KNOWN = {
    "email": r"\.(?:com|org|net|edu|gov|info|io|eu|de|fr|es|it|uk|ch|at|nl|be|us|ca|au|jp|in|br)$",
    "ip": r"^(?!0|10\.|127\.|169\.254\.|192\.168\.|22[4-9]\.|2[3-5][0-9]\.)",
    "card": r"^(?:3[47]|4|5[1-5]|2[2-7]|6(?:011|4[4-9]|5))",
    "phone": r"^(?:\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})"
    r"|\(?[2-9][0-9]{2})",
}
#: Kinds whose gazetteer lists all there is, so that it speaks against what it does not list; the
#: others abstain there.
_COMPLETE = ("ip", "card")
# Words before a span that speak for a kind, and those that speak against any (fixed values).
_FOR = {
    "email": r"(?i)(?:e-?mail|contact|write|courriel|correo|kontakt)\W{1,4}(?:\w+\W+){0,2}$",
    "ip": r"(?i)(?:ip|host|server|client|address|login|from)\W{1,4}(?:\w+\W+){0,2}$",
    "card": r"(?i)(?:card|visa|mastercard|credit|debit|karte|carte|tarjeta)\W{1,4}(?:\w+\W+){0,2}$",
    "phone": r"(?i)(?:phone|tel|call|mobile|fax|telefon|fon|whatsapp)\W{1,4}(?:\w+\W+){0,2}$",
}
_AGAINST = r"(?i)(?:isbn|order|version|serial|invoice|page|ref|sku|build|section|§|v)\W{0,3}$"
_FORM = {
    "email": r"^[A-Za-z][A-Za-z0-9._%+\-]*[A-Za-z0-9]?(?:@| ?[(\[{])",
    "ip": r"^[1-9][0-9]*\.|:",
    "card": r"^(?:[0-9]{13,19}|(?:[0-9]{4}[ \-]){3}[0-9]{1,7}|[0-9]{4}[ \-][0-9]{6}[ \-][0-9]{5})$",
    "phone": r"^(?:\+[0-9]{1,3}[ .\-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .\-]?[0-9]{2,4}[ .\-]?[0-9]{2,}",
}

LABELERS = ("pattern", "gazetteer", "context", "form")
#: Characters before a span that labelers and features see.
BEFORE = 48
#: Buckets of the classifier's hashed features, EM rounds, what is added to counts.
BUCKETS = 4_096
ROUNDS = 60
SMOOTHING = 1.0
#: Finds whose places are summed up together.
_BLOCK = 256


def _located(text: Column, matches: Column, pattern: str) -> Column:
    """Start, end, value and text before of each match, in order.

    The parts between the matches come from a split by the same pattern; places are running sums of
    lengths, first within blocks of matches, then over the blocks.
    """
    between = F.slice(F.split(text, pattern, -1), 1, F.size(matches))
    parts = F.zip_with(
        matches,
        between,
        lambda m, b: F.struct(
            F.char_length(b).cast("long").alias("gap"),
            F.char_length(m).cast("long").alias("length"),
            m.alias("value"),
            F.right(b, F.lit(BEFORE)).alias("before"),
        ),
    )
    nought = F.lit(0).cast("long")
    spans = "array<struct<start:bigint,end:bigint,value:string,before:string>>"
    none = F.struct(nought.alias("at"), F.array().cast(spans).alias("out"))

    def place(seen: Column, part: Column) -> Column:
        start = seen["at"] + part["gap"]
        span = F.struct(
            start.alias("start"), (start + part["length"]).alias("end"), part["value"], part["before"]
        )
        return F.struct(
            (start + part["length"]).alias("at"), F.concat(seen["out"], F.array(span)).alias("out")
        )

    def block(all_parts: Column, n: Column) -> Column:
        return F.aggregate(F.slice(all_parts, n * _BLOCK + 1, _BLOCK), none, place)

    def shifted(spans_: Column, by: Column) -> Column:
        return F.transform(
            spans_,
            lambda s: F.struct(
                (s["start"] + by).alias("start"), (s["end"] + by).alias("end"), s["value"], s["before"]
            ),
        )

    numbers = F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / _BLOCK).cast("int"))
    blocks = F.transform(  # the parts are made once, not for every block
        F.array(parts), lambda all_parts: F.transform(numbers, lambda n: block(all_parts, n))
    )[0]
    start = F.struct(nought.alias("at"), F.array().cast(f"array<{spans}>").alias("out"))
    placed = F.aggregate(
        blocks,
        start,
        lambda seen, b: F.struct(
            (seen["at"] + b["at"]).alias("at"),
            F.concat(seen["out"], F.array(shifted(b["out"], seen["at"]))).alias("out"),
        ),
    )
    empty = F.array().cast(spans)
    return F.when(F.size(matches) > 0, F.flatten(placed["out"])).otherwise(empty)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether up to 19 digits pass the Luhn check."""
    padded = F.lpad(_digits(value), 20, "0")

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(padded, place, F.lit(1)).cast("int")
        double = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(place % 2 == 1, double).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.lit(20)), F.lit(0), add) % 10 == 0


def _is_base(kind: str, value: Column) -> Column:
    """The checks on a match of a base pattern."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    digits = F.char_length(_digits(value))
    if kind == "card":
        return digits.between(14, 19) & _luhn(value)
    return digits.between(10, 15)


def _is_loose(kind: str, value: Column) -> Column:
    return _luhn(value) if kind == "card" else F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _judged(kind: str, span: Column, base: bool) -> Column:
    """A span with its votes and its features."""
    value, before = span["value"], span["before"]
    known, form = value.rlike(_KNOWN[kind]), value.rlike(_FORM[kind])
    against = before.rlike(_AGAINST)
    votes = [
        F.lit(1 if base else 0),
        _vote(known, ~known if kind in _COMPLETE else F.lit(False)),
        _vote(before.rlike(_FOR[kind]) & ~against, against),
        _vote(form, ~form),
    ]
    short = F.left(value, F.lit(64))
    shape = F.regexp_replace(F.regexp_replace(short, "[0-9]+", "9"), r"\p{L}+", "a")
    words = F.regexp_extract_all(F.lower(before), F.lit(r"\p{L}+"), F.lit(0))
    features = [
        F.concat(F.lit("shape "), shape),
        F.concat(F.lit("length "), F.least(F.char_length(value), F.lit(64)).cast("string")),
        F.concat(F.lit("word "), F.coalesce(F.try_element_at(words, F.lit(-1)), F.lit(""))),
        F.concat(F.lit("stem "), F.regexp_extract(F.lower(before), r"(\S{0,3})\s*$", 1)),
    ]
    hashed = [
        F.pmod(F.xxhash64(F.concat(F.lit(f"{kind} "), f)), F.lit(BUCKETS)).cast("int")
        for f in features
    ]
    return F.struct(
        F.lit(KINDS.index(kind)).alias("rank"),
        F.lit(kind).alias("kind"),
        span["start"].alias("start"),
        span["end"].alias("end"),
        F.lit(base).alias("base"),
        F.concat_ws(",", *[v.cast("string") for v in votes]).alias("votes"),
        F.array(*hashed).alias("features"),
    )


def _candidates(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, ``base`` and ``loose`` spans of every document; loose ones touch no base span."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    body = F.col("text")
    nothing = F.array().cast("array<string>")
    matches = {}
    for kind in KINDS:
        found = F.regexp_extract_all(body, F.lit(_BASE[kind]), F.lit(0))
        needs = F.contains(body, F.lit(_NEEDS[kind]))
        matches[f"base_{kind}"] = F.when(needs, found).otherwise(nothing)
        matches[f"loose_{kind}"] = F.regexp_extract_all(body, F.lit(_LOOSE[kind]), F.lit(0))
    rows = rows.withColumns(matches)
    judged: dict[str, Column] = {}
    for kind in KINDS:
        for side, patterns, holds in (("base", _BASE, _is_base), ("loose", _LOOSE, _is_loose)):
            spans = _located(body, F.col(f"{side}_{kind}"), patterns[kind])
            kept = _kept(spans, kind, holds)
            judged[f"{side}_{kind}"] = _judged_all(kept, kind, side == "base")
    found = rows.select("doc_id", *[spans.alias(name) for name, spans in judged.items()])

    def apart(span: Column) -> Column:
        touched = [_touches(F.col(f"base_{kind}"), span) for kind in KINDS]
        return ~(touched[0] | touched[1] | touched[2] | touched[3])

    base = F.concat(*[F.col(f"base_{kind}") for kind in KINDS])
    loose = [F.filter(F.col(f"loose_{kind}"), apart) for kind in KINDS]
    return found.select("doc_id", base.alias("base"), F.concat(*loose).alias("loose"))


def _touches(sorted_spans: Column, span: Column) -> Column:
    """Whether a span meets one of others that are in order and do not overlap, by bisection."""
    start = F.struct(F.lit(0).alias("low"), F.size(sorted_spans).alias("high"))
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(sorted_spans) + 1.0)).cast("int"))

    def halve(at: Column, _: Column) -> Column:
        middle = F.shiftright(at["low"] + at["high"], 1)
        before = F.get(sorted_spans, middle)["start"] < span["end"]
        return F.when(at["low"] >= at["high"], at).otherwise(
            F.struct(
                F.when(before, middle + 1).otherwise(at["low"]).alias("low"),
                F.when(before, at["high"]).otherwise(middle).alias("high"),
            )
        )

    before_end = F.aggregate(steps, start, halve)["low"]  # how many begin before the span's end
    met = F.get(sorted_spans, before_end - 1)["end"] > span["start"]
    return (F.size(sorted_spans) > 0) & F.coalesce(met, F.lit(False))


def _kept(spans: Column, kind: str, holds) -> Column:
    return F.filter(spans, lambda s: holds(kind, s["value"]))


def _judged_all(spans: Column, kind: str, base: bool) -> Column:
    return F.transform(spans, lambda s: _judged(kind, s, base))


def reliabilities(counts: list[Row], rounds: int = ROUNDS) -> dict[tuple[str, str], float]:
    """Probability of personal data by kind and vote pattern, by expectation-maximisation.

    ``counts`` has kind, votes and n.  For each kind the labelers vote independently given the truth;
    each has its own probabilities of voting 1, 0 and -1 on true and on false spans.
    """
    truth: dict[tuple[str, str], float] = {}
    for kind in sorted({row.kind for row in counts}):
        own = [(row.votes, tuple(map(int, row.votes.split(","))), row.n) for row in counts if row.kind == kind]
        own.sort()
        belief = [1 / (1 + math.exp(-sum(votes))) for _, votes, _ in own]
        for _ in range(rounds):
            share = [SMOOTHING, SMOOTHING]
            # the prior says that labelers are right more often than wrong
            tables = [
                {(y, v): SMOOTHING * (3 if v == (1 if y else -1) else 1) for y in (0, 1) for v in (-1, 0, 1)}
                for _ in LABELERS
            ]
            for (_, votes, n), p in zip(own, belief, strict=True):
                for y, weight in ((1, n * p), (0, n * (1 - p))):
                    share[y] += weight
                    for table, vote in zip(tables, votes, strict=True):
                        table[y, vote] += weight
            sums = [{y: sum(t[y, v] for v in (-1, 0, 1)) for y in (0, 1)} for t in tables]
            belief = []
            for _, votes, _ in own:
                odds = math.log(share[1]) - math.log(share[0])
                for table, total, vote in zip(tables, sums, votes, strict=True):
                    odds += math.log(table[1, vote] / total[1]) - math.log(table[0, vote] / total[0])
                belief.append(1 / (1 + math.exp(-max(-700.0, min(700.0, odds)))))
        truth |= {(kind, votes): p for (votes, _, _), p in zip(own, belief, strict=True)}
    return truth


def _weights(spans: DataFrame, truth: dict[tuple[str, str], float]) -> tuple[float, list[float]]:
    """The classifier: its constant and the weight of each bucket."""
    known = F.create_map(*[F.lit(x) for key, p in truth.items() for x in ("|".join(key), p)])
    soft = spans.select(
        known[F.concat_ws("|", "span.kind", "span.votes")].alias("p"),
        F.explode(F.concat(F.array(F.lit(-1)), "span.features")).alias("bucket"),
    )
    sums = soft.groupBy("bucket").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no"))
    table = {row.bucket: (row.yes, row.no) for row in sums.collect()}  # at most one row per bucket
    yes, no = (n + SMOOTHING for n in table.pop(-1, (0.0, 0.0)))
    weights = [0.0] * BUCKETS
    for bucket, (y, n) in table.items():
        weights[bucket] = math.log((y + SMOOTHING) / (yes + 2 * SMOOTHING)) - math.log(
            (n + SMOOTHING) / (no + 2 * SMOOTHING)
        )
    return math.log(yes / no), weights


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``found``: kind, start, end, base and score of each span, by start and kind.

    Base spans stay whatever their score; the others have been accepted by the classifier.
    """
    table = materialise(_candidates(docs, doc_id, text), "personal-data")
    spans = table.select(F.explode(F.concat("base", "loose")).alias("span"))
    counts = spans.groupBy("span.kind", "span.votes").agg(F.count("*").alias("n")).collect()
    truth = reliabilities(counts)  # at most 81 patterns a kind
    constant, weights = _weights(spans, truth) if truth else (0.0, [0.0] * BUCKETS)
    # one literal, folded to an array of BUCKETS numbers
    weight = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")

    def scored(span: Column) -> Column:
        odds = F.aggregate(
            span["features"], F.lit(constant), lambda total, b: total + F.get(weight, b)
        )
        return F.struct(
            span["start"].alias("start"),
            span["rank"].alias("rank"),
            span["end"].alias("end"),
            span["kind"].alias("kind"),
            span["base"].alias("base"),
            (1 / (1 + F.exp(-odds))).alias("score"),
        )

    judged = table.select(
        "doc_id", F.transform(F.concat("base", "loose"), scored).alias("spans")
    )
    kept = F.array_sort(F.filter("spans", lambda s: s["base"] | (s["score"] > 0.5)))
    out = F.transform(
        kept, lambda s: F.struct(s["kind"], s["start"], s["end"], s["base"], s["score"])
    )
    return judged.select("doc_id", out.alias("found"))

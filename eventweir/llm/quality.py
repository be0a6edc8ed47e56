"""Quality rules whose cutoffs are certified on labelled holdouts, in DataFrame functions only.

Rules compare counts of a text, or ratios of them, with cutoffs.  How strict each may be is decided
per stratum (a language, say) so that few good documents are rejected:

1. Half of the labelled documents, picked by a digest of their id, propose.  For every rule the cutoff
   is taken that rejects most bad and least good ones, if it rejects no more than half the tolerated
   share of the good ones, and if exact binomial tails show that it catches more bad ones than that
   share.  A stratum's rules are put in order of what they gain.
2. The other half certifies.  Rules are added in this order as long as an exact binomial tail shows
   that all rules so far together reject less than the tolerated ``risk`` of the good documents.  The
   order was fixed by other rows, so a stratum's tests need no correction among themselves; the
   permitted ``error`` is divided by the number of strata.

So with probability ``1 - error`` no stratum loses more than ``risk`` of its good documents to the
rules.  A stratum with too few labels to certify anything keeps all documents that pass the base.

Words are ``[^\\x20\\x09-\\x0D]+``; a null text has none.  Documents of under 50 words, or in which more
than half of the words lie in repeated windows of three, fail the base and take no part above.
Documents whose label rows disagree or are null count as unlabelled; rows that repeat an id are judged
each on their own.  Null strata are one stratum.  Without labels only the base counts, an empty table
gives an empty result, further columns are passed over, whole texts are read however long (a text's
words are held as one array).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventweir.llm.binomial import lower_tail, upper_tail
from eventweir.workspace import materialise

_SPACES = " \t\n\v\f\r"
_SYMBOLS = "#*$%&|<>"
_NOT_BLANK = r"[^\x20\x09-\x0D]"
MIN_WORDS = 50
#: Most hundredths of a text's words that may lie in repeated windows.
MAX_REPEATED = 50
#: The share of good documents that may be rejected, and the chance that more are.
RISK, ERROR = 0.05, 0.05
#: Strata whose cutoffs are broadcast; a table of more is joined as it is.
BROADCAST_STRATA = 10_000
_PPM = 1_000_000


@dataclass(frozen=True)
class Rule:
    """A count, or its ratio to another in millionths, and cutoffs from lenient to strict.

    Documents above a cutoff are rejected, with ``below`` those under it.
    """

    name: str
    count: str
    of: str | None
    cutoffs: tuple[int, ...]
    below: bool = False

    def mark(self) -> Column:
        """The number of the first cutoff that rejects a document; one more than there are if none."""
        value = F.col(self.count)
        if self.of:
            value = F.expr(f"try_divide({self.count} * {_PPM}L, {self.of})")
        fails = [(value < c if self.below else value > c).cast("int") for c in self.cutoffs]
        failed = sum((F.coalesce(f, F.lit(0)) for f in fails), F.lit(0))
        return F.lit(len(self.cutoffs) + 1) - failed


RULES = (
    Rule("symbols", "n_symbols", "word_chars", tuple(1000 * n for n in (500, 300, 200, 150, 100, 70, 50, 30, 20, 10))),
    Rule("repeated_lines", "n_dup_lines", "n_lines", tuple(1000 * n for n in (900, 700, 500, 400, 300, 200, 100))),
    Rule("repeated_words", "n_repeat_words", "n_words", tuple(1000 * n for n in (400, 300, 200, 150, 100, 50))),
    Rule("long_words", "word_chars", "n_words", tuple(100_000 * n for n in (150, 120, 100, 90, 80, 70, 65, 60))),
    Rule("short_words", "word_chars", "n_words", tuple(100_000 * n for n in (20, 25, 30, 35, 40)), True),
    Rule("few_words", "n_words", None, (60, 75, 100, 150), True),
)


def _with(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column, size: int = 3) -> Column:
    """How many words lie in windows of ``size`` words that occur twice or more in the array.

    Windows are sorted by hash first; those with a neighbour of the same hash are sorted by their
    words, so that equal hashes of different windows do not count.
    """
    count = F.size(words) - (size - 1)
    places = F.sequence(F.lit(0), count - 1)

    def near(rows: Column, i: Column, name: str) -> Column:
        own = F.get(rows, i)[name]
        return (own == F.get(rows, i - 1)[name]) | (own == F.get(rows, i + 1)[name])

    def neighbours(rows: Column, name: str) -> Column:
        """The places of the rows that equal the one before or behind them."""
        same = F.filter(rows, lambda _, i: F.coalesce(near(rows, i, name), F.lit(False)))
        return F.transform(same, lambda row: row["at"])

    def window(i: Column) -> Column:
        return F.struct(*[F.get(words, i + n).alias(f"w{n}") for n in range(size)])

    hashes = F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + n) for n in range(size)]))

    def spelled(at: Column) -> Column:
        return F.sort_array(
            F.transform(at, lambda i: F.struct(window(i).alias("window"), i.alias("at")))
        )

    def covered(at: Column) -> Column:
        none = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        return F.aggregate(
            F.sort_array(at),
            none,
            lambda seen, i: F.struct(
                (i + size).alias("end"),
                (seen["n"] + i + size - F.greatest(seen["end"], i)).alias("n"),
            ),
        )["n"]

    def among(hashed: Column) -> Column:
        rows = F.transform(hashed, lambda h, i: F.struct(h.alias("hash"), i.alias("at")))
        alike = _with(F.sort_array(rows), lambda sorted_: neighbours(sorted_, "hash"))
        repeated = _with(
            alike, lambda at: _with(spelled(at), lambda sorted_: neighbours(sorted_, "window"))
        )
        plain = F.size(F.array_distinct(hashed)) == F.size(hashed)
        return F.when(plain, F.lit(0)).otherwise(covered(repeated))

    return F.when(count < 2, F.lit(0)).otherwise(_with(hashes, among)).cast("long")


def counts(docs: DataFrame, keep: Sequence[Column], text: str = "text") -> DataFrame:
    """The kept columns, the counts that rules are made of, and ``base_failed``."""
    whole = F.coalesce(F.col(text), F.lit(""))
    split = docs.select(
        *keep,
        whole.alias("_text"),
        F.array_remove(F.split(F.translate(whole, _SPACES, " " * 6), " "), "").alias("_words"),
        F.filter(F.split(whole, "\n"), lambda line: line.rlike(_NOT_BLANK)).alias("_lines"),
    )
    own = [c for c in split.columns if c not in ("_text", "_words", "_lines")]

    def without(letters: str) -> Column:
        return F.char_length(F.translate("_text", letters, ""))

    counted = split.select(
        *[F.col(f"`{c}`") for c in own],
        F.size("_words").cast("long").alias("n_words"),
        without(_SPACES).cast("long").alias("word_chars"),
        (F.char_length("_text") - without(_SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
    )
    few = F.col("n_words") < MIN_WORDS
    repeats = 100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")
    return counted.withColumn("base_failed", few | repeats)


def _labelled(marked: DataFrame, labels: DataFrame, doc_id: str, good: str) -> DataFrame:
    """The labelled documents that pass the base: stratum, good, proposes, marks."""
    own = labels.select(F.col(doc_id).alias("doc_id"), F.col(good).cast("int").alias("g"))
    agreed = (
        own.groupBy("doc_id")
        .agg(F.min("g").alias("g"), F.max("g").alias("most"), F.count("g").alias("n"))
        .filter("g = most")
        .select("doc_id", (F.col("g") == 1).alias("good"))
    )
    agreed = materialise(agreed, "agreed-labels")  # a plain scan, so that hot ids can be split
    passed = marked.filter("not base_failed").select("doc_id", "stratum", "marks")
    half = F.md5(F.col("doc_id").cast("string").cast("binary")) < "8"
    joined = passed.join(agreed, "doc_id").select("stratum", "good", half.alias("proposes"), "marks")
    return materialise(joined, "labelled")


def _proposed(labelled: DataFrame, rules: Sequence[Rule], risk: float, level: float) -> DataFrame:
    """(stratum, steps): the rules worth testing with their cutoffs, in the order of their gain."""
    rows = labelled.filter("proposes").select(
        "stratum", "good", F.posexplode("marks").alias("rule", "mark")
    )
    cells = rows.groupBy("stratum", "rule", "mark").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")
    )
    up_to = Window.partitionBy("stratum", "rule").orderBy("mark")
    every = Window.partitionBy("stratum", "rule")
    sums = cells.select(
        "stratum",
        "rule",
        "mark",
        F.sum("good").over(up_to).alias("good"),
        F.sum("bad").over(up_to).alias("bad"),
        F.sum("good").over(every).alias("all_good"),
        F.sum("bad").over(every).alias("all_bad"),
    )
    cutoffs = F.array(*[F.lit(len(rule.cutoffs)) for rule in rules])
    gain = F.try_divide("bad", "all_bad") - F.coalesce(F.try_divide("good", "all_good"), F.lit(0.0))
    worth = (
        sums.filter(F.col("mark") <= F.get(cutoffs, F.col("rule")))
        .filter(F.col("good") * 2.0 <= F.col("all_good") * risk)
        .withColumn("gain", gain)
        .filter("gain > 0")
        .filter(upper_tail(F.col("bad"), F.col("all_bad"), risk) <= level)
    )
    best = Window.partitionBy("stratum", "rule").orderBy(F.desc("gain"), "mark")
    order = Window.partitionBy("stratum").orderBy(F.desc("gain"), "rule")
    one = worth.withColumn("place", F.row_number().over(best)).filter("place = 1")
    steps = one.withColumn("step", F.row_number().over(order))
    listed = F.sort_array(F.collect_list(F.struct("step", "rule", "mark")))
    return steps.groupBy("stratum").agg(listed.alias("steps"))  # at most one per rule


def _joined(rows: DataFrame, per_stratum: DataFrame) -> DataFrame:
    """Rows with what their stratum has, if anything."""
    small = per_stratum.count() <= BROADCAST_STRATA
    return rows.join(F.broadcast(per_stratum) if small else per_stratum, "stratum", "left")


def _fails(step: Column) -> Column:
    """Whether a document's marks fail a step."""
    return F.get(F.col("marks"), step["rule"]) <= step["mark"]


def thresholds(
    labelled: DataFrame, rules: Sequence[Rule], risk: float = RISK, error: float = ERROR
) -> DataFrame:
    """(stratum, steps, n_good, n_rejected): the certified rules of each stratum.

    ``steps`` holds for each rule its step, number and the number of its cutoff; ``n_rejected`` of
    the ``n_good`` good documents that certify fail one of them.
    """
    strata = max(1, labelled.select("stratum").distinct().count())
    steps = _proposed(labelled, rules, risk, error / strata / len(rules))
    steps = materialise(steps, "steps")
    held = _joined(labelled.filter("not proposes and good"), steps).filter("steps is not null")
    failed = F.filter("steps", _fails)
    first = F.when(F.size(failed) > 0, F.get(failed, F.lit(0))["step"])
    tested = held.groupBy("stratum").agg(
        F.count("*").alias("n_good"),
        F.array(*[F.count_if(first <= n) for n in range(1, len(rules) + 1)]).alias("rejected"),
    )
    tested = tested.join(steps, "stratum")
    passes = [
        lower_tail(F.get("rejected", F.lit(n)), F.col("n_good"), risk) <= error / strata
        for n in range(len(rules))
    ]
    certified = sum((p.cast("int") for p in passes), F.lit(0))  # more rules never reject fewer
    kept = F.least(certified, F.size("steps"))
    return (
        tested.withColumn("kept", kept)
        .filter("kept > 0")
        .select(
            "stratum",
            F.slice("steps", F.lit(1), F.col("kept")).alias("steps"),
            "n_good",
            F.get("rejected", F.col("kept") - 1).alias("n_rejected"),
        )
    )


def judged(
    docs: DataFrame,
    labels: DataFrame,
    strata: Sequence[str] = ("lang",),
    doc_id: str = "doc_id",
    text: str = "text",
    good: str = "quality",
    rules: Sequence[Rule] = RULES,
    risk: float = RISK,
    error: float = ERROR,
) -> DataFrame:
    """Per document: doc_id, the counts, base_failed, kept, rejected_by (the names of rules)."""
    stratum = F.to_json(F.struct(*[F.col(c) for c in strata]), {"ignoreNullFields": "false"})
    keep = [F.col(doc_id).alias("doc_id"), stratum.alias("stratum")]
    counted = counts(docs, keep, text)
    marked = counted.withColumn("marks", F.array(*[rule.mark() for rule in rules]))
    marked = materialise(marked, "counted")
    found = thresholds(_labelled(marked, labels, doc_id, good), rules, risk, error)
    found = materialise(found.select("stratum", "steps"), "thresholds")
    names = F.array(*[F.lit(rule.name) for rule in rules])
    failed = F.transform(F.filter("steps", _fails), lambda step: F.get(names, step["rule"]))
    rejected = F.when(~F.col("base_failed") & F.col("steps").isNotNull(), failed)
    result = _joined(marked, found).withColumn(
        "rejected_by", F.coalesce(rejected, F.array().cast("array<string>"))
    )
    return result.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.size("rejected_by") == 0)).alias("kept"),
        "rejected_by",
    )

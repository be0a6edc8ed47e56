"""Personal data against the contract's patterns, and what weak supervision adds."""
import hashlib
import random
import re
import time

from pyspark.sql import Row
from pyspark.sql import functions as F

from eventweir.llm import pii
from eventweir.llm.spans import summary

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def plain(text):
    """The contract, pattern by pattern."""
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            if holds(kind, m.group()):
                found.append((m.start(), rank, m.end(), kind))
    return sorted(found)


def joined(found):
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in found)


def expected(text):
    found = plain(text)
    counts = tuple(sum(f[3] == k for f in found) for k in PATTERNS)
    return counts + (hashlib.sha256(joined(found).encode()).hexdigest(),)


def results(docs):
    return [
        (r.doc_id, (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256), r.spans)
        for r in summary(pii.personal_data(docs), pii.KINDS).collect()
    ]


def texts(rng):
    """Texts of few characters, so that matches begin, end and fail next to each other."""
    out = []
    for alphabet in ("a1.@", "1. ", "12 -", "+1 ().-2", "a@.-_%+1 é", "0123456789.+ -()@a"):
        out += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(60)]
    for _ in range(40):
        digits = "".join(rng.choice("0123456789") for _ in range(rng.randrange(12, 20)))
        for last in "0123456789":
            out.append(f"é😀 {rng.choice(['', '4 '])}{digits}{last}")
    return out


def test_base_spans_are_the_contracts(spark):
    rows = list(enumerate(texts(random.Random(2))))
    rows += [
        (9000, "a@b.c_d@e.f x..y@z.z.z@q.q 1.2.3.4.5.6.7.8 300.1.1.1 001.002.003.0255 256.1.1.1"),
        (9001, "+1 (017) 555-7713 +49 30 901820 +1-1-1- ++12345678901 +1234567890123456"),
        (9002, "4539 1488 0343 6467, 4539-1488-0343-6467-1"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {i: own for i, own, _ in results(docs)}
    assert found == {i: expected(t) for i, t in rows}


def test_spans_hold_all_base_spans(spark):
    rows = list(enumerate(texts(random.Random(4))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    by_id = dict(rows)
    for i, _, spans in results(docs):
        own = spans.split(",") if spans else []
        assert set(joined(plain(by_id[i])).split(",")) - {""} <= set(own)
        assert own == sorted(own, key=lambda s: (int(s.split(":")[1]), list(PATTERNS).index(s.split(":")[0])))


def test_long_texts_take_linear_time(spark):
    long = ["a" * 1_000_000, "1" * 1_000_000, "a.b@" + "c." * 300_000, "1 " * 300_000, "+1 (" * 250_000]
    many = " ".join(f"user{i}@mail.example.com, +1 555 555 {i:04}" for i in range(3000))
    rows = list(enumerate([*long, many]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {i: own for i, own, _ in results(docs)}
    assert found[5] == expected(many) and found[5][0] == 3000
    assert found[2][0] == 1 and found[3][2] == 0 and found[0][:4] == (0, 0, 0, 0)


def test_learns_whom_to_believe_and_adds_what_it_accepts(spark):
    rng = random.Random(7)
    rows = []
    for i in range(300):
        name = f"{rng.choice(['anna', 'ben', 'eva'])}.{rng.choice(['hill', 'wood'])}"
        rows.append(f"please write to mail: {name}@mail.example.com or phone: +1 415 555 {i:04}")
    for i in range(80):
        rows.append(f"please write to mail: anna.hill (at) mail.example.com or phone: (415) 555-{i:04}")
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r.doc_id: r.found for r in pii.personal_data(docs).collect()}
    assert all(len(found[i]) == 2 and all(f.base for f in found[i]) for i in range(300))
    added = [f for i in range(300, 380) for f in found[i]]
    assert len(added) > 120 and not any(f.base for f in added)
    text = rows[300]
    spans = {text[f.start : f.end] for f in found[300]}
    assert spans == {"anna.hill (at) mail.example.com", "(415) 555-0000"}


def test_estimates_recover_reliable_labelers():
    """Votes drawn from known reliabilities, the third labeler being useless."""
    rng, counts = random.Random(1), {}
    for _ in range(20_000):
        truth = rng.random() < 0.4
        votes = [
            (1 if truth else -1) * (1 if rng.random() < right else -1)
            for right in (0.95, 0.9, 0.5, 0.85)
        ]
        key = ",".join(map(str, votes))
        counts[key] = counts.get(key, 0) + 1
    beliefs = pii.reliabilities([Row(kind="email", votes=k, n=n) for k, n in counts.items()])
    assert beliefs["email", "1,1,1,1"] > 0.95 and beliefs["email", "-1,-1,1,-1"] < 0.05
    assert abs(beliefs["email", "1,1,1,-1"] - beliefs["email", "1,1,-1,-1"]) < 0.1


def test_odd_rows(spark):
    rows = [(None, "a@b.c", 1), (2, None, 2), (3, "", 3), (3, "a@b.c", 4), (3, "a@b.c", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, found long")
    by = sorted((i or 0, own) for i, own, _ in results(docs))
    assert by == sorted((i or 0, expected(t)) for i, t, _ in rows)
    assert results(docs.limit(0)) == []


def test_no_python_on_the_way(spark):
    docs = spark.createDataFrame([(1, "a@b.c")], "doc_id long, text string")
    plan = pii._candidates(docs, "doc_id", "text")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan


def test_the_query_on_whole_texts(spark):
    from eventweir.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    texts_ = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = QUERIES["op3_weak_supervision"](spark, folder).collect()
    assert len(found) == len(texts_)
    for r in found:
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == expected(texts_[r.doc_id])


def test_many_finds_of_two_kinds_take_no_quadratic_time(spark):
    n = 32_000
    df = spark.createDataFrame([(1, "a@b.co 555-123-4567 " * n)], "doc_id long, text string")
    start = time.perf_counter()
    found = pii._candidates(df, "doc_id", "text").select(
        F.size("base"), F.size("loose"), F.element_at("loose", -1)["start"]
    )
    assert tuple(found.first()) == (n, n, 20 * (n - 1) + 7)
    assert time.perf_counter() - start < 20


def test_loose_spans_touch_no_base_span(spark):
    """Against comparing each with each, on texts full of both."""
    draw = random.Random(6)
    parts = ["a@b.co", "x (at) y.org", "+1 555-123-4567", "555-123-4567", "4111 1111 1111 1111", "1234567890123",
             "1.2.3.4", "12345-678", "@", " ", "-", "me@x.org555-123-4567", "+49", "(555) 123-4567"]
    texts = ["".join(draw.choice(parts) + draw.choice(["", " ", ", "]) for _ in range(draw.randrange(60))) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in pii._candidates(df, "doc_id", "text").collect()}
    rows = df.select("doc_id", *[
        pii._kept(pii._located(F.col("text"), F.regexp_extract_all("text", F.lit(pii._LOOSE[k]), F.lit(0)), pii._LOOSE[k]), k, pii._is_loose).alias(k)
        for k in pii.KINDS
    ])
    some = 0
    for row in rows.collect():
        base = [(s.start, s.end) for s in found[row.doc_id].base]
        expected = {
            (k, s.start, s.end) for k in pii.KINDS for s in row[k]
            if not any(a < s.end and s.start < b for a, b in base)
        }
        assert {(s.kind, s.start, s.end) for s in found[row.doc_id].loose} == expected
        some += len(expected)
    assert some > 50

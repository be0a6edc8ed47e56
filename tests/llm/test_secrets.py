"""Plain and encoded secrets against the contract's patterns and hand-made layers."""
import base64
import bz2
import gzip
import hashlib
import lzma
import os
import random
import re
import subprocess
import sys
import time
import zlib
from urllib.parse import quote

import pytest
import zstandard

from eventweir.llm.secrets import KINDS, findings, secrets
from eventweir.llm.spans import summary

KEY = "password = hunter2hunter2"
BS = chr(92)

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plain(text):
    """The contract, pattern by pattern."""
    found = []
    assign = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    for m in re.finditer(assign, text, re.I | re.A):
        if len(m.group(2)) >= 8:
            found.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m.group()) >= 16:
            found.append((m.start(), 1, "access", m.end()))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m.group()) >= 32:
            found.append((m.start(), 2, "hex", m.end()))
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(found)]


def spans(text, base):
    return [f"{k}:{a}:{b}" for k, a, b, own, *_ in findings(text) if own == base]


TEXTS = [
    KEY,
    "secret: \"api_key = 'longlonglong'\"",
    "SECRET='abcdefgh' Token:xyz API_KEY=\"0123456789abcdef0123456789abcdef\"",
    "paſſword=abcdefgh toKen=abcdefgh",
    "AKIAAKIAAKIA AKIA0123456789AB xAKIA0123456789ABCD",
    "éé " + "a" * 31 + " " + "f" * 32 + "0",
    "token=token=abcdefgh",
    "password===== token  :  =abcdefgh",
    "",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans_are_the_contracts(text):
    assert spans(text, True) == plain(text)


def b64(raw):
    return base64.b64encode(raw).decode()


@pytest.mark.parametrize(
    "wrapped",
    [
        b64(KEY.encode()),
        base64.urlsafe_b64encode(KEY.encode() + "»»??>>".encode()).decode().rstrip("="),
        b64(gzip.compress(KEY.encode())),
        b64(zlib.compress(b"x" * 3_000_000 + b" " + KEY.encode())),
        b64(bz2.compress(gzip.compress(KEY.encode()))),
        b64(zstandard.compress(KEY.encode())),
        b64(b64(b64(KEY.encode()).encode()).encode()),
        quote(b64(gzip.compress(KEY.encode())), safe=""),
        b64(quote(KEY, safe="").replace("p", "%70").encode()),
    ],
)
def test_blobs_map_to_where_they_stand(wrapped):
    text = "é blob " + wrapped + " end"
    found = [f for f in findings(text) if not f[3]]
    assert [(k, a, b) for k, a, b, *_ in found] == [("assign", 7, 7 + len(wrapped))]
    assert found[0][5] == KEY


def test_escapes_map_code_point_by_code_point():
    for text in (
        "ü x password%3Dhunter2hunter2 y",
        "ü x password%253Dhunter2hunter2 y",
        f"ü x password{BS}u003dhunter2hunter2 y",
        f"ü x pass{BS}x77ord=hunter2hunter2 y",
        "ü x pass&#119;ord=hunter2hunter2 y",
        "ü x pass&#x77;ord=hunter2hunter2 y",
        f"ü x pass{BS}u{{77}}ord=hunter2hunter2 y",
        f"ü x pass{BS}U00000077ord=hunter2hunter2 y",
    ):
        assert spans(text, False) == [f"assign:4:{len(text) - 2}"], text
    text = f"{BS}u00e9%C3%A9%F0%9F%98%80{BS}ud83d{BS}ude00 AKIA%30123456789ABCDEF"
    assert spans(text, False) == [f"access:{text.index('AKIA')}:{len(text)}"]


def test_wrapped_lines_and_lines_of_their_own():
    code = b64(b"some words before, " + KEY.encode() + b" and behind")
    broken = code[:40] + "\n" + code[40:]
    assert spans(broken, False) == [f"assign:0:{len(broken)}"]
    one = b64(KEY.encode() + b" .")
    assert len(spans("Abcdefghijklmnopqrstu\n" + one, False)) == 1


def test_ends_at_the_fixpoint():
    assert findings("%25" * 2000) == []
    text = "%2525252541KIA" + "B" * 20
    assert spans(text, False) == [f"access:0:{len(text)}"]
    odd = f"{BS}u005cu005cu0041 %zz &#xFFFFFF; {BS}ud800 %ff%fe"
    assert findings(odd) == []


def test_base_finds_stay_and_are_not_repeated():
    text = "token=abcdefgh%20and%20more"
    assert spans(text, True) == ["assign:0:14"] and spans(text, False) == []


def test_very_long_texts_are_quick():
    assert findings("ab " * 2_000_000 + "%41" * 10_000 + "A" * 2_000_000) == []


def test_rows(spark):
    rows = [(1, None, "x"), (None, KEY, "y"), (3, KEY, "z"), (3, KEY, "z"), (4, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, found string")
    found = summary(secrets(docs), KINDS).collect()
    empty = hashlib.sha256(b"").hexdigest()
    one = hashlib.sha256(b"assign:0:25").hexdigest()
    assert sorted((r.doc_id or 0, r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in found) == [
        (0, 1, 0, 0, one, "assign:0:25"),
        (1, 0, 0, 0, empty, ""),
        (3, 1, 0, 0, one, "assign:0:25"),
        (3, 1, 0, 0, one, "assign:0:25"),
        (4, 0, 0, 0, empty, ""),
    ]
    assert summary(secrets(docs.limit(0)), KINDS).collect() == []


def test_the_query_on_whole_texts(spark):
    from eventweir.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in QUERIES["op10_decoded_secrets"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(found) == len(docs)
    for d in docs:
        joined = ",".join(plain(d.text or ""))
        assert found[d.doc_id].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()


def secrets_in(text):
    return sorted({f[5] for f in findings(text) if not f[3]})


def test_finds_in_one_place_are_told_apart():
    text = b64(b"password=firstfirst1, password=secondsecond2")
    assert secrets_in(text) == ["password=firstfirst1", "password=secondsecond2"]
    blob = b64(b"password=hunter2299")
    assert spans(f"token={blob}", True) == [f"assign:0:{6 + len(blob)}"]
    assert spans(f"token={blob}", False) == [f"assign:6:{6 + len(blob)}"]


def test_a_span_is_listed_once(spark):
    rows = [(1, b64(b"password=firstfirst1, password=secondsecond2"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = secrets(docs)
    assert len(found.first().found) == 2
    assert summary(found, KINDS).first().spans == f"assign:0:{len(rows[0][1])}"


PACKERS = [gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress]
TWO = [b"password=firstfirst1 ", b"password=secondsecond2 "]


@pytest.mark.parametrize("pack", PACKERS)
def test_every_copy_of_a_packed_blob_is_found(pack):
    blob = b64(pack(KEY.encode()))
    assert spans(f"{blob} {blob}", False) == [
        f"assign:0:{len(blob)}",
        f"assign:{len(blob) + 1}:{2 * len(blob) + 1}",
    ]


@pytest.mark.parametrize("pack", PACKERS)
def test_every_member_of_a_stream_is_read(pack):
    blob = b64(b"".join(pack(part) for part in TWO))
    assert secrets_in(blob) == ["password=firstfirst1", "password=secondsecond2"]
    assert secrets_in(b64(pack(TWO[0]) + b"\n" + TWO[1])) == secrets_in(blob)


def test_runs_go_on_over_the_pieces_of_a_stream():
    inner = b64(b"x" * 2_500_000 + b" " + KEY.encode())
    assert secrets_in(b64(gzip.compress(b"some words, " + inner.encode()))) == [KEY]
    value = "password=" + "v" * 8_000
    start = (1 << 20) - 4_500
    assert secrets_in(b64(gzip.compress(b", " * (start // 2) + value.encode() + b", " * 9_000))) == [value]


@pytest.mark.parametrize(
    "raw",
    [
        f"a{odd}b {KEY}".encode() for odd in (" ", "　", "​", "­", " ", "\x00", "\x07")
    ]
    + [f"﻿{KEY}".encode(), b"\xff " + KEY.encode(), KEY.encode() + b"\xc3"]
    + [KEY.encode(name) for name in ("utf-16", "utf-16-le", "utf-16-be", "latin-1")]
    + [f"{start} {KEY}".encode() for start in ("x", "x?", "x^", "x}")]
    + [gzip.compress(f"x^ {KEY}".encode()), gzip.compress(KEY.encode("utf-16"))],
)
def test_decoded_bytes_are_scanned_whatever_they_are(raw):
    assert secrets_in(b64(raw)) == [KEY]
    assert secrets_in(b64(b"\x00" + b64(raw).encode())) == [KEY]


@pytest.mark.parametrize("front", ["https://h.example/p/", "key-", "id_", "/var/lib/some/", "ab", "xyz"])
@pytest.mark.parametrize("raw", [b"password=hunter2299", gzip.compress(b"password=hunter2299")])
def test_runs_that_begin_within_other_words(front, raw):
    text = f"{front}{b64(raw)} x"
    assert secrets_in(text) == ["password=hunter2299"]
    if not front[-1].isalpha():
        assert spans(text, False) == [f"assign:{len(front)}:{len(text) - 2}"]


@pytest.mark.parametrize("indent", ["", "    ", "\t"])
@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_wrapped_blocks_are_read_to_their_last_character(indent, pack):
    for more in range(60):
        raw = pack(b"some words! " * 9 + b"z" * more + b" " + KEY.encode())
        block = base64.encodebytes(raw).decode().strip().replace("\n", "\n" + indent)
        assert spans(f"x {block} y", False) == [f"assign:2:{2 + len(block)}"], more
        assert secrets_in(block) == [KEY]


def test_short_words_behind_a_block_spoil_nothing():
    lines = [b64(b"password=hunter2299"), b64(b"password=another11").rstrip("="), "End"]
    assert {"password=hunter2299", "password=another11"} <= set(secrets_in("\n".join(lines)))


CHAINS = {
    "percent": ("%" + "25" * 100_000 + "3D", "url"),
    "unicode": ("\\" + "u005c" * 20_000 + "u003d", "unicode"),
    "bytes": ("\\" + "x5C" * 20_000 + "x3d", "unicode"),
    "reference": ("&" + "#38;" * 20_000 + "#61;", "unicode"),
}


@pytest.mark.parametrize("name", CHAINS)
def test_escapes_nested_very_deep(name):
    chain, layer = CHAINS[name]
    start = time.perf_counter()
    text = f"my password{chain}hunter2hunter2 and more"
    found = [f for f in findings(text) if f[0] == "assign"]
    assert time.perf_counter() - start < 20
    assert [(f[1], f[2], f[5]) for f in found] == [(3, len(text) - 9, "password=hunter2hunter2")]
    assert set(found[0][4].split(">")) == {layer}


def test_short_chains_are_decoded_layer_by_layer():
    text = "password%" + "25" * 5 + "3Dhunter2hunter2"
    assert findings(text)[0][4].count("url") == 6


def test_many_finds_in_one_run_take_linear_time():
    plain = b" ".join(b"password=hunter%05d" % i for i in range(50_000))
    for head in (b"", b"\xff"):
        start = time.perf_counter()
        found = findings(base64.b64encode(head + plain).decode())
        assert time.perf_counter() - start < 20
        assert len({f[5] for f in found}) == 50_000


def test_places_in_a_run_after_bytes_that_are_no_text():
    """The first start behind a separator from which all is text, wherever the bad bytes lie."""
    draw = random.Random(4)
    for _ in range(200):
        raw = bytes(draw.choices(b"ab\xff\x00\xc3\xa9?>", k=draw.randrange(3, 40))) + b" password=hunter2222"
        text = base64.b64encode(raw).decode()
        expected = 0
        if not plain_text(raw[: raw.index(b"password")]):
            starts = [
                p for p in range(4, len(raw) // 3 * 4, 4)
                if text[p - 1] in "+/" and p // 4 * 3 <= raw.index(b"password")
                and plain_text(raw[p // 4 * 3 : raw.index(b"password")])
            ]
            expected = min(starts, default=0)
        (found,) = [f for f in findings(text) if f[5] == "password=hunter2222" and f[4] == "base64"][:1]
        assert found[1] == expected


def plain_text(raw):
    try:
        raw.decode()
    except UnicodeDecodeError:
        return False
    return not re.search(rb"[\x00-\x08\x0e-\x1f\x7f]", raw)


def test_many_false_starts_of_streams():
    start = time.perf_counter()
    assert findings("H4sI" * 50_000) == []
    assert time.perf_counter() - start < 20


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress])
def test_hundreds_of_streams_inside_each_other(pack):
    raw = b"password=hunter2222 "
    for _ in range(150):
        raw = pack(raw)
    found = [f for f in findings(base64.b64encode(raw).decode()) if f[5] == "password=hunter2222"]
    assert found and found[0][4].count("packed") >= 140


_UNPACKS = """
import base64, resource, sys, zlib
from eventweir.llm.secrets import findings
packer, out = zlib.compressobj(9), []
for i in range(96):
    out.append(packer.compress(b"a" * (1 << 20)))
out += [packer.compress(b" password=hunter2222 "), packer.flush()]
text = base64.b64encode(b"".join(out)).decode()
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
found = findings(text)
assert ("assign", 0, len(text)) in {f[:3] for f in found}, found
assert ("hex", 0, len(text)) in {f[:3] for f in found}
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) >> 10)
"""


def test_memory_does_not_follow_what_a_stream_unpacks_to():
    run = subprocess.run(
        [sys.executable, "-c", _UNPACKS], capture_output=True, text=True, cwd=ROOT, timeout=300
    )
    assert run.returncode == 0, run.stderr
    assert int(run.stdout) < 200


def test_finds_across_the_cuts_of_long_blocks(monkeypatch):
    monkeypatch.setattr("eventweir.llm.secrets.WINDOW", 512)
    monkeypatch.setattr("eventweir.llm.secrets.HELD", 2048)
    monkeypatch.setattr("eventweir.llm.secrets.OVERLAP", 256)
    for gap in range(1900, 2200, 7):
        raw = zlib.compress(b"/" * gap + b"password=hunter2222" + b"/" * 5000)
        text = base64.b64encode(raw).decode()
        assert ("assign", 0, len(text)) in {f[:3] for f in findings(text)}

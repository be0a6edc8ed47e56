"""Archives written, indexed and read back."""
import gzip
import hashlib
import os

import pytest

from eventweir.llm import warc
from eventweir.workspace import shared_dir

SCHEMA = "page_id long, url string, html string, digest string"
BIG = "<p>" + "é" * 60


def by_hand(rows):
    first = {}
    for i, _, html, _ in rows:
        key = html or ""
        if i is not None:
            first[key] = min(first.get(key, i), i)
    out = []
    for i, _, html, _ in rows:
        raw = (html or "").encode()
        again = len(raw) >= 100 and first.get(html or "", i) != i
        digest = hashlib.sha256(raw).hexdigest()
        refers = first[html] if again else None
        out.append((i, len(raw), digest, "revisit" if again else "response", refers))
    return sorted(out, key=repr)


ROWS = [
    (5, "http://a/5", BIG, "x"),
    (3, "http://a/3", BIG, "x"),
    (4, None, BIG, None),
    (None, "http://a/null", BIG, "x"),
    (6, "http://a/6\r\nX: y", "short", "x"),
    (7, "http://a/7", "short", "x"),
    (8, "http://a/8", None, "x"),
    (9, "http://a/9", "", "x"),
    (10, "http://a/10", "a\r\n\r\nb\r\n\r\n" * 100_000, "x"),
    (11, "ü", "WARC/1.1\r\n" * 20, "x"),
]


def test_round_trip(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    found = [tuple(r) for r in warc.archived_pages(pages).collect()]
    assert sorted(found, key=repr) == by_hand(ROWS)


def test_repeated_rows_share_one_response(spark):
    pages = spark.createDataFrame([(1, "u", BIG, "d")] * 3 + [(2, "u", "s", "d")] * 2, SCHEMA)
    found = [(r.page_id, r.record_type, r.refers_to) for r in warc.archived_pages(pages).collect()]
    assert sorted(found, key=repr) == [
        (1, "response", None), (1, "revisit", 1), (1, "revisit", 1), (2, "response", None),
        (2, "response", None),
    ]


def test_text_ids_and_an_empty_table(spark):
    schema = "page_id string, url string, html string"
    pages = spark.createDataFrame([("b#1", "u", BIG), ("a", "u", BIG)], schema)
    found = {r.page_id: r.refers_to for r in warc.archived_pages(pages).collect()}
    assert found == {"a": None, "b#1": "a"}
    assert warc.archived_pages(pages.limit(0)).collect() == []


def test_selected_records_come_with_their_payload(spark, monkeypatch):
    rows = [(i, f"http://a/{i}", f"page {i} " * 30, "x") for i in range(300)]
    index, folder = warc.write_archives(spark.createDataFrame(rows, SCHEMA))
    wanted = index.filter("url like '%7'")
    found = warc.read_records(wanted, folder).collect()
    assert {r.url: r.payload.decode() for r in found} == {r[1]: r[2] for r in rows if r[0] % 10 == 7}
    assert all(r.digest == hashlib.sha256(r.payload).hexdigest() for r in found)


def test_archives_are_plain_gzip_members_at_their_offsets(spark):
    index, folder = warc.write_archives(spark.createDataFrame(ROWS[:6], SCHEMA))
    local = folder.removeprefix("file:")
    assert local.startswith(shared_dir(spark).removeprefix("file:"))
    rows = index.collect()
    for r in rows:
        with open(f"{local}/{r.file}", "rb") as f:
            f.seek(r.offset)
            raw = gzip.decompress(f.read(r.length))
        headers, http, payload = warc.parse(raw)
        assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
        assert headers["warc-type"] == r.record_type and int(http["content-length"]) == r.payload_bytes
        assert len(payload) == (r.payload_bytes if r.record_type == "response" else 0)
        assert ("warc-refers-to" in headers) == (r.record_type == "revisit")
    sizes = {}
    for r in rows:
        sizes[r.file] = max(sizes.get(r.file, 0), r.offset + r.length)
    assert sizes == {f: os.path.getsize(f"{local}/{f}") for f in sizes}


def test_ranges_are_coalesced_up_to_a_bound(monkeypatch):
    monkeypatch.setattr(warc, "GAP_BYTES", 10)
    monkeypatch.setattr(warc, "READ_BYTES", 100)
    places = [("a", 0, 30), ("a", 30, 30), ("a", 71, 5), ("a", 80, 50), ("b", 130, 500), ("b", 630, 1)]
    assert list(warc._ranges(iter(places))) == [
        ("a", [(0, 30), (30, 30)]),
        ("a", [(71, 5), (80, 50)]),
        ("b", [(130, 500)]),
        ("b", [(630, 1)]),
    ]


def test_damage_is_noticed(spark):
    index, folder = warc.write_archives(spark.createDataFrame(ROWS[:1], SCHEMA))
    row = index.first()
    path = f"{folder.removeprefix('file:')}/{row.file}"
    raw = warc.record("urn:page:5#0", None, b"other", "0" * 64, "d", 5)
    with open(path, "wb") as f:
        f.write(gzip.compress(raw))
    moved = spark.createDataFrame([(row.file, 0, len(gzip.compress(raw)))], "file string, offset long, length long")
    with pytest.raises(Exception, match="damaged record"):
        warc.read_records(moved, folder).collect()

"""WARC archives of web pages: write, index, and read selected records back by byte ranges.

Every record is a gzip member of its own in an archive below the shared folder.  While an archive is
written, each record's place (file, offset, length), URL and payload digest go into an index table;
that index comes first in all reading: rows are selected there, sorted by place, neighbouring ranges
are coalesced into one read, and only these bytes are fetched.  Tasks write under names of their own
and the index names the files of finished tasks only, so a repeated task leaves no record twice.

Pages with equal payloads of at least ``least`` bytes share one response record, that of the smallest
page id (null ids last, then any one of repeated rows); the others become revisit records without
payload.  A null page counts as empty, a null URL is left out of the record.  An empty table gives an
empty index; other columns are passed over.

Archives are reached through ``pyarrow.fs``, which knows local and shared mounts as well as object
stores and HDFS by their URI.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from eventweir.workspace import fresh_path, materialise

#: Smallest payload that is stored once for all pages that have it.
LEAST = 100
#: Compressed bytes after which a task begins its next archive.
ARCHIVE_BYTES = 256 << 20
#: Ranges that are no further apart are read together, up to so many bytes.
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20
#: Compressed bytes of records that a task reads back: tasks follow the archives, not the index,
#: whose rows are much smaller.
TASK_BYTES = 32 << 20
LEVEL = 3

_END = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value
_INDEX = (
    "file string, offset long, length long, url string, digest string, payload_bytes long,"
    " record_type string"
)


def _line(name: str, value) -> str:
    """A header line; line breaks in a value are percent-encoded."""
    return f"{name}: {str(value).replace(chr(13), '%0D').replace(chr(10), '%0A')}\r\n"


def record(
    record_id: str,
    url: str | None,
    payload: bytes,
    digest: str,
    date: str,
    size: int,
    refers_to: str | None = None,
) -> bytes:
    """A response record, or a revisit record where ``refers_to`` names the response.

    ``size`` is the length of the whole payload; a revisit record leaves the payload itself out.
    """
    http = "HTTP/1.1 200 OK\r\n" + _line("Content-Type", "text/html; charset=utf-8")
    http += _line("Content-Length", size) + "\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head = "WARC/1.1\r\n" + _line("WARC-Type", "revisit" if refers_to else "response")
    head += _line("WARC-Record-ID", f"<{record_id}>") + _line("WARC-Date", date)
    if url is not None:
        head += _line("WARC-Target-URI", url)
    if refers_to:
        head += _line("WARC-Profile", _PROFILE) + _line("WARC-Refers-To", f"<{refers_to}>")
    head += _line("WARC-Payload-Digest", f"sha256:{digest}")
    head += _line("Content-Type", "application/http; msgtype=response")
    head += _line("Content-Length", len(block)) + "\r\n"
    return head.encode() + block + _END


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """The WARC and HTTP headers of a record, names in lower case, and its payload."""
    head, _, rest = raw.partition(_END)
    headers = _headers(head)
    block = rest[: int(headers["content-length"])]
    http, _, payload = block.partition(_END)
    return headers, _headers(http), payload


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


class _Archives:
    """The archives that one task writes, one after the other."""

    def __init__(self, folder: str):
        self._files, self._folder = fs.FileSystem.from_uri(folder)
        self._files.create_dir(self._folder, recursive=True)
        self._name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        self._stream, self._number, self.offset, self.file = None, 0, 0, ""

    def append(self, raw: bytes) -> tuple[str, int, int]:
        """File, offset and length of the record as written."""
        if self._stream is None or self.offset >= ARCHIVE_BYTES:
            self.close()
            self.file = f"{self._name}-{self._number:04d}.warc.gz"
            path = f"{self._folder}/{self.file}"
            self._stream = self._files.open_output_stream(path, compression=None)
            self._number, self.offset = self._number + 1, 0
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        packed = packer.compress(raw) + packer.flush()
        self._stream.write(packed)
        place = (self.file, self.offset, len(packed))
        self.offset += len(packed)
        return place

    def close(self) -> None:
        if self._stream is not None:
            self._stream.close()


def _write(folder: str, date: str, schema: pa.Schema):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives = None
        for batch in batches:
            archives = archives or _Archives(folder)
            places = []
            for row in batch.select(
                ["record_id", "url", "payload", "digest", "payload_bytes", "refers_id"]
            ).to_pylist():
                raw = record(
                    row["record_id"], row["url"], row["payload"], row["digest"], date,
                    row["payload_bytes"], row["refers_id"],
                )
                places.append(archives.append(raw))
            files, offsets, lengths = zip(*places, strict=True) if places else ((), (), ())
            added = [pa.array(files, pa.string()), pa.array(offsets, pa.int64())]
            added.append(pa.array(lengths, pa.int64()))
            own = [batch.column(f.name) for f in list(schema)[3:]]
            yield pa.RecordBatch.from_arrays([*added, *own], schema=schema)
        if archives:
            archives.close()

    return write


def _record_id(page_id: F.Column, row_id: F.Column) -> F.Column:
    """``urn:page:<id>#<row>``: rows with one id are told apart, null ids are empty."""
    page = F.coalesce(page_id.cast("string"), F.lit(""))
    return F.concat(F.lit("urn:page:"), page, F.lit("#"), row_id.cast("string"))


def write_archives(
    pages: DataFrame,
    date: str = "2000-01-01T00:00:00Z",
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least: int = LEAST,
) -> tuple[DataFrame, str]:
    """Write a record per page; returns the index, a written table, and the archives' folder."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).cast("string").alias("url"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.monotonically_increasing_id().alias("row_id"),
    )
    best = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row_id")
    shared = (
        rows.filter(F.col("payload_bytes") >= least)
        .groupBy(F.col("digest").alias("shared"))
        .agg(F.min(best).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
    )
    # written before it is joined: a join of plain tables is split where a payload is hot
    shared = materialise(shared, "shared-digests")
    joined = rows.join(shared, F.col("digest") == F.col("shared"), "left")
    own = _record_id(F.col("page_id"), F.col("row_id"))
    first = _record_id(F.col("first.page_id"), F.col("first.row_id"))
    revisit = F.col("first").isNotNull() & (F.col("first.row_id") != F.col("row_id"))
    typed = joined.select(
        "url",
        "digest",
        "payload_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.lit(b"")).otherwise(F.col("payload")).alias("payload"),
        own.alias("record_id"),
        F.when(revisit, first).alias("refers_id"),
    )
    spark = pages.sparkSession
    folder = fresh_path(spark, "archives")
    schema = StructType.fromDDL(_INDEX)
    written = typed.mapInArrow(_write(folder, date, to_arrow_schema(schema)), schema)
    return materialise(written, "warc-index"), folder


def _ranges(places: Iterator[tuple[str, int, int]]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Sorted places in groups that are read together."""
    file, group = "", []
    for name, offset, length in places:
        if group and (
            name != file
            or offset > group[-1][0] + group[-1][1] + GAP_BYTES
            or offset + length - group[0][0] > READ_BYTES
        ):
            yield file, group
            group = []
        file = name
        group.append((offset, length))
    if group:
        yield file, group


def _read(folder: str, schema: pa.Schema):
    def rows_of(file: str, raw: bytes) -> tuple:
        headers, http, payload = parse(raw)
        digest = headers["warc-payload-digest"].removeprefix("sha256:")
        kind = headers["warc-type"]
        if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"damaged record {headers['warc-record-id']} in {file}")
        size = len(payload) if kind == "response" else int(http["content-length"])
        refers = headers.get("warc-refers-to", "").strip("<>") or None
        return (
            headers["warc-record-id"].strip("<>"), headers.get("warc-target-uri"), kind, digest,
            size, refers, payload if kind == "response" else None,
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        places = (
            (r["file"], r["offset"], r["length"]) for b in batches for r in b.to_pylist()
        )
        opened, stream = "", None
        for file, group in _ranges(places):
            if file != opened:
                if stream is not None:
                    stream.close()
                opened, stream = file, files.open_input_file(f"{root}/{file}")
            start = group[0][0]
            span = stream.read_at(group[-1][0] + group[-1][1] - start, start)
            view = memoryview(span)
            found = [
                rows_of(file, zlib.decompress(view[o - start : o - start + n], 31))
                for o, n in group
            ]
            columns = zip(*found, strict=True)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)
        if stream is not None:
            stream.close()

    return read


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that rows of an index point to, read in the order they lie in.

    Columns: record_id, url, record_type, digest, payload_bytes, refers_id and payload, which is
    null for revisits; their length is that of the page they stand for.
    """
    schema = StructType.fromDDL(
        "record_id string, url string, record_type string, digest string, payload_bytes long,"
        " refers_id string, payload binary"
    )
    places = index.select("file", "offset", "length")
    size = places.agg(F.sum("length")).first()[0] or 0
    dealt = places.repartitionByRange(1 + size // TASK_BYTES, "file", "offset")
    ordered = dealt.sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(_read(folder, to_arrow_schema(schema)), schema)


def page_of(record_id: F.Column, kind: str) -> F.Column:
    """The page id in a record id, as the type it had."""
    found = F.regexp_extract(record_id, r"^urn:page:(.*)#\d+$", 1)
    return F.when(found != "", found.cast(kind))


def archived_pages(pages: DataFrame, page_id: str = "page_id", **settings) -> DataFrame:
    """Write the pages to archives and read all records back: what each one says of its page.

    Columns: page_id, payload_bytes, payload_digest, record_type, refers_to.
    """
    kind = pages.schema[page_id].dataType.simpleString()
    index, folder = write_archives(pages, page_id=page_id, **settings)
    return read_records(index, folder).select(
        page_of(F.col("record_id"), kind).alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        page_of(F.col("refers_id"), kind).alias("refers_to"),
    )

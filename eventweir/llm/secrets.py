"""Secret scans that unwrap encoded layers until nothing new comes out.

A worklist begins with the whole text.  Each layer taken from it is scanned for secrets and for
encoded parts; what these decode to becomes a further layer: percent-encoding, Unicode escapes and
numeric character references decode the layer as a whole, base64 runs decode one by one, and decoded
bytes that are gzip, zlib, bzip2, xz or zstandard streams are decompressed, some bytes at a time,
member by member.  Base64 is tried in all four alignments, decoded bytes are scanned whatever they
are.  A layer that was met before at the same place is not entered again, so the work ends at the
fixpoint.  Every find is mapped back, through all its layers, to the code points of the original
text; only one with the kind, start and secret of an earlier one is left out.

Finds in the text itself are marked ``base``; they stay whatever the layers show.  Null texts count
as empty.  An empty table gives an empty result; repeated rows are scanned each on their own; other
columns are passed over.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import sys
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from eventweir.llm.arrow import slices, texts

KINDS = ("assign", "access", "hex")
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
#: Runs of hex digits are maximal, so asking for 32 finds just the runs that are long enough.
_HEX = re.compile("[0-9a-f]{32,}")

#: Escapes of the escape character itself, nested so deep that half of the layers are passed over.
_CHAINS = (r"%(?:25){8,}", r"\\(?:u005[cC]){8,}|\\(?:x5[cC]){8,}|&(?:\#38;){8,}|&(?:\#[xX]26;){8,}")
_PERCENT = re.compile(_CHAINS[0] + "|(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(
    _CHAINS[1] + r"|(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|(?:\\x[0-9A-Fa-f]{2})+"
    r"|&\#[0-9]{1,7};|&\#[xX][0-9A-Fa-f]{1,6};"
)
#: Shortest base64 run that is decoded: twelve bytes.  Further lines may be indented, the last may be
#: shorter.
_BASE64 = re.compile(
    r"[A-Za-z0-9+/_-]{16,}(?:\r?\n[ \t]*[A-Za-z0-9+/_-]{16,})*"
    r"(?:\r?\n[ \t]*[A-Za-z0-9+/_-]{1,15}(?![A-Za-z0-9+/_-]))?={0,2}"
)
_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
_URL_SAFE = str.maketrans("-_", "+/")
_CONTROLS = re.compile(rb"[\x00-\x08\x0e-\x1f\x7f]")
#: What a compressed stream's first bytes become in base64: gzip, bzip2, xz, zstandard, zlib.
_PACKED = re.compile("(?=H4sI|Qlpo|/Td6|KLUv/|e[A-P])")
#: Bytes without any of these hold no secret and nothing to decode.
_OF_USE = re.compile(
    rb"password|passwd|secret|token|api_?key|AKIA|[A-Za-z0-9+/_-]{16}"
    rb"|%[0-9A-Fa-f]{2}|\\[uUx]|&#|\x00[^\x00]\x00",
    re.IGNORECASE,
)

#: Bytes of a decompressed stream that are read at a time.
WINDOW = 1 << 20
#: Places where no secret and no encoded run goes on: a layer of a long stream may end behind them.
_BREAK = re.compile(
    rb"[^A-Za-z0-9+/_.=\-\"' :\\{}%&#;\r\n\t\x00]|\x00{4}|(?<=[A-Za-z0-9.])\x20(?=[A-Za-z0-9])"
)
#: Bytes of a stream's end that are looked through for such a place first.
TAIL = 1 << 12
#: Bytes of a stream without such a place that are held at most, and that the next ones begin with.
HELD, OVERLAP = 8 << 20, 1 << 16
#: Digits of a base64 run that are decoded at first to open a stream, the factor from then on.
FEED, GROWTH = 1 << 12, 4


def scan(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end of the secrets that stand plainly in a text."""
    found = []
    low = text.lower()
    if any(word in low for word in _WORDS):
        spans = (m.span() for m in _ASSIGN.finditer(text) if len(m[2]) >= 8)
        found += [("assign", *span) for span in spans]
    if "AKIA" in text:
        spans = (m.span() for m in _ACCESS.finditer(text))
        found += [("access", a, b) for a, b in spans if b - a >= 16]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return found


class Layer:
    """A decoded text and where its code points stand in the layer around it.

    ``places`` holds pieces in order: offset here, start and end there, and whether the piece goes
    code point by code point.  Without places the whole layer stands for ``whole``.
    """

    def __init__(self, text, parent=None, places=None, whole=(0, 0), path=()):
        self.text, self.parent, self.whole, self.path = text, parent, whole, path
        self.places = places
        self._offsets = [p[0] for p in places] if places is not None else []

    def span(self, start: int, end: int) -> tuple[int, int]:
        """The span of the original text that a span of this layer stands for."""
        layer = self
        while layer.parent is not None:
            start, end = layer.around(start, end)
            layer = layer.parent
        return start, end

    def around(self, start: int, end: int) -> tuple[int, int]:
        """The span of the layer around it."""
        if self.places is None:
            return self.whole
        first = self.places[bisect_right(self._offsets, start) - 1]
        last = self.places[bisect_right(self._offsets, end - 1) - 1]
        a = first[1] + (start - first[0] if first[3] else 0)
        b = last[1] + (end - last[0]) if last[3] else last[2]
        return a, b


def _replaced(layer: Layer, pattern: re.Pattern, decode, name: str) -> Layer | None:
    """The layer with all matches decoded in place; None if nothing changes."""
    out, places, at, size = [], [], 0, 0
    for match in pattern.finditer(layer.text):
        start, end = match.span()
        if start > at:
            out.append(layer.text[at:start])
            places.append((size, at, start, True))
            size += start - at
        for text, a, b in decode(match[0]):
            out.append(text)
            places.append((size, start + a, start + b, False))
            size += len(text)
        at = end
    if not places:
        return None
    if at < len(layer.text):
        out.append(layer.text[at:])
        places.append((size, at, len(layer.text), True))
    text = "".join(out)
    return Layer(text, layer, places, path=(*layer.path, name)) if text else None


def _from_bytes(raw: bytes, width: int) -> Iterator[tuple[str, int, int]]:
    """The characters of UTF-8 bytes that were written ``width`` code points each."""
    at = 0
    while at < len(raw):
        size = next((n for n in (1, 2, 3, 4) if _is_character(raw[at : at + n])), 0)
        yield (raw[at : at + size].decode() if size else "�"), at * width, (at + (size or 1)) * width
        at += size or 1


def _is_character(raw: bytes) -> bool:
    try:
        return len(raw.decode()) == 1
    except UnicodeDecodeError:
        return False


def _halved(match: str) -> Iterator[tuple[str, int, int]]:
    """A chain of escapes of the escape character, half as long: as deep in it as all its layers."""
    link = 1 + match.index(match[-1], 1) if match[-1] == ";" else {"%": 3, "u": 6, "x": 4}[
        match[0] if match[0] == "%" else match[1]
    ]
    size = link - 1
    links = (len(match) - 1) // size
    yield match[: 1 + links // 2 * size], 0, len(match)


_CHAIN = re.compile("|".join(_CHAINS))


def _percent(match: str) -> Iterator[tuple[str, int, int]]:
    if _CHAIN.fullmatch(match):
        return _halved(match)
    return _from_bytes(bytes.fromhex(match.replace("%", "")), 3)


def _escape(match: str) -> Iterator[tuple[str, int, int]]:
    if _CHAIN.fullmatch(match):
        yield from _halved(match)
    elif match[1] == "x":
        yield from _from_bytes(bytes.fromhex(match.replace("\\x", "")), 4)
    elif match[:2] == "\\u" and match[2] != "{":
        units = [int(match[i + 2 : i + 6], 16) for i in range(0, len(match), 6)]
        at = 0
        while at < len(units):
            pair = units[at : at + 2]
            if len(pair) == 2 and 0xD800 <= pair[0] < 0xDC00 <= pair[1] < 0xE000:
                point, n = 0x10000 + ((pair[0] - 0xD800) << 10) + pair[1] - 0xDC00, 2
            else:
                point, n = pair[0], 1
            yield _character(point), 6 * at, 6 * (at + n)
            at += n
    else:
        digits = re.sub(r"[^0-9A-Fa-f]", "", match[2:])
        decimal = match[0] == "&" and match[2] not in "xX"
        yield _character(int(digits, 10 if decimal else 16)), 0, len(match)


def _character(point: int) -> str:
    lone = 0xD800 <= point < 0xE000
    return chr(point) if point < 0x110000 and not lone else "�"


class _Run(Layer):
    """What a base64 run decodes to, one character a byte, from one of its four alignments.

    A find stands for the run from where its text begins: the run's start, or the first start behind
    a separator or a line break from which the bytes before the find are text.
    """

    def __init__(self, raw, parent, path, digits, places, end, shift):
        super().__init__(raw.decode("latin-1"), parent, path=path)
        self.raw, self.digits, self.lines, self.end = raw, digits, places, end
        self.shift = shift
        self._bad: list[int] | None = None
        self._begins: list[tuple[int, int]] = []

    def _place(self, at: int) -> int:
        line = bisect_right(self.lines, (at, sys.maxsize)) - 1
        return self.lines[line][1] + at - self.lines[line][0]

    def _measure(self) -> None:
        """Where the bytes are no text, and where a text may begin, each once for all finds."""
        decoded = self.raw.decode("utf-8", "surrogateescape")
        points = np.frombuffer(decoded.encode("utf-32-le", "surrogatepass"), np.uint32)
        lone = (points >= 0xDC80) & (points <= 0xDCFF)
        wide = np.where(lone, 1, 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000))
        control = (points < 0x20) & ((points < 0x09) | (points > 0x0D)) | (points == 0x7F)
        ends = np.cumsum(wide)
        self._bad = (ends - wide)[lone | control].tolist()
        begins = {m.end() for m in re.finditer("[+/]", self.digits)} | {p[0] for p in self.lines}
        first, continues = self.shift, np.frombuffer(self.raw, np.uint8) & 0xC0 == 0x80
        places = sorted(p for p in begins if p > first and (p - first) % 4 == 0)
        offsets = [(p - first) // 4 * 3 for p in places]
        self._begins = [
            (byte, p)
            for byte, p in zip(offsets, places, strict=True)
            if byte < len(self.raw) and not continues[byte]
        ]

    def around(self, start: int, end: int) -> tuple[int, int]:
        first = self.shift
        if start:
            if self._bad is None:
                self._measure()
            last = bisect_left(self._bad, start) - 1
            if last >= 0:
                at = bisect_right(self._begins, (self._bad[last], sys.maxsize))
                if at < len(self._begins) and self._begins[at][0] <= start:
                    first = self._begins[at][1]
        return self._place(first), self.end


def _is_text(raw: bytes) -> bool:
    try:
        raw.decode()
    except UnicodeDecodeError:
        return False
    return not _CONTROLS.search(raw)


def _unpacker(raw: bytes):
    """A function that decompresses a stream bytewise, by the magic number it begins with."""
    if raw[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if raw[:1] == b"\x78" and len(raw) > 1 and (raw[0] << 8 | raw[1]) % 31 == 0:
        return zlib.decompressobj()
    if raw[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if raw[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    return None


_ZSTANDARD = b"\x28\xb5\x2f\xfd"
_BROKEN = (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError)


class _Source:
    """Bytes that come in pieces, to be read, looked ahead at and put back."""

    def __init__(self, pieces: Iterator[bytes]):
        self._pieces, self._held = pieces, b""

    def peek(self, size: int) -> bytes:
        while len(self._held) < size and (piece := next(self._pieces, None)) is not None:
            self._held += piece
        return self._held[:size]

    def read(self, size: int = -1) -> bytes:
        if not self._held:
            self._held = next(self._pieces, b"")
        size = len(self._held) if size < 0 else size
        out, self._held = self._held[:size], self._held[size:]
        return out

    def put_back(self, raw: bytes) -> None:
        self._held = raw + self._held

    def skip_padding(self) -> None:
        while (head := self.peek(1)) == b"\0":
            self._held = self._held.lstrip(head)


def _pieces(packed: Iterator[bytes]) -> Iterator[bytes]:
    """The content of compressed streams one behind another, some bytes at a time, as far as readable."""
    source = _Source(packed)
    try:
        while _is_packed(head := source.peek(8)):
            if head[:4] == _ZSTANDARD:
                with zstandard.ZstdDecompressor().stream_reader(source, read_across_frames=True) as reader:
                    while piece := reader.read1(WINDOW):
                        yield piece
                return
            unpacker, rest = _unpacker(head), b""
            while not unpacker.eof:
                if not rest and getattr(unpacker, "needs_input", True):
                    rest = source.read(WINDOW)
                    if not rest:
                        return
                piece = unpacker.decompress(rest, WINDOW)
                rest = getattr(unpacker, "unconsumed_tail", b"")
                if piece:
                    yield piece
            source.put_back(unpacker.unused_data)
            source.skip_padding()  # between members
    except _BROKEN:
        return


def _is_packed(raw: bytes) -> bool:
    return raw[:4] == _ZSTANDARD or _unpacker(raw[:8]) is not None


def _may_open(head: bytes) -> bool:
    """Whether a stream may begin so; zlib streams, with the shortest mark, are tried."""
    if head[:1] == b"\x78" and _is_packed(head):
        try:
            zlib.decompressobj().decompress(head, 1)
        except zlib.error:
            return False
    return _is_packed(head)


def _blocks(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Pieces dealt anew: each ends where no secret and no encoded run goes on, or with the last.

    Where no such place comes for ``HELD`` bytes, a block ends anywhere and the next one begins with
    its last ``OVERLAP`` bytes.  A longer find is then met in parts, which stand for the same span.
    """
    held: list[bytes] = []
    size = 0
    for piece in pieces:
        at = 0
        for tail in (TAIL, len(piece)):
            begin = max(0, len(piece) - tail)
            at = max((m.end() for m in _BREAK.finditer(piece, begin)), default=0)
            if at:
                break
        if at:
            yield b"".join([*held, piece[:at]])
            held, size = [piece[at:]], len(piece) - at
            continue
        held.append(piece)
        size += len(piece)
        if size >= HELD:
            block = b"".join(held)
            yield block
            held, size = [block[-OVERLAP:]], OVERLAP
    if last := b"".join(held):
        yield last


def _readings(raw: bytes, parent: Layer, whole: tuple[int, int], path: tuple) -> Iterator[Layer]:
    """Layers of bytes as text: one character a byte, as all patterns are ASCII, and as UTF-16."""
    if not _OF_USE.search(raw):
        return
    yield Layer(raw.decode("latin-1"), parent, whole=whole, path=path)
    yield from _wide(raw, parent, whole, path)


def _wide(raw: bytes, parent: Layer, whole: tuple[int, int], path: tuple) -> Iterator[Layer]:
    if b"\0" in raw and _OF_USE.search(raw):
        for start in (0, 1):  # the second also reads big-endian text
            text = (raw[start:] + b"\0" * ((len(raw) - start) % 2)).decode("utf-16-le", "replace")
            yield Layer(text, parent, whole=whole, path=(*path, "utf16"))


def _opened(
    packed: Callable[[], Iterator[bytes]], parent: Layer, whole: tuple[int, int], path: tuple, seen: set
):
    """Layers of the streams that decoded bytes are, and of streams inside these.

    ``packed`` gives the bytes from the start each time.  A stream inside is held if it is small and
    else unpacked again with the one around it, so that memory does not follow its size.
    """
    while True:
        if not next(_pieces(packed()), b""):
            return
        digest = hashlib.blake2b(digest_size=16)
        for piece in packed():
            digest.update(piece)
        mark = digest.digest() + b"%d:%d" % parent.span(*whole)
        if mark in seen:
            return
        seen.add(mark)
        path = (*path, "packed")
        for block in _blocks(_pieces(packed())):
            yield from _readings(block, parent, whole, path)
        if not _is_packed(_Source(_pieces(packed())).peek(8)):
            return
        held, inside = [], _pieces(packed())
        for piece in inside:
            held.append(piece)
            if sum(map(len, held)) > HELD:
                packed = partial(_unpacked, packed)
                break
        else:
            packed = partial(iter, [b"".join(held)])


def _unpacked(packed: Callable[[], Iterator[bytes]]) -> Iterator[bytes]:
    return _pieces(packed())


def _fed(digits: str, start: int) -> Iterator[bytes]:
    """The bytes of a base64 run from one of its digits on, some at a time."""
    size = FEED
    while start < len(digits):
        yield _unbase64(digits[start : start + size])
        start += size
        size = min(size * GROWTH, 1 << 20)


def _unbase64(digits: str) -> bytes:
    digits = digits[: len(digits) - (len(digits) % 4 == 1)]
    try:
        return binascii.a2b_base64(digits + "=" * (-len(digits) % 4))
    except binascii.Error:
        return b""


def _decoded(layer: Layer, lines: list, end: int, shifts: range, seen: set) -> Iterator[Layer]:
    """Layers of some alignments of a run that stands in lines, and of streams wherever they begin."""
    path = (*layer.path, "base64")
    digits = "".join(m[0] for m in lines).translate(_URL_SAFE)
    places, size = [], 0
    for line in lines:
        places.append((size, line.start()))
        size += len(line[0])
    raws = {shift: _unbase64(digits[shift:]) for shift in shifts}
    for shift, raw in raws.items():
        if _OF_USE.search(raw):
            run = _Run(raw, layer, path, digits, places, end, shift)
            yield run
            yield from _wide(raw, layer, (run._place(shift), end), path)
    empty: set[tuple[int, int]] = set()
    for match in _PACKED.finditer(digits):
        shift = match.start() % 4
        if shift not in shifts:
            continue
        if not _may_open(_unbase64(digits[match.start() : match.start() + TAIL])):
            continue
        body = (shift, _body(raws[shift], match.start() // 4 * 3))
        if body[1] < 0 or body in empty:
            continue
        at = bisect_right(places, (match.start(), sys.maxsize)) - 1
        whole = (places[at][1] + match.start() - places[at][0], end)
        gave = False
        for inside in _opened(partial(_fed, digits, match.start()), layer, whole, path, seen):
            gave = True
            yield inside
        if not gave:
            empty.add(body)


def _body(raw: bytes, at: int) -> int:
    """Where a stream's content begins, -1 if it does not; gzip headers may hold texts of any length."""
    if raw[at : at + 2] != b"\x1f\x8b" or at + 10 > len(raw):
        return at
    flags, at = raw[at + 3], at + 10
    if flags & 4:
        at += 2 + int.from_bytes(raw[at : at + 2], "little")
    for text in (8, 16):
        if flags & text:
            at = raw.find(b"\0", at) + 1
            if not at:
                return -1
    at += flags & 2
    return at if at < len(raw) else -1


def _base64_layers(layer: Layer, seen: set) -> Iterator[Layer]:
    for match in _BASE64.finditer(layer.text):
        start, end = match.span()
        lines = list(_LINE.finditer(layer.text, start, end))
        yield from _decoded(layer, lines, end, range(1), seen)
        if len(lines) > 1:
            sizes = {len(m[0]) for m in lines[:-1]}
            joined = _unbase64("".join(m[0] for m in lines).translate(_URL_SAFE))
            wrapped = len(sizes) == 1 and len(lines[-1][0]) <= max(sizes) and _is_text(joined)
            if not wrapped:  # lines of their own after all, or a word behind the last
                for line in lines:
                    yield from _decoded(layer, [line], line.end(), range(4), seen)
                if len(lines) > 2 and len(lines[-1][0]) < 16:
                    yield from _decoded(layer, lines[:-1], lines[-2].end(), range(4), seen)
        yield from _decoded(layer, lines, end, range(1, 4), seen)


def _children(layer: Layer, seen: set) -> Iterator[Layer]:
    text = layer.text
    if "%" in text and (child := _replaced(layer, _PERCENT, _percent, "url")):
        yield child
    if ("\\" in text or "&#" in text) and (child := _replaced(layer, _ESCAPE, _escape, "unicode")):
        yield child
    yield from _base64_layers(layer, seen)


def findings(text: str) -> list[tuple[str, int, int, bool, str, str]]:
    """Kind, start, end, whether base, layers and found text, by start and then kind."""
    root = Layer(text)
    found = [(k, a, b, True, "", text[a:b]) for k, a, b in scan(text)]
    known = {(kind, start, secret) for kind, start, _, _, _, secret in found}
    seen: set[bytes] = set()
    work = [_children(root, seen)]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        mark = hashlib.blake2b(layer.text.encode("utf-8", "replace"), digest_size=16).digest()
        where = mark + b"%d:%d" % layer.span(0, len(layer.text))
        if layer.text == text or where in seen:
            continue
        seen.add(where)
        for kind, a, b in scan(layer.text):
            start, end = layer.span(a, b)
            if (kind, start, layer.text[a:b]) not in known:
                known.add((kind, start, layer.text[a:b]))
                found.append((kind, start, end, False, ">".join(layer.path), layer.text[a:b]))
        work.append(_children(layer, seen))
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


_FOUND = "array<struct<kind:string,start:long,end:long,base:boolean,layers:string,secret:string>>"
_NAMES = ("kind", "start", "end", "base", "layers", "secret")


def _find(schema: pa.Schema):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [
                [dict(zip(_NAMES, f, strict=True)) for f in findings(text)]
                for text in texts(batch.column("text"))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, schema.field("found").type)], schema=schema
            )

    return find


def secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``found``: kind, start, end (code points), base, layers and secret of each find."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = StructType([rows.schema["doc_id"], *StructType.fromDDL(f"found {_FOUND}").fields])
    return rows.mapInArrow(_find(to_arrow_schema(schema)), schema)

"""Best-fit packing of tokenised documents into sequences, improved by local search.

Each document becomes its token ids and a closing id; documents longer than a sequence are cut into
full pieces, the first piece taking what is left over.  Full pieces are sequences of their own.  The
others, one a document at most, are dealt into groups of some thousand by a hash of their row, so no
group depends on the size of the table or on its keys.  In a group, best fit in falling order makes a
first packing.  Local search then improves it: from the emptiest bin on, documents are moved into
others, or exchanged one for one, two for one and one for two, wherever that raises the sum of squared
fills, until bins run empty.  The underfull sequences of all groups are then dealt into new groups and
improved there, round by round, until too few are saved.

Null texts count as empty: they hold the closing id only.  Repeated rows are packed each on their
own, an empty table gives an empty result, other columns are passed over.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from eventweir.llm.arrow import slices, texts
from eventweir.llm.pretokens import Pieces, splitter
from eventweir.workspace import fresh_path, materialise, read_written, write_table

#: Pieces that are packed together, about.
GROUP_ROWS = 8_192
#: Sweeps of the local search over the underfull bins; it ends sooner when none improves.
SWEEPS = 12
#: Share of the underfull sequences that a round over new groups has to save for another one to follow.
MIN_GAIN = 1e-4

_PIECE = "piece int, start long, length long, ids_crc32 long"


def _ids_bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit ids."""
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


#: The caches of this Python process, by tokenizer file.
_CACHES: dict[str, Pieces] = {}


def cut(n: int, size: int) -> Iterator[tuple[int, int]]:
    """Start and length of the pieces of ``n`` tokens."""
    first = n % size or min(n, size)
    yield 0, first
    for start in range(first, n, size):
        yield start, size


def _pieces(path: str, end_id: int, size: int, schema: pa.Schema):
    closing = _ids_bytes([end_id])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter(path)
        if path not in _CACHES:
            _CACHES[path] = Pieces(path, _ids_bytes)
        ids_of = _CACHES[path].__getitem__
        for batch in slices(batches):
            rows, found = [], []
            for row, text in enumerate(texts(batch.column(batch.schema.get_field_index("text")))):
                ids = memoryview(b"".join(map(ids_of, split(text))) + closing)
                for piece, (start, length) in enumerate(cut(len(ids) // 4, size)):
                    rows.append(row)
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    found.append((piece, start, length, crc))
            taken = batch.take(pa.array(rows, pa.int64()))
            own = [taken.column(taken.schema.get_field_index(c)) for c in ("row_id", "doc_id")]
            columns = zip(*found, strict=True) if found else [[]] * 4
            added = [pa.array(c, f.type) for c, f in zip(columns, list(schema)[2:], strict=True)]
            yield pa.RecordBatch.from_arrays([*own, *added], schema=schema)

    return pieces


def token_pieces(
    docs: DataFrame, path: str, end_id: int, size: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """row_id, doc_id, piece, start, length and ids_crc32 of every piece of every document."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
    )
    schema = StructType([rows.schema["row_id"], rows.schema["doc_id"]])
    for field in StructType.fromDDL(_PIECE):
        schema = schema.add(field)
    return rows.mapInArrow(_pieces(path, end_id, size, to_arrow_schema(schema)), schema)


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Bins of item numbers, by best fit in falling order of length."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    rooms = 0  # bit r: some bin has r tokens of room
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[item]
        fitting = rooms >> need
        if fitting:
            room = need + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, chosen = size, len(bins)
            bins.append([])
        bins[chosen].append(item)
        by_room[room - need].append(chosen)
        rooms |= 1 << (room - need)
    return bins


class _Search:
    """Bins under improvement.

    ``offers`` lists, by a bin's room and the tokens it gives for an exchange, bins and what they give:
    nothing, one document or two.  ``given`` has the tokens that are on offer at a room as bits.
    """

    def __init__(self, lengths: list[int], size: int, bins: list[list[int]]):
        self.lengths, self.size, self.bins = lengths, size, bins
        self.room = [size - sum(lengths[i] for i in b) for b in bins]

    def _kinds(self, b: int) -> list[int]:
        """Two documents of each length in a bin: all that exchanges can tell apart, and few."""
        seen: dict[int, int] = {}
        kept = []
        for item in self.bins[b]:
            seen[self.lengths[item]] = n = seen.get(self.lengths[item], 0) + 1
            if n <= 2:
                kept.append(item)
        return kept

    def _offer(self, b: int) -> None:
        """What an underfull bin could give for an exchange."""
        items, room, length = self._kinds(b), self.room[b], self.lengths
        if not room or not items:
            return
        self._list(room, 0, b, ())
        for k, x in enumerate(items):
            self._list(room, length[x], b, (x,))
            for y in items[k + 1 :]:
                self._list(room, length[x] + length[y], b, (x, y))

    def _list(self, room: int, size: int, b: int, taken: tuple[int, ...]) -> None:
        few = len(taken) < 2
        self.offers[few, room, size].append((b, taken))
        bits = self.given[few]
        bits[room] = bits.get(room, 0) | 1 << size

    def _apply(self, a: int, given: tuple[int, ...], b: int, taken: tuple[int, ...]) -> None:
        length = self.lengths
        moved = sum(length[i] for i in given) - sum(length[i] for i in taken)
        self.bins[a] = [i for i in self.bins[a] if i not in given] + list(taken)
        self.bins[b] = [i for i in self.bins[b] if i not in taken] + list(given)
        self.room[a] += moved
        self.room[b] -= moved

    def _valid(self, a: int, few: bool, room: int, size: int) -> tuple[int, tuple[int, ...]] | None:
        """An offer that still holds, of another bin than a; outdated ones are struck off."""
        offers, own = self.offers[few, room, size], []
        while offers:
            b, taken = offers[-1]
            if self.room[b] == room and b != a and all(i in self.bins[b] for i in taken):
                break
            offers.pop()
            if b == a and self.room[a] == room and all(i in self.bins[a] for i in taken):
                own.append((b, taken))
        found = offers[-1] if offers else None
        offers[:0] = own
        if not offers:
            self.given[few][room] &= ~(1 << size)
        return found

    def _partner(self, a: int, size: int, few: bool):
        """The offer that leaves the other bin fullest for ``size`` tokens of a, by its rest of room.

        An exchange raises the sum of squared fills if the other bin gains and ends fuller than a was.
        """
        best, least = None, self.room[a]
        for room, bits in list(self.given[few].items()):
            low = max(0, size - room)
            # the tokens taken: at least ``low``, fewer than ``size``, and leaving less than ``least``
            rest = low + room - size
            span = min(size - low, least - rest)
            found = bits >> low & (1 << span) - 1 if span > 0 else 0
            while found:
                bit = (found & -found).bit_length() - 1
                offer = self._valid(a, few, room, low + bit)
                if offer:
                    best, least = offer, rest + bit
                    break
                found &= found - 1
            if not least:
                break
        return best, least

    def _improve(self, a: int) -> bool:
        """The move or exchange of one or two documents of a that fills another bin most."""
        items, length = self._kinds(a), self.lengths
        groups = [(x,) for x in items]
        groups += [(x, y) for k, x in enumerate(items) for y in items[k + 1 :]]
        chosen, least, tried = None, self.room[a], set()
        for given in groups:
            size = sum(length[i] for i in given)
            for few in (True, False)[: 3 - len(given)]:
                if (size, few) in tried:
                    continue
                tried.add((size, few))
                offer, rest = self._partner(a, size, few)
                if offer and rest < least:
                    chosen, least = (given, *offer), rest
                if chosen and not least:
                    break
            if chosen and not least:
                break
        if chosen is None:
            return False
        given, b, taken = chosen
        self._apply(a, given, b, taken)
        self._offer(a)
        self._offer(b)
        return True

    def run(self, sweeps: int) -> list[list[int]]:
        least = -(-sum(self.lengths) // self.size)
        for _ in range(sweeps):
            used = [b for b, items in enumerate(self.bins) if items]
            if len(used) <= least:
                break
            order = sorted((b for b in used if self.room[b]), key=lambda b: -self.room[b])
            self.offers, self.given, changed = defaultdict(list), {True: {}, False: {}}, False
            for b in order:
                self._offer(b)
            for a in order:
                while self.bins[a] and self._improve(a):
                    changed = True
            if not changed:
                break
        return [items for items in self.bins if items]


def pack(lengths: list[int], size: int, sweeps: int = SWEEPS) -> list[list[int]]:
    """Bins of item numbers that hold at most ``size`` each, as few as local search can make."""
    return _Search(lengths, size, best_fit(lengths, size)).run(sweeps)


def repack(lengths: list[int], size: int, bins: list[list[int]]) -> list[list[int]]:
    """No more bins than the given ones: these improved, or packed anew where that needs fewer."""
    return min(_Search(lengths, size, bins).run(SWEEPS), pack(lengths, size), key=len)


def _pack_group(size: int, schema: pa.Schema):
    def pack_group(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_pylist()
        group = table.column("group")[0].as_py()
        if "sequence_id" in table.column_names:  # keeps to the numbers of the group's sequences
            old = defaultdict(list)
            for item, number in enumerate(table.column("sequence_id").to_pylist()):
                old[number].append(item)
            numbers, bins = list(old), repack(lengths, size, list(old.values()))
        else:
            bins = pack(lengths, size)
            numbers = [(group << 24) + n for n in range(len(bins))]
        sequence, offset, filled = ([0] * len(lengths) for _ in range(3))
        for number, items in zip(numbers, bins, strict=False):
            at, whole = 0, sum(lengths[i] for i in items)
            for item in items:
                sequence[item], offset[item], filled[item] = number, at, whole
                at += lengths[item]
        kept = table.select([f.name for f in list(schema)[:-3]])
        for name, values in (("sequence_id", sequence), ("offset", offset), ("filled", filled)):
            kept = kept.append_column(name, pa.array(values, pa.int64()))
        return kept.cast(schema)

    return pack_group


def _solve(rows: DataFrame, groups: int, size: int, schema: StructType) -> DataFrame:
    """The rows packed by their ``group``, a number below ``groups``.

    Groups are small in bytes and heavy in work, so they are dealt evenly to tasks by their number,
    not by bytes: to a task each, or to ``spark.sql.shuffle.partitions`` tasks if there are more.
    """
    tasks = min(groups, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.withColumn("task", F.pmod("group", F.lit(tasks)).cast("int"))
    dealt = dealt.repartitionById(tasks, "task").groupBy("task", "group")
    return dealt.applyInArrow(_pack_group(size, to_arrow_schema(schema)), schema)


def _regrouped(first: DataFrame, size: int, group_rows: int, min_gain: float) -> DataFrame:
    """The underfull sequences dealt into new groups and packed there, until a round saves too few.

    Rounds are folders of one table.  What a round leaves underfull is read by the next one, so the
    result is the filled sequences of all rounds and the others of the last, in one scan.
    """
    spark, schema, path = first.sparkSession, first.schema, fresh_path(first.sparkSession, "rounds")
    rounds, left = 0, write_table(first, f"{path}/round=0")
    while True:
        under = left.filter(F.col("filled") < size)
        rows, before = under.agg(F.count("*"), F.count_if(F.col("offset") == 0)).first()
        groups = -(-rows // group_rows)
        if before < 2:
            break
        rounds += 1
        dealt = F.pmod(F.xxhash64("sequence_id", F.lit(rounds)), F.lit(groups))
        solved = _solve(under.withColumn("group", dealt), groups, size, schema)
        left = write_table(solved, f"{path}/round={rounds}")
        saved = before - left.filter(F.col("offset") == 0).count()
        if saved == 0 or saved < min_gain * before or groups == 1:
            break
    whole = read_written(spark, path, StructType(schema.fields).add("round", "integer"))
    return whole.filter((F.col("filled") == size) | (F.col("round") == rounds)).drop("round")


def packed(
    docs: DataFrame,
    path: str,
    size: int = 1024,
    end_id: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    group_rows: int = GROUP_ROWS,
    min_gain: float = MIN_GAIN,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset there.

    Sequences of one full piece have negative numbers.  Rounds over new groups end with the first that
    saves none, or less than ``min_gain`` of the underfull sequences.
    """
    pieces = materialise(token_pieces(docs, path, end_id, size, doc_id, text), "pieces")
    columns = ["doc_id", *StructType.fromDDL(_PIECE).names]
    short = pieces.filter(F.col("length") < size)
    groups = max(1, -(-short.count() // group_rows))
    schema = StructType([pieces.schema[c] for c in columns])
    schema = schema.add("sequence_id", "long").add("offset", "long").add("filled", "long")

    dealt = F.pmod(F.xxhash64("row_id"), F.lit(groups)).alias("group")
    solved = _solve(short.select(dealt, *columns), groups, size, schema)
    if groups > 1:
        solved = _regrouped(solved, size, group_rows, min_gain)
    full = pieces.filter(F.col("length") == size).select(
        *columns,
        (-F.monotonically_increasing_id() - 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return full.unionByName(solved.drop("filled"))

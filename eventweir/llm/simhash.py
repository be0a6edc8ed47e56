"""SimHash near-duplicates by a self-join of binary tries.

A fingerprint bit is 1 if set in over half the 64-bit hashes of a text's shingles.  Distinct
fingerprints within ``max_bits`` differing bits are linked.  The trie of all fingerprints is joined
with itself: node pairs go down together, adding up the bits in which their paths differ, and are
dropped when these exceed the budget.

To spread the work, the 64 bits are cut into more blocks than the budget has bits: linked
fingerprints agree in all blocks but as many as the budget.  For each choice of so many blocks there
is one trie whose paths begin with them; below each value of them hangs a subtrie that one task can
join, with the budget untouched.  A value shared by many fingerprints is cut into chunks of bounded
size by a hash, and each pair of chunks is joined on its own, so no subtrie outgrows a task and no
link is lost.  These copies grow with the square of a value's fingerprints, so they are counted first,
and the bits are cut into one block more where that makes fewer rows: 5 choices of one block of 12 bits
at first (budget 4), then 15 of two with 20 bits, 35 of three with 27, 70 of four with 32.

A task keeps the links it finds as stars: fingerprints point to the smallest one they are connected
with below the same block value, and node pairs that are already connected are not followed further.
So a group of many near copies gives as many rows as it has members, never all their pairs.
Components of these links are then found by ``components``; copies share a fingerprint and need no
links at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from eventweir.llm.arrow import raw_texts, slices
from eventweir.llm.components import components
from eventweir.workspace import materialise

#: Fingerprints below one block value that a task joins at most, times two.
CHUNK = 8_192
#: Blocks that 64 bits are cut into beyond the budget at most.
MORE_BLOCKS = 4
#: Crowded values that are broadcast at most; more are joined as a plain table.
FEW_VALUES = 100_000
#: Rows of whole subtries that are joined in one sweep.
SWEEP_ROWS = 200_000
#: Node pairs on one level that are held at a time.
FRONTIER = 400_000
#: Leaf comparisons begin when two nodes hold no more than so many pairs.
FEW = 16

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_hashes(raw: bytes, words: int, seed: int) -> list[int]:
    """XXH64 of every run of ``words`` words, of all words if they are fewer, none without words."""
    own = raw.translate(_LOWER).split()
    if not own:
        return []
    joined = b" ".join(own)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in own)]
    starts = [0, *[e + 1 for e in ends[:-1]]]
    digest = xxhash.xxh64_intdigest
    if len(own) <= words:
        return [digest(joined, seed)]
    return [digest(joined[s:e], seed) for s, e in zip(starts, ends[words - 1 :], strict=False)]


def fingerprint(hashes: list[int]) -> int:
    """The majority bits of some hashes as a signed 64-bit number; 0 without any."""
    if not hashes:
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        some = np.array(hashes[at : at + 65536], dtype=">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(some, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def _fingerprints(words: int, seed: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints = [
                fingerprint(shingle_hashes(raw, words, seed))
                for raw in raw_texts(batch.column(batch.schema.get_field_index("text")))
            ]
            own = [batch.column(batch.schema.get_field_index(f.name)) for f in list(schema)[:-1]]
            own.append(pa.array(prints, pa.int64()))
            yield pa.RecordBatch.from_arrays(own, schema=schema)

    return run


def fingerprints(rows: DataFrame, words: int, seed: int) -> DataFrame:
    """The columns of ``rows`` but ``text``, and ``print``, the fingerprint of ``text``."""
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = StructType(kept).add("print", "long")
    return rows.mapInArrow(_fingerprints(words, seed, to_arrow_schema(schema)), schema)


Blocks = tuple[tuple[int, int], ...]


def choices(count: int, max_bits: int) -> list[tuple[Blocks, Blocks]]:
    """All ways to take ``count - max_bits`` of ``count`` blocks, those taken and the others.

    A block is its lowest bit and its width; together they are the 64 bits.
    """
    edges = [64 * i // count for i in range(count + 1)]
    blocks = [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]
    taken = combinations(blocks, count - max_bits)
    return [(some, tuple(b for b in blocks if b not in some)) for some in taken]


def _taken_first(prints: np.ndarray, choice: tuple[Blocks, Blocks]) -> np.ndarray:
    """The prints with the bits of the taken blocks at the top."""
    turned = np.zeros_like(prints)
    for low, width in [*choice[0], *choice[1]]:
        bits = (prints >> np.uint64(low)) & np.uint64((1 << width) - 1)
        turned = (turned << np.uint64(width % 64)) | bits
    return turned


def _value(taken: Blocks) -> F.Column:
    """The bits of the taken blocks as one number."""
    value = F.lit(0).cast("long")
    for low, width in taken:
        bits = F.shiftrightunsigned("print", low).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        value = F.shiftleft(value, width).bitwiseOR(bits)
    return value


class _Union:
    """Smallest member by member, over rows of an array."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> bool:
        changed = False
        while len(a):
            la, lb = self.label[a], self.label[b]
            apart = la != lb
            if not apart.any():
                break
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            np.minimum.at(self.label, np.maximum(la, lb), np.minimum(la, lb))
            changed = True
            while True:
                jumped = self.label[self.label]
                if np.array_equal(jumped, self.label):
                    break
                self.label = jumped
        return changed


def join_tries(keys: np.ndarray, prints: np.ndarray, depth: int, budget: int) -> np.ndarray:
    """Star labels of the links inside each of many tries at once.

    ``keys`` number the tries in rising order; ``prints`` are sorted below each key and agree in
    their top ``depth`` bits there.  Returns for each row the lowest row it is connected with.
    """
    n = len(prints)
    union = _Union(n)
    for gap in range(1, min(9, n)):  # neighbours in order: most links of near copies
        a = np.arange(n - gap)
        b = a + gap
        near = (keys[a] == keys[b]) & (np.bitwise_count(prints[a] ^ prints[b]) <= budget)
        union.link(a[near], b[near])
    borders = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
    lo, hi = borders[:-1], borders[1:]
    several = hi - lo > 1
    lo, hi = lo[several], hi[several]
    stack = [(depth, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
    ones: dict[int, np.ndarray] = {}
    while stack:
        level, a0, a1, b0, b1, spent = stack.pop()
        if len(a0) > FRONTIER:
            half = len(a0) // 2
            stack.append((level, *(x[half:] for x in (a0, a1, b0, b1, spent))))
            a0, a1, b0, b1, spent = (x[:half] for x in (a0, a1, b0, b1, spent))
            stack.append((level, a0, a1, b0, b1, spent))
            continue
        # pairs of nodes that are connected as wholes have nothing to add
        steps = np.r_[0, np.cumsum(union.label[1:] != union.label[:-1])]
        one = (steps[a1 - 1] == steps[a0]) & (steps[b1 - 1] == steps[b0])
        open_ = ~(one & (union.label[a0] == union.label[b0]))
        a0, a1, b0, b1, spent = (x[open_] for x in (a0, a1, b0, b1, spent))
        few = ((a1 - a0) * (b1 - b0) <= FEW) | (level == 64)
        if few.any():
            _leaves(union, prints, budget, a0[few], a1[few], b0[few], b1[few])
            a0, a1, b0, b1, spent = (x[~few] for x in (a0, a1, b0, b1, spent))
        if not len(a0):
            continue
        if level not in ones:
            bit = (prints >> np.uint64(63 - level)) & np.uint64(1)
            ones[level] = np.r_[0, np.cumsum(bit.astype(np.int64))]
        total = ones[level]
        am, bm = a1 - (total[a1] - total[a0]), b1 - (total[b1] - total[b0])
        same = a0 == b0
        parts = [
            (a0, am, b0, bm, spent),
            (am, a1, bm, b1, spent),
            (a0, am, bm, b1, spent + np.int8(1)),
            tuple(x[~same] for x in (am, a1, b0, bm, spent + np.int8(1))),
        ]
        below = [np.concatenate(x) for x in zip(*parts, strict=True)]
        alive = (below[1] > below[0]) & (below[3] > below[2]) & (below[4] <= budget)
        alive &= ~((below[0] == below[2]) & (below[1] - below[0] == 1))
        stack.append((level + 1, *(x[alive] for x in below)))
    return union.label


def _leaves(union: _Union, prints: np.ndarray, budget: int, a0, a1, b0, b1) -> None:
    """Compare all rows of small node pairs in full."""
    wide_a, wide_b = a1 - a0, b1 - b0
    pairs = wide_a * wide_b
    which = np.repeat(np.arange(len(pairs)), pairs)
    at = np.arange(len(which)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
    a, b = a0[which] + at // wide_b[which], b0[which] + at % wide_b[which]
    near = (a != b) & (np.bitwise_count(prints[a] ^ prints[b]) <= budget)
    union.link(a[near], b[near])


def _linker(budget: int, ways: list[tuple[Blocks, Blocks]]):
    """Links of sorted rows ``block, value, i, j, print``, whole subtries at a time.

    ``block`` is the number of the choice of blocks.
    """

    def linked(rows: list[np.ndarray]) -> pa.RecordBatch:
        block, value, i, j, prints = rows
        own = prints.view(np.uint64)
        turned = np.empty_like(own)
        for number in np.unique(block):
            here = block == number
            turned[here] = _taken_first(own[here], ways[number])
        changes = np.zeros(len(own), np.int64)
        for column in (block, value, i, j):
            changes[1:] |= column[1:] != column[:-1]
        keys = np.cumsum(changes)
        order = np.lexsort((turned, keys))
        turned, own, keys = turned[order], own[order], keys[order]
        depth = min(sum(width for _, width in taken) for taken, _ in ways)
        label = join_tries(keys, turned, depth, budget)
        moved = np.flatnonzero(label != np.arange(len(label)))
        signed = own.view(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(signed[moved]), pa.array(signed[label[moved]])], names=["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held.append(columns)
            size += batch.num_rows
            if size < SWEEP_ROWS:
                continue
            rows = [np.concatenate(x) for x in zip(*held, strict=True)]
            last = np.ones(size, bool)  # the subtrie that may go on in the next batch
            for column in rows[:4]:
                last &= column == column[-1]
            whole = size - int(last.sum())
            if whole:
                yield linked([x[:whole] for x in rows])
            held, size = [[x[whole:] for x in rows]], size - whole
        if size:
            yield linked([np.concatenate(x) for x in zip(*held, strict=True)])

    return run


def _cut(prints: DataFrame, max_bits: int):
    """The choices of blocks that make the fewest rows, ``block, value, print`` by them, and the
    values with over ``CHUNK`` prints and their number of chunks, a written table.

    ``block`` is the number of the choice.  One more block is tried as long as it can make fewer rows.
    """
    total, best = prints.count(), None
    for count in range(max_bits + 1, min(64, max_bits + MORE_BLOCKS) + 1):
        ways = choices(count, max_bits)
        if best and best[0] <= total * len(ways):
            break
        cut = F.array(
            *[
                F.struct(F.lit(n).alias("block"), _value(taken).alias("value"))
                for n, (taken, _) in enumerate(ways)
            ]
        )
        rows = prints.select("print", F.inline(cut))
        sizes = rows.groupBy("block", "value").count().filter(F.col("count") > CHUNK)
        crowded = sizes.withColumn("chunks", F.ceil(F.col("count") / CHUNK))
        crowded = materialise(crowded, "crowded")
        copies = F.sum(F.col("count") * (F.col("chunks") - 2))
        made = total * len(ways) + (crowded.agg(copies.alias("n")).first().n or 0)
        if not best or made < best[0]:
            best = made, ways, rows, crowded
    return best[1:]


def links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Links ``a, b`` that connect the distinct fingerprints ``print`` as all close pairs would.

    ``prints`` is a written table.
    """
    spark = prints.sparkSession
    ways, rows, crowded = _cut(prints, max_bits)
    sizes = crowded.select("block", "value", "chunks")
    if sizes.count() <= FEW_VALUES:
        sizes = F.broadcast(sizes)
    own = F.pmod(F.xxhash64("print"), F.col("chunks"))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), lambda c: c != own)
    pairs = F.transform(others, lambda c: F.struct(F.least(own, c).alias("i"), F.greatest(own, c).alias("j")))
    nought = F.lit(0).cast("long")
    single = F.array(F.struct(nought.alias("i"), nought.alias("j")))
    dealt = rows.join(sizes, ["block", "value"], "left").select(
        "block",
        "value",
        "print",
        F.explode(F.when(F.col("chunks").isNull(), single).otherwise(pairs)).alias("pair"),
    )
    keyed = dealt.select("block", "value", "pair.i", "pair.j", "print")
    keys = ["block", "value", "i", "j"]
    # few bytes make much work: tasks are not merged by their bytes
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        keyed.repartition(tasks, *keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(_linker(max_bits, ways), "a long, b long")
    )


def groups(rows: DataFrame, words: int, max_bits: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """The rows with their ``print``, and by distinct ``print`` the ``root`` of its component.

    ``rows`` has a column ``text``; the first result is a written table.
    """
    printed = materialise(fingerprints(rows, words, seed), "prints")
    distinct = materialise(printed.select("print").distinct(), "distinct-prints")
    connected = components(links(distinct, max_bits), "a", "b")
    roots = distinct.join(connected, distinct["print"] == connected["node"], "left").select(
        "print", F.coalesce("root", "print").alias("root")
    )
    return printed, materialise(roots, "roots")


def near_duplicates(
    docs: DataFrame,
    words: int = 4,
    max_bits: int = 4,
    seed: int = 42,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the smallest doc_id reachable).

    Null and wordless texts have fingerprint zero and are linked like any other.  Repeated rows
    each give a row; null ids are never a component's id while another id is there.  An empty
    table gives an empty result; other columns are passed over.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    printed, roots = groups(rows, words, max_bits, seed)
    least = printed.groupBy("print").agg(F.min("doc_id").alias("least"))
    by_print = roots.join(least, "print").select("print", "root", "least")
    by_root = by_print.groupBy("root").agg(F.min("least").alias("component_id"))
    # written before they are joined: joins of plain tables are split where a key is hot
    by_root = materialise(by_root, "component-ids")
    named = roots.join(by_root, "root").select("print", "component_id")
    named = materialise(named, "named")
    return printed.join(named, "print").select(
        "doc_id",
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def representatives(
    docs: DataFrame,
    words: int = 4,
    max_bits: int = 4,
    seed: int = 42,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest id (nulls last).

    All columns are kept.  Rows are told apart by their place in a written table, so of rows that
    repeat an id one stays as well.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(doc_id).alias("id"),
        F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
        F.col(text).alias("text"),
    )
    printed, roots = groups(rows, words, max_bits, seed)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row_id")).alias("first")
    by_print = printed.groupBy("print").agg(first)
    by_root = by_print.join(roots, "print").groupBy("root").agg(F.min("first").alias("first"))
    kept = by_root.select(F.col("first.row_id").alias("row_id"))
    return printed.join(kept, "row_id", "left_semi").select("row.*")

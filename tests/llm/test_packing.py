"""Packed sequences: pieces by the library's ids, a lossless and gapless packing, few sequences."""
import random
import zlib

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from eventweir.llm import packing

FILE = path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string"


def ids_of(text):
    return Tokenizer.from_file(FILE).encode(text or "", add_special_tokens=False).ids + [2]


def pieces_by_hand(doc_id, text, size):
    ids = ids_of(text)
    first = len(ids) % size or size
    cuts = [0, *range(first, len(ids), size), len(ids)] if len(ids) > size else [0, len(ids)]
    out = []
    for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        raw = np.array(ids[a:b], "<u4").tobytes()
        out.append((doc_id if doc_id is not None else -1, piece, a, b - a, zlib.crc32(raw)))
    return out


def check(rows, packed, size):
    found = sorted(
        (r.doc_id if r.doc_id is not None else -1, r.piece, r.start, r.length, r.ids_crc32) for r in packed
    )
    assert found == sorted(p for i, t in rows for p in pieces_by_hand(i, t, size))
    sequences = {}
    for r in packed:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences)


@pytest.mark.parametrize("group_rows", [8192, 10])
def test_pieces_and_sequences(spark, group_rows):
    rng = random.Random(1)
    words = ["some", "Wörter", "x1", "<|endoftext|>", "\n", "日本", "\x1c", "  "]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(60)))) for i in range(120)]
    rows += [(None, "a"), (200, None), (201, ""), (3, rows[3][1]), (202, "long text " * 500)]
    docs = spark.createDataFrame(rows, SCHEMA)
    packed = packing.packed(docs, FILE, size=64, group_rows=group_rows).collect()
    n = check(rows, packed, 64)
    total = sum(r.length for r in packed)
    assert n <= -(-total // 64) + 2 + (0 if group_rows > 1000 else 13)
    assert packing.packed(docs.limit(0), FILE).collect() == []


def test_cut_lengths():
    for n in range(1, 40):
        parts = list(packing.cut(n, 8))
        assert [b for _, b in parts][1:] == [8] * (len(parts) - 1) and sum(b for _, b in parts) == n
        assert [a for a, _ in parts] == [sum(b for _, b in parts[:i]) for i in range(len(parts))]


def draws():
    rng = random.Random(6)
    yield [rng.randint(1, 1023) for _ in range(3000)]
    yield [rng.randint(200, 520) for _ in range(3000)]
    yield [rng.randint(1, 30) for _ in range(3000)]
    yield [400] * 100 + [624] * 100 + [312] * 50
    yield [1023]
    yield []


@pytest.mark.parametrize("lengths", list(draws()))
def test_search_never_loses_and_never_needs_more(lengths):
    first, best = packing.best_fit(lengths, 1024), packing.pack(lengths, 1024)
    assert sorted(i for b in best for i in b) == list(range(len(lengths)))
    assert all(0 < sum(lengths[i] for i in b) <= 1024 for b in best)
    assert len(best) <= len(first)
    big = sum(n > 512 for n in lengths)
    assert len(best) >= max(big, -(-sum(lengths) // 1024))


def test_exchanges_empty_a_bin_that_moves_cannot():
    """Best fit gives 3 bins; swapping one for one and two for one makes 2."""
    lengths = [5, 5, 4, 4, 3, 3]
    first = [[0, 2], [1, 3], [4, 5]]
    search = packing._Search(lengths, 12, first)
    assert len(search.run(packing.SWEEPS)) == 2


def test_search_improves_on_best_fit():
    rng = random.Random(6)
    lengths = [rng.randint(200, 520) for _ in range(3000)]
    assert len(packing.pack(lengths, 1024)) < len(packing.best_fit(lengths, 1024))


def test_the_query_on_whole_texts(spark):
    from eventweir.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    packed = QUERIES["op7_swap_packing"](spark, folder).collect()
    n = check(rows, packed, 1024)
    assert n <= 1.02 * -(-sum(r.length for r in packed) // 1024) + 1


def test_exchanges_that_leave_room_count_as_well():
    """Swapping 136 for 102 between underfull bins, then moving 102, saves one of four."""
    lengths = [748, 408, 408, 374, 357, 289, 136, 136, 102, 102]
    assert len(packing.best_fit(lengths, 1024)) == 4 and len(packing.pack(lengths, 1024)) == 3


def test_lengths_with_a_common_divisor_are_exchanged():
    rng = random.Random(6)
    lengths = [17 * rng.randint(12, 30) for _ in range(2000)]
    best = packing.pack(lengths, 1024)
    assert sorted(i for b in best for i in b) == list(range(len(lengths)))
    assert max(sum(lengths[i] for i in b) for b in best) <= 1024
    assert len(best) < len(packing.best_fit(lengths, 1024))


def test_groups_are_improved_together(spark):
    """Half sequences that are left over in odd groups fill each other."""
    rows = [(i, "a" + " a" * 30) for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    packed = packing.packed(docs, FILE, size=64, group_rows=10).collect()
    assert {r.length for r in packed} == {32}
    assert check(rows, packed, 64) == 30


def fewest(lengths, size):
    """The least number of bins, by trying every way to fill the bin of the longest item."""
    if not lengths:
        return 0
    head, rest = lengths[0], lengths[1:]
    fills = range(1 << len(rest))
    ways = [w for w in fills if head + sum(n for k, n in enumerate(rest) if w >> k & 1) <= size]
    return 1 + min(fewest([n for k, n in enumerate(rest) if not w >> k & 1], size) for w in ways)


def test_tiny_inputs_against_an_exact_packer():
    rng = random.Random(9)
    over = 0
    for _ in range(120):
        lengths = sorted((rng.randint(1, 12) for _ in range(rng.randint(1, 7))), reverse=True)
        over += len(packing.pack(lengths, 12)) - fewest(lengths, 12)
    assert over <= 1


def test_groups_are_dealt_to_as_many_tasks(spark):
    """Small groups are not merged into few tasks, and rounds are read in one scan."""
    spark.conf.set("spark.sql.shuffle.partitions", 6)
    try:
        rows = spark.range(600).selectExpr("id as row_id", "cast(id % 12 as bigint) as group", "id as doc_id",
                                           "0 as piece", "0L as start", "10L as length", "0L as ids_crc32")
        schema = rows.drop("row_id", "group").schema
        schema = schema.add("sequence_id", "long").add("offset", "long").add("filled", "long")
        solved = packing._solve(rows, 12, 64, schema)
        assert solved.rdd.getNumPartitions() == 6
        assert min(solved.rdd.glom().map(len).collect()) == 100
        docs = spark.createDataFrame([(i, "a" + " a" * (i % 30)) for i in range(90)], SCHEMA)
        plan = packing.packed(docs, FILE, size=64, group_rows=10)
        assert plan._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)

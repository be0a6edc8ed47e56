"""Token counts against the library itself."""
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from eventweir.llm import pretokens, token_counts

FILE = path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string"
LIBRARY = Tokenizer.from_file(FILE)

TEXTS = [
    "",
    "Hello world, it's he'll WE'RE 'tis",
    " two  spaces   three\n\n\t tabs \r\n end  ",
    "<|endoftext|> and <|endoftext|><|endoftext|>x<|endoftext",
    "²³¹¼½¾ ªº µ ÀÖØöøÿ ×÷ 12٣४",
    "\x1c\x1d \x1e\x1f \x85 \xa0   　 x",
    "日本語のテキスト 한국어 😀👍🏽 é",
    "a" * 300 + " " * 300 + "1" * 300 + "!" * 300,
    "_under_score __ x_y",
    "\x00\x01\x7f",
]


def ids_of(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def own_ids(text, pieces, cut):
    return [i for piece in cut(text) for i in pieces[piece]]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_are_the_librarys(text):
    pieces, cut = pretokens.Pieces(FILE, list), pretokens.splitter(FILE)
    assert own_ids(text, pieces, cut) == ids_of(text)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="a'sl1 \n\t.é²_\x1c<|endoftext|>", max_size=60))
def test_ids_of_any_text(text):
    pieces, cut = pretokens.Pieces(FILE, list), pretokens.splitter(FILE)
    assert own_ids(text, pieces, cut) == ids_of(text)


def test_a_full_cache_forgets_and_stays_right():
    rng = random.Random(1)
    pieces, cut = pretokens.Pieces(FILE, list, most=5, fixed={" the": ids_of(" the")}), pretokens.splitter(FILE)
    for _ in range(50):
        text = "".join(rng.choice(" abcdef the") for _ in range(40)) + "<|endoftext|>"
        assert own_ids(text, pieces, cut) == ids_of(text)
        assert len(pieces) <= 5 + 1 + 1 and len(pieces._old) <= 5 + 1 + 1


@pytest.mark.parametrize("frequent", [65_536, 3])
def test_counts(spark, frequent):
    rows = list(enumerate(TEXTS)) + [(None, "null id"), (100, None), (1, TEXTS[1])]
    rows.append((101, "word " * 100_000))
    docs = spark.createDataFrame(rows, SCHEMA)
    found = token_counts.token_counts(docs, FILE, limit=100, frequent=frequent).collect()
    key = lambda r: (r[0] is None, r)
    expected = [(i, len((t or "").encode()), len(ids_of(t or "")), len(ids_of(t or "")) > 100) for i, t in rows]
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)
    assert token_counts.token_counts(docs.limit(0), FILE, limit=100).collect() == []


def test_table_holds_the_most_frequent(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "SUMMARY", 50)
    texts = [(i, " the" * 20 + " of" * 10 + f" rare{i}") for i in range(200)]
    lengths = token_counts.frequent_lengths(spark.createDataFrame(texts, SCHEMA), FILE, frequent=2)
    assert lengths == {" the": 1, " of": 1}


def test_the_query_on_whole_texts(spark):
    from eventweir.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    found = {r.doc_id: r for r in QUERIES["op8_token_counts"](spark, folder).collect()}
    assert len(found) == len(rows)
    for r in rows:
        n = len(ids_of(r.text))
        assert tuple(found[r.doc_id]) == (r.doc_id, len(r.text.encode()), n, n > 1024)

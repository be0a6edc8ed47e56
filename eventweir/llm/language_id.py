"""Language identification by multinomial naive Bayes over hashed character n-grams.

Training counts cover all labelled documents: tasks count n-grams by language and bucket in numpy and
hand on one row for each bucket they met; Spark adds these up.  The model, a matrix of
log-probabilities, languages by buckets, is broadcast: its size is bounded by ``MAX_LANGUAGES`` and
the number of buckets, however large the corpus.  Scoring gathers its columns by the n-grams of a
whole batch of texts and sums them by text.

The score is the posterior probability of the predicted language.  Texts that are null or have no
letter are ``und`` with score 0; other texts have no language and score 0 when nothing was labelled.
An empty table gives an empty result; repeated rows are scored each on their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from eventweir.llm.arrow import slices
from eventweir.llm.grams import batches as gram_batches
from eventweir.workspace import materialise

UNKNOWN = "und"
#: N-gram lengths and bits of their buckets.
ORDERS = (1, 2, 3)
BITS = 14
MAX_LANGUAGES = 256
#: Added to every count.
SMOOTHING = 0.5


@dataclass(frozen=True)
class Model:
    """Languages, their log share of the labelled documents, log-probability by bucket and language."""

    languages: tuple[str, ...]
    prior: np.ndarray
    logs: np.ndarray


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    width = len(ORDERS) << BITS
    counts: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in slices(batches):
        texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        own: dict[str, list[str]] = {}
        for text, lang in zip(texts, langs, strict=True):
            own.setdefault(lang, []).append(text)
        for lang, some in own.items():
            total = counts.setdefault(lang, np.zeros(width, np.int64))
            docs[lang] = docs.get(lang, 0) + len(some)
            for grams in gram_batches(some):
                for k, n in enumerate(ORDERS):
                    found = np.bincount(grams.buckets(n, BITS), minlength=1 << BITS)
                    total[k << BITS : (k + 1) << BITS] += found
    for lang, total in counts.items():
        met = np.flatnonzero(total)
        # bucket -1 counts the documents
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * (len(met) + 1), pa.string()),
                pa.array(np.r_[met, -1], pa.int32()),
                pa.array(np.r_[total[met], docs[lang]], pa.int64()),
            ],
            names=["lang", "bucket", "n"],
        )


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """The model of all rows whose text and language are not null."""
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.filter("text is not null and lang is not null")
    sums = (
        rows.mapInArrow(_count, "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    sums = materialise(sums, "gram-counts")
    names = sums.filter("bucket = -1").select("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = sums.toArrow()  # at most languages x buckets rows
    langs = table.column("lang").to_pylist()
    languages = tuple(sorted(set(langs)))
    counts = np.zeros((len(languages), len(ORDERS) << BITS))
    docs = np.zeros(len(languages))
    place = {name: i for i, name in enumerate(languages)}
    rows_of = np.array([place[name] for name in langs], np.int64)
    bucket, n = table.column("bucket").to_numpy(), table.column("n").to_numpy()
    grams = bucket >= 0
    counts[rows_of[grams], bucket[grams]] = n[grams]
    docs[rows_of[~grams]] = n[~grams]
    logs = np.zeros_like(counts)
    for k in range(len(ORDERS)):
        part = counts[:, k << BITS : (k + 1) << BITS] + SMOOTHING
        share = part / part.sum(axis=1, keepdims=True)
        logs[:, k << BITS : (k + 1) << BITS] = np.log(share)
    prior = np.log(docs / docs.sum()) if len(languages) else docs
    return Model(languages, prior, np.ascontiguousarray(logs.T, np.float32))


def score_texts(model: Model, texts: list[str]) -> np.ndarray:
    """Posterior probability of each language by text."""
    total = np.tile(model.prior, (len(texts), 1))
    for grams in gram_batches(texts):
        for k, n in enumerate(ORDERS):
            logs = model.logs[(k << BITS) + grams.buckets(n, BITS)]
            sums = np.add.reduceat(logs, grams.starts, axis=0, dtype=np.float64)
            np.add.at(total, grams.numbers, sums)
    total -= total.max(axis=1, keepdims=True)
    odds = np.exp(total)
    return odds / odds.sum(axis=1, keepdims=True)


def _predict(model, schema: pa.Schema):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in slices(batches):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            known = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
            langs: list[str | None] = [UNKNOWN] * len(texts)
            scores = np.zeros(len(texts))
            if not own.languages:
                for i in known:
                    langs[i] = None
            elif known:
                odds = score_texts(own, [texts[i] for i in known])
                best = odds.argmax(axis=1)
                scores[known] = odds[np.arange(len(known)), best]
                for i, b in zip(known, best, strict=True):
                    langs[i] = own.languages[b]
            kept = [batch.column(batch.schema.get_field_index(f.name)) for f in list(schema)[:-2]]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(langs, pa.string()), pa.array(scores)], schema=schema
            )

    return predict


def predict(rows: DataFrame, model: Model) -> DataFrame:
    """The columns of ``rows`` but ``text``, with lang_pred and score of ``text``."""
    shipped = rows.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = StructType(kept).add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(_predict(shipped, to_arrow_schema(schema)), schema)


def identify(
    docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """doc_id, held_out, lang_pred and score; the model is trained on rows that are not held out."""
    model = train(docs.filter(~held_out), text, lang)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), F.col(text).alias("text")
    )
    return predict(rows, model)


def accepted_rows(
    docs: DataFrame, held_out: Column, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """The rows of ``docs`` that have a language, with all their columns: those not ``und``."""
    model = train(docs.filter(~held_out), text, lang)
    row = F.struct(*[F.col(c) for c in docs.columns])
    judged = predict(docs.select(row.alias("row"), F.col(text).alias("text")), model)
    return judged.filter(~F.col("lang_pred").eqNullSafe(UNKNOWN)).select("row.*")

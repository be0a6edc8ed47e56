"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are positives, all other training text is unlabelled.  Linear classifiers
over the presence of hashed words and character n-grams are trained in numpy on the risk of positive and
unlabelled examples, corrected by the class prior.  With prior ``p`` the risk on negatives is
estimated as (loss of unlabelled as negative) - p x (loss of positives as negative); where a batch's
estimate falls below zero the step goes against it instead, so that the classifiers cannot win by
fitting single positives.

The classifiers see a bounded sample: the ``POSITIVES`` toxic and ``UNLABELLED`` other training rows
whose ids have the smallest hashes.  Their words and n-grams are counted in tasks; the ``FEATURES`` buckets that
differ most between both sides are kept, and what reaches the driver is one bit for each of these and
each sampled row.  A feature is one word or n-gram of its bucket, told by its 64-bit hash.  Scoring
covers every whole text, in windows of ``WINDOW`` code points: those of a batch are hashed at once, and
only places whose bucket is a feature are looked at further.

Null texts count as empty and get the classifiers' constant.  Without any positive example every
score is 0.  An empty table gives an empty result; repeated rows are scored each on their own.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from eventweir.llm.arrow import slices, texts
from eventweir.llm.grams import Batch, batches
from eventweir.workspace import materialise

#: Bounds of the sample that classifiers are fitted on.
POSITIVES = 4_096
UNLABELLED = 16_384
#: Bits of the buckets of whole words, n-gram lengths, bits of their buckets.
WORD_BITS = 18
ORDERS = (5, 6)
BITS = 16
#: Buckets that are kept as features at most, and by how many standard errors of its share among the
#: positives a feature's share has to exceed that among unlabelled rows.
FEATURES = 512
APART = 5.0
#: Code points of the windows that texts are scored by, and that they share with the next; the
#: logarithm of the odds that one of several can have at most.
WINDOW = 4_096
OVERLAP = 64
MOST_ODDS = 4.0
#: Classifiers whose scores are averaged, steps of each, unlabelled rows of a step.
CLASSIFIERS = 3
STEPS = 1_500
BATCH_ROWS = 1_024
STEP = 0.02
DECAY = 1e-6
#: Weights go no lower: features were chosen for being commoner among the positives.
LEAST_WEIGHT = -0.5

_WORDS_FROM = len(ORDERS) << BITS
_WIDTH = _WORDS_FROM + (1 << WORD_BITS)


@dataclass(frozen=True)
class Model:
    """The feature of each bucket (-1: none), the hash of each feature's word or n-gram, weights by
    feature and classifier, constants."""

    feature: np.ndarray
    key: np.ndarray
    weights: np.ndarray
    constants: np.ndarray


def _places(grams: Batch, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Part, feature and hash at each place whose bucket is a feature."""
    parts, whiches, hashes = [], [], []
    sets = [(None, grams.hashes(n), BITS, k << BITS) for k, n in enumerate(ORDERS)]
    sets.append((*grams.words(), WORD_BITS, _WORDS_FROM))
    for begin, hashed, bits, first in sets:
        which = feature[first + (hashed >> np.uint64(64 - bits)).astype(np.int64)]
        here = np.flatnonzero(which >= 0)
        place = here if begin is None else begin[here]
        parts.append(np.searchsorted(grams.starts, place, side="right") - 1)
        whiches.append(which[here])
        hashes.append(hashed[here])
    return tuple(np.concatenate(x) for x in (parts, whiches, hashes))


def _distinct(numbers: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair once, in order."""
    pairs = np.unique(numbers * (1 << 20) + which)
    return pairs >> 20, pairs & ((1 << 20) - 1)


def _of_texts(some: list[str], feature: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text and feature of each bucket that is present in a text, once however long the text."""
    held: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.int64),) * 2
    for grams in batches(some, overlap=OVERLAP):
        part, which, _ = _places(grams, feature)
        number, which = _distinct(
            np.r_[held[0], grams.numbers[part]], np.r_[held[1], which]
        )
        goes_on = number == grams.numbers[-1]
        yield number[~goes_on], which[~goes_on]
        held = number[goes_on], which[goes_on]
    yield held


def presence(some: list[str], feature: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which features each text has, as a matrix of zeros and ones."""
    matrix = np.zeros((len(some), len(key)), np.float32)
    for grams in batches(some, overlap=OVERLAP):
        part, which, hashed = _places(grams, feature)
        same = hashed == key[which]
        matrix[grams.numbers[part[same]], which[same]] = 1
    return matrix


def _spelled(feature: np.ndarray):
    """In how many positive rows each word or n-gram of the feature buckets occurs."""

    def spelled(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[int, int]] = Counter()
        for batch in slices(parts):
            for text in texts(batch.column("text")):
                own = set()
                for grams in batches([text], overlap=OVERLAP):
                    _, which, hashed = _places(grams, feature)
                    own |= set(zip(which.tolist(), hashed.astype(np.int64).tolist(), strict=True))
                counts.update(own)
        rows = [(*pair, n) for pair, n in counts.items()]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[1:])],
            names=["feature", "hash", "n"],
        )

    return spelled


def _document_counts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many positive and other rows each bucket occurs."""
    counts = np.zeros((2, _WIDTH), np.int64)
    for batch in slices(parts):
        positive, own = batch.column("positive").to_pylist(), texts(batch.column("text"))
        for side, wanted in enumerate((True, False)):
            picked = [t for t, p in zip(own, positive, strict=True) if p == wanted]
            if picked:
                counts[side] += np.bincount(buckets_present(picked), minlength=_WIDTH)
    met = np.flatnonzero(counts.sum(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(met, pa.int32()), pa.array(counts[0][met]), pa.array(counts[1][met])],
        names=["bucket", "n_positive", "n_other"],
    )


def buckets_present(some: list[str]) -> np.ndarray:
    """The buckets present in each text, one after the other."""
    every = np.arange(_WIDTH)
    return np.concatenate([which for _, which in _of_texts(some, every)])


def _sample_bits(feature: np.ndarray, key: np.ndarray):
    def bits(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(parts):
            matrix = presence(texts(batch.column("text")), feature, key)
            packed = [row.tobytes() for row in np.packbits(matrix.astype(bool), axis=1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("positive"), pa.array(packed, pa.binary())],
                names=["positive", "bits"],
            )

    return bits


def fit(positive: np.ndarray, other: np.ndarray, prior: float, seed: int) -> tuple[np.ndarray, float]:
    """Weights and constant of one classifier, by Adam on the non-negative risk of sigmoid loss."""
    rng = np.random.default_rng(seed)
    width = positive.shape[1]
    theta = np.zeros(width + 1)
    theta[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros(width + 1), np.zeros(width + 1)
    order, at = rng.permutation(len(other)), 0
    for step in range(1, STEPS + 1):
        if at >= len(order):
            order, at = rng.permutation(len(other)), 0
        u = other[order[at : at + BATCH_ROWS]]
        at += BATCH_ROWS
        p = positive[rng.integers(0, len(positive), BATCH_ROWS // 4)]
        yes_p, yes_u = (1 / (1 + np.exp(-(m @ theta[:-1] + theta[-1]))) for m in (p, u))
        slope_p, slope_u = yes_p * (1 - yes_p) / len(p), yes_u * (1 - yes_u) / len(u)
        if yes_u.mean() - prior * yes_p.mean() >= 0:
            by_p, by_u = -2 * prior * slope_p, slope_u
        else:
            by_p, by_u = prior * slope_p, -slope_u
        gradient = np.r_[p.T @ by_p + u.T @ by_u + DECAY * theta[:-1], by_p.sum() + by_u.sum()]
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        scale = np.sqrt(square / (1 - 0.999**step)) + 1e-8
        theta -= STEP * mean / (1 - 0.9**step) / scale
        np.maximum(theta[:-1], LEAST_WEIGHT, out=theta[:-1])
    return theta[:-1], theta[-1]


def _sample(rows: DataFrame) -> DataFrame:
    """The positive and other training rows with the smallest hashes, a written table.

    Of rows that repeat an id, however many, one is taken.
    """
    ids = rows.select("id", "toxic").withColumn("rank", F.xxhash64("id"))
    ids = ids.groupBy("id", "rank").agg(F.max("toxic").alias("toxic"))
    positive = ids.filter("toxic = 1").orderBy("rank", "id").limit(POSITIVES)
    other = ids.orderBy("rank", "id").limit(UNLABELLED)
    chosen = positive.select("id", F.lit(True).alias("positive")).union(
        other.select("id", F.lit(False).alias("positive"))
    )
    chosen = materialise(chosen.distinct(), "sample-ids")  # at most both bounds together
    sample = rows.select("id", "text").join(F.broadcast(chosen), "id")
    once = sample.groupBy("id", "positive").agg(F.min("text").alias("text"))
    return materialise(once.select("positive", "text"), "sample")


def train(docs: DataFrame, labels: DataFrame, held_out: Column, prior: float | None = None) -> Model:
    """A model from rows that are not held out; the class prior is the toxic share of labelled ones
    unless given.

    ``docs`` has columns id, text; ``labels`` has id, toxic.
    """
    known = labels.filter("toxic is not null").groupBy("id").agg(F.max("toxic").alias("toxic"))
    rows = docs.filter(~held_out).filter("id is not null").join(known, "id", "left")
    if prior is None:
        share = rows.select("toxic").agg(F.avg(F.col("toxic").cast("double"))).first()[0]
        prior = min(max(share or 0.0, 1e-4), 0.9)
    sample = _sample(rows)
    counts = (
        sample.mapInArrow(_document_counts, "bucket int, n_positive long, n_other long")
        .groupBy("bucket")
        .agg(F.sum("n_positive").alias("n_positive"), F.sum("n_other").alias("n_other"))
        .toArrow()  # one row for each bucket at most
    )
    sides = dict(map(tuple, sample.groupBy("positive").count().collect()))
    n_positive, n_other = sides.get(True, 0), sides.get(False, 0)
    feature = np.full(_WIDTH, -1, np.int64)
    if not n_positive or not n_other:
        return Model(feature, np.zeros(FEATURES, np.uint64), np.zeros((FEATURES, 1)), np.array([-np.inf]))
    bucket = counts.column("bucket").to_numpy()
    share_p = (counts.column("n_positive").to_numpy() + 0.5) / (n_positive + 1)
    share_u = (counts.column("n_other").to_numpy() + 0.5) / (n_other + 1)
    apart = (share_p - share_u) / np.sqrt(share_u * (1 - share_u) / n_positive + 1e-9)
    best = np.lexsort((bucket, -apart))[:FEATURES]
    best = best[apart[best] >= APART]
    feature[bucket[best]] = np.arange(len(best))
    key = _keys(sample, feature)
    bits = sample.mapInArrow(_sample_bits(feature, key), "positive boolean, bits binary").toArrow()
    packed = np.frombuffer(b"".join(bits.column("bits").to_pylist()), np.uint8)
    matrix = np.unpackbits(packed.reshape(bits.num_rows, -1), axis=1)[:, :FEATURES]
    positive = np.array(bits.column("positive").to_pylist(), bool)
    order = np.lexsort(tuple(packed.reshape(bits.num_rows, -1).T))  # alike, however rows arrive
    matrix, positive = matrix[order].astype(np.float32), positive[order]
    fits = [fit(matrix[positive], matrix[~positive], prior, seed) for seed in range(CLASSIFIERS)]
    return Model(feature, key, np.stack([w for w, _ in fits], 1), np.array([c for _, c in fits]))


def _keys(sample: DataFrame, feature: np.ndarray) -> np.ndarray:
    """By feature the hash of the word or n-gram that is in most positive rows.

    Others that share its bucket are no features: in a long text some of them always occur.
    """
    spelled = sample.filter("positive").select("text")
    spelled = spelled.mapInArrow(_spelled(feature), "feature int, hash long, n long")
    spelled = spelled.groupBy("feature", "hash").agg(F.sum("n").alias("n"))
    best = spelled.groupBy("feature").agg(F.max_by("hash", F.struct("n", "hash")).alias("hash"))
    key = np.zeros(FEATURES, np.uint64)
    for row in best.collect():  # one for each feature
        key[row.feature] = np.uint64(row.hash & ((1 << 64) - 1))
    return key


def score_texts(model: Model, some: list[str]) -> np.ndarray:
    """The probability that a text is toxic: the mean odds of its windows, by classifier, averaged.

    A window is as long as a usual text, so a long one is no likelier toxic for its length, and one
    that is toxic throughout no less.  A window's odds are bounded, so that out of very many a few
    mistaken ones do not decide.
    """
    windows = np.array([max(1, -(-len(text) // WINDOW)) for text in some])
    odds = np.zeros((len(some), len(model.constants)))
    for grams in batches(some, WINDOW, OVERLAP):
        part, which, hashed = _places(grams, model.feature)
        same = hashed == model.key[which]
        matrix = np.zeros((len(grams.numbers), len(model.weights)), np.float32)
        matrix[part[same], which[same]] = 1
        raw = matrix @ model.weights + model.constants
        several = windows[grams.numbers][:, None] > 1
        bounded = np.exp(np.where(several, np.minimum(raw, MOST_ODDS), np.minimum(raw, 700)))
        np.add.at(odds, grams.numbers, bounded)
    odds /= windows[:, None]
    return (odds / (1 + odds)).mean(axis=1)


def _scores(model, schema: pa.Schema):
    def scores(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in slices(parts):
            found = score_texts(own, texts(batch.column(batch.schema.get_field_index("text"))))
            kept = [batch.column(batch.schema.get_field_index(f.name)) for f in list(schema)[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found)], schema=schema)

    return scores


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    prior: float | None = None,
) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 where the score is at least 0.5).

    ``held_out`` is a condition on the columns of ``docs``; rows it marks are never learned from.
    """
    rows = docs.select(
        F.col(doc_id).alias("id"), held_out.alias("held_out"), F.col(text).alias("text")
    )
    known = labels.select(F.col(doc_id).alias("id"), F.col(toxic).alias("toxic"))
    model = train(rows, known, F.col("held_out"), prior)
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([f for f in rows.schema.fields if f.name != "text"]).add("score", "double")
    scored = rows.mapInArrow(_scores(shipped, to_arrow_schema(schema)), schema)
    return scored.select(
        F.col("id").alias("doc_id"),
        "held_out",
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )

"""The corpus pipeline: stages that each take the documents the one before has kept.

Every stage works on all rows it is given, whatever columns they have beside ``doc_id``, ``text`` and
``lang``, and all but the last return rows with just these columns.  Null and empty texts have no
letter and so go in the first stage; empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventweir.llm import decontamination, exact_dedup, language_id, packing, simhash
from eventweir.llm.arrow import text_crc32
from eventweir.llm.queries import table, tokenizer_file
from eventweir.workspace import fresh_path, remove, write_table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some learned language stay; those without any letter go (operator 6).

    Trained, like the query of its own, on labelled rows that are not held out.
    """
    return language_id.accepted_rows(docs, held_out=text_crc32("doc_id") % 3 == 1)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays (operator 2)."""
    return exact_dedup.distinct_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays (operator 5)."""
    return simhash.representatives(docs, words=4, max_bits=4, seed=42)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a benchmark has contaminated go (operator 9)."""
    return decontamination.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are left as pieces of sequences of 1024 tokens (operator 7)."""
    return packing.packed(docs, tokenizer_file("byte_bpe_50k.json"), size=1024, end_id=2)


STAGES = [
    ("language identification", known_language),
    ("exact dedup", exact_duplicates),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_free),
    ("best-fit packing", packed_sequences),
]

#: Trained models, near duplicates and packing have no SQL form; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_path(spark, name.replace(" ", "-"))
        docs = write_table(stage(spark, docs, sf_dir), path)
        if before:
            remove(spark, before)
        before = path
    return docs

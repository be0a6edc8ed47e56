"""The registered queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweir.llm import (
    decontamination,
    exact_dedup,
    hard_negatives,
    language_id,
    lexical_search,
    packing,
    pii,
    quality,
    secrets,
    simhash,
    spans,
    token_counts,
    toxicity,
    warc,
)
from eventweir.llm.arrow import text_crc32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_nonnegative_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.toxicity(docs, labels, held_out=text_crc32("doc_id") % 5 == 0)


def op2_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's file, the same on driver and executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.summary(pii.personal_data(table(spark, sf_dir, "documents")), pii.KINDS)


def op4_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op5_simhash_tries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, max_bits=4, seed=42)


def op6_naive_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, held_out=text_crc32("doc_id") % 3 == 1)


def op7_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.packed(docs, tokenizer_file("byte_bpe_50k.json"), size=1024, end_id=2)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, tokenizer_file("byte_bpe_50k.json"), limit=1024)


def op9_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = table(spark, sf_dir, "benchmark")
    return decontamination.contamination(table(spark, sf_dir, "documents"), benchmark)


def op10_decoded_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.summary(secrets.secrets(table(spark, sf_dir, "documents")), secrets.KINDS)


def op11_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = table(spark, sf_dir, "benchmark")
    return lexical_search.ranked(table(spark, sf_dir, "documents"), benchmark, k=50)


def op12_certified_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.judged(docs, labels, strata=["lang"]).drop("rejected_by")


def op13_threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(
        table(spark, sf_dir, "embeddings"), is_anchor=F.col("vec_id") % 100 == 0, label=moved
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nonnegative_pu": op1_nonnegative_pu,
    "op2_content_sort": op2_content_sort,
    "op3_weak_supervision": op3_weak_supervision,
    "op4_warc_index": op4_warc_index,
    "op5_simhash_tries": op5_simhash_tries,
    "op6_naive_bayes": op6_naive_bayes,
    "op7_swap_packing": op7_swap_packing,
    "op8_token_counts": op8_token_counts,
    "op9_wu_manber": op9_wu_manber,
    "op10_decoded_secrets": op10_decoded_secrets,
    "op11_ball_tree": op11_ball_tree,
    "op12_certified_rules": op12_certified_rules,
    "op13_threshold_negatives": op13_threshold_negatives,
}

"""The operators over their whole tables, with production parameters: one query for each."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (byte_bpe, decontamination, fill_middle, language_model, lines, mixing, pages, pii, quality, sentences,
               toxicity, whitening)
from .common import table
from .jaccard import Similarity, jaccard_join


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked at a Jaccard similarity of 0.9 or more of their 3-word shingles."""
    found = jaccard_join(table(spark, sf_dir, "documents"), "doc_id", "text", Similarity(3, 90, 100), count_links=False)
    return found.selectExpr("id AS doc_id", "n_shingles", "component AS component_id")


def op2_tag_path_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return pages.extract(table(spark, sf_dir, "pages")).select(
        F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in all documents."""
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2("base", 256).alias("base_sha256"), "spans")


def op4_sentence_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that lose sentences, of runs of any length: their numbers, and the documents in which the spans come first."""
    found = sentences.covered(sentences.repeated_spans(table(spark, sf_dir, "documents"), min_words=1))
    return found.select(F.col("id").alias("doc_id"), F.size("gone").cast("long").alias("n_removed"),
                        F.concat_ws(",", F.transform("gone", lambda x: x.cast("string"))).alias("sentences"),
                        F.col("kept_ids").alias("kept_in"))


def op5_seed_alignment_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a test item that it holds."""
    found = decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.selectExpr("id AS doc_id", "item AS item_id", "score", "first_word", "stop_word")


def op6_kneser_ney_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model of those that are not held out."""
    return language_model.score_documents(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op7_deletion_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that lose lines, of one word or more: the lines' numbers, how many of them are near ones, and whose lines stay."""
    found = lines.dropped_lines(table(spark, sf_dir, "documents"), min_words=1, near_words=5)
    return found.groupBy(F.col("id").alias("doc_id"), "th").agg(
        F.count("*").alias("n_dropped"), F.sum(F.col("near").cast("long")).alias("n_near"),
        F.concat_ws(",", F.transform(F.sort_array(F.collect_list("line")), lambda x: x.cast("string"))).alias("lines"),
        F.sort_array(F.collect_set("kept_id")).alias("kept_in")).drop("th")


def op8_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against the fences of their language and source."""
    return quality.quality_filter(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op9_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a classifier of the labelled ones."""
    found = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumnRenamed("id", "doc_id")


def op10_low_discrepancy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the targets of their sources."""
    return mixing.mix_sources(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op11_bit_sliced_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All whole vectors on up to 32 components. A deviation that a long doesn't hold is null; ``deviation_exact`` has it."""
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "component", "n", F.expr("try_cast(deviation AS long)").alias("deviation"),
                        "whitened", "explained", "identity_error", F.col("deviation").alias("deviation_exact"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents transformed and restored, as digests."""
    return fill_middle.fill_middle(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded, as digests."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN).withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_tag_path_extraction": op2_tag_path_extraction,
    "op3_bootstrapped_pii": op3_bootstrapped_pii,
    "op4_sentence_span_dedup": op4_sentence_span_dedup,
    "op5_seed_alignment_decontamination": op5_seed_alignment_decontamination,
    "op6_kneser_ney_scores": op6_kneser_ney_scores,
    "op7_deletion_line_dedup": op7_deletion_line_dedup,
    "op8_adaptive_quality": op8_adaptive_quality,
    "op9_counterfactual_toxicity": op9_counterfactual_toxicity,
    "op10_low_discrepancy_mix": op10_low_discrepancy_mix,
    "op11_bit_sliced_whitening": op11_bit_sliced_whitening,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_byte_bpe": op13_byte_bpe,
}

ORACLE_SQL: dict[str, str] = {
    "op8_adaptive_quality": quality.ORACLE_SQL,
    "op10_low_discrepancy_mix": mixing.ORACLE_SQL,
    "op12_fill_in_middle": fill_middle.ORACLE_SQL,
}

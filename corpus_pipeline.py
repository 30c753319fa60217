"""A training corpus from raw documents: five stages, each the whole work of one operator.

Every stage takes (spark, docs, sf_dir) and returns the documents that go on, in the columns of
``documents``; the last returns the mix. Null, empty and repeated rows follow the operators' rules.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import decontamination, jaccard, lines, mixing, toxicity
from kestrel.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of one word or more that occurred before, or nearly so, go; ``n_chars`` follows the text where there is such a column."""
    kept = lines.dedup_lines(docs, min_words=1, near_words=5)
    return kept.withColumn("n_chars", F.length("text").cast(kept.schema["n_chars"].dataType)) if "n_chars" in kept.columns else kept


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, a similarity of 0.8."""
    return jaccard.keep_one_of_each(docs, sim=jaccard.Similarity(5, 80, 100))


def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document."""
    return mixing.mix_sources(docs).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("decontamination", drop_test_items),
    ("mixing", mix),
]

#: A fitted classifier decides which documents go on, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all documents; each one's output is written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

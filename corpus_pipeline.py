"""The training-data pipeline: quality rules, near-duplicates, repeated spans, source mixing, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept; all but the last return the columns of ``docs``, whatever their
names.

Defined results: a null or empty text fails the quality rules. A row without
doc_id is linked with nothing, owns repeated spans last and is mixed by its
text. Of rows that share a doc_id, as of near-duplicates, one stays. A null
source is a source of its own. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm import bpe, minhash_dedup, mixing, quality_rules, span_dedup
from stratus.llm.common import cut, free_name, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five-word shingles, similarity 0.8)."""
    return minhash_dedup.drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sentences of repeated spans are cut out; n_chars follows where a text changed."""
    done = span_dedup.drop_repeated_spans(docs)
    size = F.when(F.col(free_name(docs, "n_removed")) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return done.withColumn("n_chars", size).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to weights by the square root of their size; rows repeat or go as drawn."""
    return mixing.mix_sources(docs).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of the decoded text."""
    return bpe.encode(docs, ["doc_id", "lang", "source"])


STAGES = [("quality_rules", quality), ("minhash_near_dedup", near_dedup), ("substring_dedup", substring_dedup),
          ("source_mixing", mix), ("bpe", tokens)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stage's rows written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs

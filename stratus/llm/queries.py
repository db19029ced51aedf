"""The registered queries of this subpackage: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat_format, chat_repair, cover_tree, hard_negatives, html_extraction, lm_scoring, minhash_dedup, mixing
from . import quality_rules, span_dedup
from . import token_counts as pieces
from . import winnowing
from .common import table


def html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extraction.extract_pages(pages, html_extraction.Learner().fit(pages).weights)


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.token_counts(table(spark, sf_dir, "documents"))


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_chats(table(spark, sf_dir, "conversations"))


def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), minhash_dedup.Settings(
        shingle=3, percent=85, bands=30, rows=6))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), ["doc_id"], with_ids=False)


def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.compare_with_edits(table(spark, sf_dir, "documents"))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return span_dedup.drop_repeated_spans(docs).select("doc_id", "text", "n_removed")


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_texts(table(spark, sf_dir, "documents"))


def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return mixing.mix_sources(docs).withColumnRenamed("copy_no_", "copy_no")


def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"))


def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repair_damaged(table(spark, sf_dir, "conversations"))


def hard_negative_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine_embeddings(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_html_extraction": html_main_text,
        "op2_token_counts": token_counts,
        "op3_chat_formatting": chat_formatting,
        "op4_minhash_near_dedup": minhash_near_dedup,
        "op5_quality_rules": quality,
        "op6_bpe": bpe_round_trip,
        "op7_document_fingerprints": document_fingerprints,
        "op8_substring_dedup": substring_dedup,
        "op9_lm_scoring": lm_scores,
        "op10_source_mixing": source_mixing,
        "op11_embedding_near_dedup": embedding_near_dedup,
        "op12_conversation_repair": conversation_repair,
        "op13_hard_negatives": hard_negative_rows,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_chat_formatting": chat_format.ORACLE,
        "op5_quality_rules": quality_rules.ORACLE,
        "op10_source_mixing": mixing.ORACLE,
        "op11_embedding_near_dedup": cover_tree.ORACLE,
        "op13_hard_negatives": hard_negatives.ORACLE,
    }

"""Queries of the text operators and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lamella.llm import packing, tokenizer, truncation
from lamella.plans.runtime import read_table


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenizer.encode_corpus(read_table(spark, d, "documents"))


def p6_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Texts decoded from their ids."""
    return tokenizer.decode_corpus(tokenizer.encode_corpus(read_table(spark, d, "documents")))


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(tokenizer.token_counts(read_table(spark, d, "documents")))


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return packing.packing_report(p7_containers(spark, d))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncated(read_table(spark, d, "documents"))


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    """How often each source cuts."""
    return truncation.truncation_report(read_table(spark, d, "documents"), p8_found(spark, d))


QUERIES = {
    "p8_found": p8_found,
    "p8_report": p8_report,
    "p6_ids": p6_ids, "p6_round_trip": p6_round_trip, "p7_containers": p7_containers, "p7_report": p7_report}
SQL = {
    "p6_round_trip": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}

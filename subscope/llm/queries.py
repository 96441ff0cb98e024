"""The registered queries of the subpackage and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from subscope.llm import (
    align, bpe, collocations, decontaminate, entropy_mix, html_text, ngram_join, quality, secret_scan, suffix_dedup,
    token_files, url_filter, vector_graph,
)
from subscope.llm.common import ship
from subscope.llm.oracle import ORACLE_SQL  # noqa: F401  read by __spark_entry__.py


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_read(spark, sf_dir, "documents")).drop("spans", "kept")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(_read(spark, sf_dir, "documents"))


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_read(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_read(spark, sf_dir, "pages"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.files_round_trip(_read(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_components(_read(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_read(spark, sf_dir, "pages"))


def op10_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_graph.near_duplicates(_read(spark, sf_dir, "embeddings"))


def op11_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entropy_mix.balance(_read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "rate")


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment(_read(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.phrases(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_suffix_dedup, op2_secret_scan, op3_bpe_round_trip, op4_quality, op5_html_text, op6_token_files,
        op7_decontaminate, op8_ngram_join, op9_url_filter, op10_vector_graph, op11_entropy_mix, op12_align,
        op13_collocations)
}

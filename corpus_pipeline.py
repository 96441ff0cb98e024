"""A corpus pipeline of five stages, each over all that the stage before it kept.

Stages: reject low quality, keep one document of each group of near duplicates, drop documents that
hold benchmark passages, mask secrets, encode and decode. Each takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next one's docs. All but
the last return the columns of ``documents``; the last returns doc_id, n_tokens, ids_sha256 and
decoded_sha256.

Defined cases. Null and empty texts have no quality and go in the first stage. Null ids are kept; of rows with one
null or repeated id and the same words one stays, rows with one id and different words are different
documents. Documents of a language without trusted text are kept. Ties do not matter: copies are equal for
every stage after the second. An empty table gives an empty result. Other columns are handed
on as they are whatever their names, also those a stage uses itself; n_chars follows the masked text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subscope.llm import bpe, decontaminate, ngram_join, quality, secret_scan
from subscope.llm.common import Scratch, ship, shuffles_released


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is no higher than that of nearly all trusted ones of their language."""
    return quality.accepted_documents(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group linked by shingle similarity."""
    ship(spark)
    with shuffles_released(spark):
        return ngram_join.one_of_each_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontaminate.clean_documents(docs, _table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every found secret replaced and n_chars counted anew."""
    ship(spark)
    masked = secret_scan.redact_secrets(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text they decode to, as digests."""
    ship(spark)
    return bpe.round_trip(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", accept_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("encoding", encode),
]

#: SQL cannot express the classifier, the graph components or the tokenizer; tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents."""
    scratch = Scratch(spark)
    docs = _table(spark, sf_dir, "documents")
    written = None
    for _, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir))
        scratch.drop(written)
        written = docs
    return STAGES[-1][1](spark, docs, sf_dir)

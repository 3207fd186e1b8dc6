"""From raw documents to token ids: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.llm import language_id, mixing, near_duplicates, pieces, secret_scan
from martlens.llm.shared import stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told, with that language; those without a letter or far from every language go."""
    model = language_id.learn(language_id.training_part(docs))
    kept = language_id.predict(docs, model).where(~F.col("rejected"))
    return kept.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class, the one with the smallest doc_id."""
    return near_duplicates.without_near_duplicates(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark unless many sources share them."""
    return secret_scan.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, none to two times."""
    return mixing.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and their digests."""
    return pieces.encode_digests(docs, with_ids=True)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("secret_scans", redact_secrets),
    ("mixing", mix_sources),
    ("pieces", encode_pieces),
]

#: Hashing, alignment and tokenization are beyond SQL; the tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""A training corpus from documents, in five stages of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barloom.llm import bpe, langid, mixing, secrets, simhash
from barloom.llm.common import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; null texts and texts without a letter go."""
    return langid.keep_identified(docs, langid.fit(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates."""
    return simhash.simhash_keep(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their kind in brackets in place of secrets."""
    return secrets.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for, up to three times."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, packed, with their number and digests."""
    return bpe.encode_documents(docs, keep_ids=True)


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("tokens", encode),
]

#: No stage but the mixing can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs

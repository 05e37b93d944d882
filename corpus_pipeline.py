"""Corpus pipeline: five stages over ``documents``, each one of the operators
of ``lakefold.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes each result as Parquet in the session's shared folder and reads it
back as the next stage's documents.  All stages but the last return the
columns of their input, whatever they are.

quality     documents that the classifier rejects go
near_dedup  one document of each near-duplicate group stays (five words, 0.8)
pii         personal data is replaced by its kind in brackets
mixing      each row appears as often as the mix takes it
bpe         token ids of every text, and digests of ids and decoded text

Defined results: null, empty and long texts, repeated rows, empty tables and
extra columns are handled as each operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakefold.llm import bpe, minhash, mixing, pii, quality
from lakefold.llm.common import read, stage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.accepted(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicated(docs, n_words=5, percent=80)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact_documents(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_digest(docs.select("doc_id", "text"), with_ids=True)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: The classifier, the random mix and the merges are beyond SQL; the stages
#: are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

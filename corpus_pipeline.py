"""Corpus pipeline: from raw documents to token ids, in stages that are each written and read again.

Every stage takes the rows that its predecessor kept and returns rows with the columns of ``documents``; the
last one returns the encoded corpus. Nulls, empty texts, repeated rows and empty tables pass as the stages'
operators define (see their modules in ``lakehold.llm``).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakehold.llm import bpe, decontaminate, resample, secret_scan, simhash
from lakehold.llm.common import table
from lakehold.session import shared_dir

#: SQL has no twin for learnt samples, components and templates; the tests compare with brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in the importance sample that the quality labels define."""
    sampler, _ = resample.learn(docs, table(spark, sf_dir, "labels"))
    return sampler.select(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies."""
    return simhash.keep_one(docs, words=4, max_bits=4)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with secrets in their texts replaced by a mark."""
    return secret_scan.redact(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all rows, and the digests of ids and decoded text."""
    return bpe.encode_digests(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminated", decontaminated),
    ("secrets", secrets),
    ("encoded", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result but the last is stored in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k + 1 == len(STAGES):
            return out
        path = shared_dir(spark, f"pipeline-{name}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

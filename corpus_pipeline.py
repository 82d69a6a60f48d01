"""Documents to packed training sequences: toxicity, line dedup, near-duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir); all but the last return documents with the columns they got.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from hexatlas.llm import line_dedup, mixing, packing, simhash, toxicity
from hexatlas.llm.common import load, shared_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, load(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, words=3, bits=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sample(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("line_dedup", dedup_lines), ("simhash", drop_near_copies), ("mixing", mix_sources),
          ("packing", pack_sequences)]

#: Trained weights, 64-bit hashes and a tokenizer: not SQL. tests/llm holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as a table in the shared folder and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}-{name}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs

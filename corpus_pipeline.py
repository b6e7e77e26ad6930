"""Cleaning of a corpus in stages; each works on all that the stage before it kept.

Toxic documents go, one document of each group of near-duplicates stays, documents with
benchmark passages go, sources are mixed to their targets, and the mix is written as token ids.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from profilelake.llm import bitplanes, decontaminate, mixing, simhash, toxicity
from profilelake.llm.common import table
from profilelake.session import configure, fresh_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; learns from the labelled ones among them."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of SimHash near-duplicates."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document of the mix, read back from the files: doc_id, start, n_tokens, ids_crc32."""
    path = fresh_path(spark, "corpus")
    bitplanes.write(docs, path)
    return bitplanes.report(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
    ("token_ids", write_token_ids),
]

#: Training and fingerprints have no SQL form; the tests check run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result is written to the shared folder and read again."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}-{uuid.uuid4().hex[:8]}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


PIPELINE = {"pipeline": run}
PIPELINE_ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}

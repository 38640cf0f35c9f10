"""Training-data pipeline over ``documents``, in five stages.

Each stage works on all rows that its predecessor kept, and all but the last
return the columns of ``documents``:

1. language ID: documents without a language (no letter) go;
2. exact dedup: one row of each group of equal texts stays;
3. MinHash near-dedup: one document of each class of near-duplicates stays;
4. mixing: a document appears as often as the mix to target weights takes it;
5. best-fit packing: one row per piece of a document with its place in a sequence.

A null text has no language and goes in stage 1; an empty table passes through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cadence.llm import exact_dedup, langid, mixing, near_dedup, packing
from cadence.llm.common import short_shuffles, table
from cadence.session import scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.remix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", language_id), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("mix_sources", mix_sources), ("best_fit_packing", pack_sequences)]

# Language identification has no SQL form; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each one's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        rows = stage(spark, docs, sf_dir)
        with short_shuffles(spark):
            rows.write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

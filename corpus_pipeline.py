"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the
next one's docs.  All stages but the last return rows of ``documents``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import exact_dedup, mixing, packing, quality_rules, simhash
from tessera.session import ensure_checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that fail the base rules, or whose host is rejected, go."""
    return quality_rules.keep_passing(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: of equal texts the row with the smallest doc_id stays."""
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of each SimHash group the smallest doc_id stays."""
    return simhash.keep_one_per_group(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents are repeated or thinned out at rates that meet the domain targets."""
    return mixing.mix(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: every token of every document gets a place in a sequence."""
    return packing.pack_documents(docs)


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixture), ("packing", sequences)]

# Rates are fitted by iteration and texts are tokenized: not expressible in SQL (the chain is tested for
# its stage names and for doc_ids from the input only; most stages have brute-force tests of their own).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; stage results are tables in the shared checkpoint folder.

    Quality rules, exact dedup, SimHash near-dedup, mixing to target weights, best-fit packing."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline/{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""Corpus pipeline: documents to clean, deduplicated, mixed and sharded training data.

Each stage takes (spark, docs, sf_dir), works on all rows that the one
before kept, and returns a DataFrame that is written as Parquet and read
again as the next stage's ``docs``.  All stages but the last return the
columns of ``documents``; the last adds ``shard`` and ``slot``.

Ties, nulls and repeated rows are as the operators define them.  The rows of
``run`` have no SQL form: the quality rules are learned and the mix is drawn.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tempora.llm import decontaminate, mixing, ngram_join, quality, sharding
from tempora.session import checkpoint_dir

SHARDS = 40


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the learned rules reject go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group that the n-gram Jaccard join links, the smallest id stays."""
    return ngram_join.one_of_each(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target mix of sources draws them."""
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows placed in shards of nearly equal bytes, with gapless slots."""
    placed = sharding.shard(docs, shards=SHARDS)
    return placed.select(*(f"row.`{c}`" for c in docs.columns if c not in ("shard", "slot")), "shard", "slot")


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", benchmark_passages), ("mixing sources to target weights", source_mix),
          ("sharding", shards)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; stages meet in Parquet tables in the shared folder."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs

"""Corpus pipeline: quality rules, near-duplicates, decontamination, mixing, shards.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; ``run`` writes every stage but the last as Parquet in the shared folder
and reads it again.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import decontaminate, mixing, near_dedup, quality, sharding
from tributary.llm.queries import MAX_REPEAT, SHARD_BYTES, table
from tributary.llm.store import checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies."""
    return near_dedup.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of scarce sources repeated."""
    return mixing.realise(docs, max_repeat=MAX_REPEAT).select(*docs.columns)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the name and depth of their shard (names that the
    documents already use get a leading underscore)."""
    out, names = sharding.shard(docs, limit=SHARD_BYTES), {}
    place = out.columns[-1]
    for name in ("shard", "shard_depth"):
        free = name
        while free in docs.columns:
            free = f"_{free}"
        names[name] = free
    return out.select(*docs.columns, F.col(f"{place}.name").alias(names["shard"]), F.col(f"{place}.depth").alias(names["shard_depth"]))


STAGES = [("quality rules", quality_rules), ("near-duplicates", near_duplicates), ("benchmark decontamination", benchmark_decontamination),
          ("source mixing", source_mixing), ("sharding", sharding_stage)]

#: Signatures, alignment and hashed models are not SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs

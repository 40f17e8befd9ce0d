"""The corpus pipeline over ``documents``: five stages, each a table of its own.

quality rules (rejected documents go) -> n-gram Jaccard join (the smallest doc_id
of each group stays) -> benchmark decontamination (documents that hold an item go)
-> mixing sources to target weights (documents repeated or left out) -> sharding
(slot and shard of every row).

A stage takes (spark, docs, sf_dir) and returns a table with the columns of
``docs``; the last adds slot and shard.  Rows with a null doc_id link with nothing
and stay in the second stage.  It judges rows: two texts that share a doc_id are two
documents, equal rows are copies of one, and of a group's rows with the smallest
doc_id the one written first stays.  Very long texts are judged whole.  Other columns
may have any name.  An empty table passes through as an empty table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.llm.decontaminate import decontaminate
from sparkmine.llm.jaccard_join import jaccard_components
from sparkmine.llm.mixing import mix
from sparkmine.llm.quality import length_free_rules, quality_filter
from sparkmine.llm.sharding import assign_shards
from sparkmine.session import cut_lineage, ensure_checkpoint_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_filter(docs, rules=length_free_rules())


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # rows are told apart by a number written with them, so texts that share a doc_id stay apart
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    held = cut_lineage(docs.select(row, F.monotonically_increasing_id().alias("number")))
    known = F.col("row.doc_id").isNotNull()
    found = jaccard_components(held.select(F.when(known, F.col("number")).alias("number"), F.col("row.text").alias("text")), id_col="number")
    named = held.where(known).select("number", F.col("row.doc_id").alias("doc_id")).join(found.withColumnRenamed("doc_id", "number"), "number")
    stays = named.groupBy("component_id").agg(F.min(F.struct("doc_id", "number")).alias("least")).select(F.col("least.number").alias("number"))
    return held.join(stays, "number", "left_semi").select("row.*").unionByName(held.where(~known).select("row.*"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return assign_shards(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources", mixing_stage),
    ("sharding", sharding_stage),
]

#: SimHash windows and the pigeonhole join are not expressible in SQL at this
#: scale; tests/llm/test_licenses_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline/{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{i}")
        docs = spark.read.parquet(f"{root}/{i}")
    return docs

"""Test tables and the transaction views built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.sources.tables import baskets

# The basket choices and thresholds used by the registered queries.
TYPE_SUPPORT = 0.05
BRAND_SUPPORT = 0.005
SON_BUCKETS = 4
SEED = 42


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def part_baskets(spark: SparkSession, sf_dir: str, attr: str) -> DataFrame:
    """Orders as transactions of part attributes: (txn_id = l_orderkey, items).

    Only the join keys and the attribute are read (column pruning reaches the
    parquet scans); the planner picks the join strategy from the sizes."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", attr)
    return baskets(li.join(part, li.l_partkey == part.p_partkey), "l_orderkey", attr)


def type_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_baskets(spark, sf_dir, "p_type")


def brand_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_baskets(spark, sf_dir, "p_brand")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as points: (vec_id, embedding array<float>, label)."""
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")


def label_means(pts: DataFrame) -> DataFrame:
    """Centres = mean vector of every label (cluster = label), n = 0.
    Summed per (label, position) with partial aggregation."""
    per_pos = (
        pts.select("label", F.posexplode("embedding").alias("pos", "v"))
        .groupBy("label", "pos")
        .agg(F.avg(F.col("v").cast("double")).alias("m"))
    )
    return per_pos.groupBy(F.col("label").cast("int").alias("cluster")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("center"),
        F.lit(0).cast("long").alias("n"),
    )

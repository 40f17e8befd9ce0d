"""Connected components of an edge table, without collecting edges or nodes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.session import cut_lineage_observed


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Write one round's edges; (table, order-free fingerprint of its rows)."""
    own = f"k{uuid.uuid4().hex[:8]}"
    h = F.xxhash64("a", "b")
    table, seen = cut_lineage_observed(
        edges, **{f"{own}_n": F.count(F.lit(1)), f"{own}_x": F.bit_xor(h), f"{own}_s": F.sum(F.col("a").cast("decimal(38,0)") + F.col("b"))}
    )
    return table, tuple(seen.values())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for edges (a, b) of long ids: component is the smallest
    node reachable; nodes without an edge are not listed.

    Alternating large-star and small-star rounds: each joins the edges with the
    smallest neighbour per node (aggregated map-side), so a node with very many
    neighbours is a skewed join key that can be split, never one task's list.
    Every round is a written table.
    """
    tidy = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    table, seen = _written(tidy)
    while seen[0]:
        both = table.select(F.col("a").alias("u"), F.col("b").alias("v")).union(table.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u"), F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(root, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        before = seen
        table, seen = _written(small.unionByName(root.withColumnRenamed("m", "b")).distinct())
        if seen == before:
            break
    return table.select(F.col("a").alias("node"), F.col("b").alias("component")).union(table.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

"""Evaluation tables: A11 contingency, A12 entropy, A13 nmi, A19 frequency_table.

Totals are scalar subqueries (one number), never a join of every row with a
one-row table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def contingency(df: DataFrame, a: str, b: str, marginals: bool = True) -> DataFrame:
    """Joint counts (a, b, n); with ``marginals`` also the per-a, per-b and
    grand totals (CUBE), told apart by ``gid`` = grouping_id (0 joint, 1 per a,
    2 per b, 3 total)."""
    if not marginals:
        return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    return df.cube(a, b).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().cast("int").alias("gid"))


def entropy(df: DataFrame, col: str) -> DataFrame:
    """One row, -sum p log2 p over the values of ``col``."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("c"))
    total = counts.agg(F.sum("c")).scalar()
    p = F.col("c") / total
    return counts.agg(F.coalesce(-F.sum(p * F.log2(p)), F.lit(0.0)).alias("entropy"))


def nmi(df: DataFrame, label_col: str, cluster_col: str) -> DataFrame:
    """One row, normalised mutual information MI / ((H_C + H_L) / 2);
    NULL when both entropies are 0 (one label and one cluster).

    Everything comes from the joint counts (one row per label and cluster), so
    the input is read once; a null label or cluster is a value like any other."""
    joint = df.groupBy(F.col(label_col).alias("l"), F.col(cluster_col).alias("c")).agg(F.count(F.lit(1)).alias("n"))
    # with totals N, n_l and n_c: H(L) = log2 N - sum(n log2 n_l) / N, and likewise
    # the others, so no total is needed before the one aggregate
    within = lambda by: F.sum("n").over(Window.partitionBy(by))
    rows = joint.select("n", within("l").alias("n_l"), within("c").alias("n_c"))
    weighed = lambda c: F.sum(F.col("n") * F.log2(c))
    got = rows.agg(F.sum("n").alias("N"), weighed("n").alias("s"), weighed("n_l").alias("s_l"), weighed("n_c").alias("s_c"), F.max("n_l").alias("m_l"), F.max("n_c").alias("m_c"))
    # one label or cluster: exactly 0, whatever the sums' rounding
    entropy_of = lambda total, most: F.when(F.col(most) == F.col("N"), F.lit(0.0)).otherwise(F.log2("N") - F.col(total) / F.col("N"))
    mutual = F.greatest(F.log2("N") + (F.col("s") - F.col("s_l") - F.col("s_c")) / F.col("N"), F.lit(0.0))
    sums = got.select(
        F.when((F.col("m_l") == F.col("N")) | (F.col("m_c") == F.col("N")), F.lit(0.0)).when(F.col("N") > 0, mutual).alias("mi"),
        entropy_of("s_l", "m_l").alias("h_label"),
        entropy_of("s_c", "m_c").alias("h_cluster"),
    )
    denom = (F.col("h_cluster") + F.col("h_label")) / F.lit(2.0)
    return sums.select("mi", "h_label", "h_cluster", F.when(denom > 0, F.col("mi") / denom).alias("nmi"))


def frequency_table(df: DataFrame, col: str) -> DataFrame:
    """(value, n, share) with share = n / total."""
    counts = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("value", "n", (F.col("n") / counts.agg(F.sum("n")).scalar()).alias("share"))

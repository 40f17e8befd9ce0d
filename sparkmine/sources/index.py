"""dense 0-based row index in a given order, optionally within groups.

No single-partition window over the data: rows are range-partitioned on
(group, order), numbered inside each partition by position, and each
(partition, group) block gets the row count of the blocks before it.  The block
table has about #groups + #partitions rows, so a hot group spread over many
partitions stays spread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmine import session
from sparkmine.session import cut_lineage_observed, cut_lineage_sized

_POS_BITS = 33  # monotonically_increasing_id = partition id << 33 | position


def with_group_rank(
    df: DataFrame,
    order_cols: list,
    group_cols: list | tuple = (),
    rank_col: str = "idx",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``rank_col`` = 0-based position of each row within its group in
    ``order_cols`` order. ``order_cols`` must form a total order (end with a
    unique key) for the result to be repeatable."""
    return with_group_rank_counted(df, order_cols, group_cols, rank_col, num_partitions)[0]


def with_group_rank_counted(
    df: DataFrame,
    order_cols: list,
    group_cols: list | tuple = (),
    rank_col: str = "idx",
    num_partitions: int | None = None,
) -> tuple[DataFrame, int]:
    """``with_group_rank`` plus the total row count (observed while the
    tagged rows are written, no extra pass)."""
    spark = df.sparkSession
    group_cols = list(group_cols)
    keys = group_cols + list(order_cols)
    n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (
        df.repartitionByRange(n_parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    # Partition ids and positions must not change between the two passes below.
    tagged, m = cut_lineage_observed(tagged, n=F.count(F.lit(1)))
    tagged = tagged.withColumn("_pid", F.shiftright("_mid", _POS_BITS)).withColumn(
        "_pos", F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    )
    blocks = tagged.groupBy("_pid", *group_cols).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first")
    )
    w = (Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))).orderBy("_pid")
    blocks = blocks.withColumn(
        "_offset",
        F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    ).select(F.col("_pid").alias("_block"), *(F.col(c).alias(f"_g{i}") for i, c in enumerate(group_cols)), "_offset", "_first")
    blocks, _, size = cut_lineage_sized(blocks)
    same = F.col("_pid") == F.col("_block")
    for i, c in enumerate(group_cols):  # a null group is a group
        same &= F.col(c).eqNullSafe(F.col(f"_g{i}"))
    joined = tagged.join(F.broadcast(blocks) if size <= session.BROADCAST_LIMIT_BYTES else blocks, same)
    out = joined.withColumn(rank_col, (F.col("_offset") + F.col("_pos") - F.col("_first")).cast("long")).drop(
        "_mid", "_pid", "_pos", "_offset", "_first", "_block", *(f"_g{i}" for i in range(len(group_cols)))
    )
    return out, int(m["n"])


def with_dense_index(df: DataFrame, order_cols: list, index_col: str = "idx") -> DataFrame:
    """0..n-1 in ``order_cols`` order (zipWithIndex without an RDD)."""
    return with_group_rank(df, order_cols, (), index_col)

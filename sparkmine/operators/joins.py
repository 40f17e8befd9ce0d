"""The block join that forms all pairs of a table's rows (J1 at k = 2), and J4's
size-checked join (``probe``) for the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.session import probe
from sparkmine.sources.index import with_group_rank_counted

__all__ = ["ordered_pairs", "probe"]

#: Rows of one block of the pair join.
PAIR_BLOCK = 1000


def ordered_pairs(df: DataFrame, col: str, group_cols=(), block: int | None = None) -> DataFrame:
    """(group..., a, b): all pairs a < b of the distinct values of ``col`` per group.

    The values are ranked and cut into blocks; every pair of blocks is a join key of
    its own, so a task forms at most block ** 2 pairs for a key and no side is scanned
    against the whole other one."""
    g = list(group_cols)
    block = block or PAIR_BLOCK
    own = df.select(*g, F.col(col).alias("a")).distinct()
    ranked, _ = with_group_rank_counted(own, ["a"], g, "_at")
    blocked = ranked.withColumn("_block", F.floor(F.col("_at") / block).cast("long"))
    tops = blocked.groupBy(*g).agg(F.max("_block").alias("_top")) if g else None
    top = F.col("_top") if g else blocked.agg(F.max("_block")).scalar()
    left = blocked
    if g:
        names = [f"_g{i}" for i in range(len(g))]
        same = [F.col(c).eqNullSafe(F.col(x)) for c, x in zip(g, names)]
        left = blocked.join(tops.select(*(F.col(c).alias(x) for c, x in zip(g, names)), "_top"), same).drop(*names)
    left = left.select(*g, "a", "_at", F.col("_block").alias("_i"), F.explode(F.sequence(F.col("_block"), top)).alias("_j"))
    right = blocked.select(
        *(F.col(c).alias(f"_r{i}") for i, c in enumerate(g)),
        F.col("a").alias("b"),
        F.col("_at").alias("_bt"),
        F.col("_block").alias("_bj"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_block"))).alias("_bi"),
    )
    on = [F.col("_i") == F.col("_bi"), F.col("_j") == F.col("_bj")] + [F.col(c).eqNullSafe(F.col(f"_r{i}")) for i, c in enumerate(g)]
    return left.join(right, on).where(F.col("_at") < F.col("_bt")).select(*g, "a", "b")

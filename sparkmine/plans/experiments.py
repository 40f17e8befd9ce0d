"""K1 run_sweep and K2 result tables: SON runs over a parameter grid.

Each run is a set of Spark jobs on a transaction table written once; only the
per-run scalars (a few numbers per run) reach the driver, where they become
the two tidy tables ``runs`` and ``run_candidates`` (S4 writes them)."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmine.operators import itemsets as IS
from sparkmine.operators import transform as TR
from sparkmine.session import table_scope

RUNS_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.IntegerType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("avg_len", T.DoubleType()),
        T.StructField("distinct_items", T.LongType()),
        T.StructField("density", T.DoubleType()),
        T.StructField("support", T.DoubleType()),
        T.StructField("num_partitions", T.IntegerType()),
        T.StructField("local_min", T.LongType()),
        T.StructField("n_itemsets", T.LongType()),
        T.StructField("seconds", T.DoubleType()),
    ]
)
RUN_CANDIDATES_SCHEMA = T.StructType(
    [T.StructField("run_id", T.IntegerType()), T.StructField("k", T.IntegerType()), T.StructField("n_candidates", T.LongType())]
)


@dataclass
class SweepRow:
    support: float
    num_partitions: int = 15
    fraction: float | None = None  # F6 before anything else
    pad_target: int | None = None  # F4
    restrict_items: int | None = None  # F3, after F4
    dataset: str = "transactions"


def default_grid(dataset: str = "transactions") -> list[SweepRow]:
    """The five sweeps (37 runs): support; padding; size; distinct items;
    padding followed by keeping 80 items."""
    # The sweep parameters.
    supports = [0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15]
    pad_targets = [25, 30, 35, 40, 45, 50]
    fractions = [0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
    item_counts = [100, 75, 50, 25, 20, 15]
    pad_then_restrict = [20, 25, 30, 35, 40, 45, 50]
    grid = [SweepRow(s, 15, dataset=dataset) for s in supports]
    grid += [SweepRow(0.25, 15, pad_target=t, dataset=f"{dataset}_len_{t}") for t in pad_targets]
    grid += [SweepRow(0.25, 15, fraction=f, dataset=dataset) for f in fractions]
    grid += [SweepRow(0.25, 15, restrict_items=m, dataset=dataset) for m in item_counts]
    grid += [SweepRow(0.25, 15, pad_target=t, restrict_items=80, dataset=dataset) for t in pad_then_restrict]
    return grid


def modified(tx: DataFrame, row: SweepRow, seed: int, dense_ids: bool = False) -> DataFrame:
    data = tx
    if row.fraction is not None:
        data = TR.take_fraction(data, row.fraction, dense_ids=dense_ids)
    if row.pad_target is not None:
        data = TR.pad_transactions(data, row.pad_target, seed)
    if row.restrict_items is not None:
        data = TR.restrict_items(data, row.restrict_items, seed)
    return data


def run_sweep(tx: DataFrame, grid: list[SweepRow], seed: int = 0, dense_ids: bool = False) -> tuple[DataFrame, DataFrame]:
    """K1: one SON run per grid row -> (runs, run_candidates) (K2).

    The base table is written once.  Each modified table is read once, into its
    bucketed rows of equal transactions (``weighted_transactions``), so the profile,
    both SON phases and the counts all see the same rows; runs over the same modified
    table and buckets (a support sweep) share them.  A run's ``seconds`` are those of
    its two phases on these rows.  ``dense_ids``: txn_id is the 0..n-1 source
    position (text sources), so F6 is a filter."""
    spark = tx.sparkSession
    runs, cands = [], []
    shared: dict = {}
    for run_id, row in enumerate(grid):
        key = (row.fraction, row.pad_target, row.restrict_items, row.num_partitions)
        shared.setdefault(key, []).append((run_id, row))
    with table_scope(spark):
        base = IS.prepare_transactions(tx)
        for members in shared.values():
            with table_scope(spark):
                first = members[0][1]
                # A3 sees the bag (F3 output may repeat items), hence its lengths; mining counts sets
                bag = IS.with_bucket(modified(base, first, seed, dense_ids), first.num_partitions)
                equal, n = IS.weighted_transactions(bag, ["bucket"], lengths=True)
                for run_id, row in members:
                    # a run's tables and caches go when its figures are on the driver
                    with table_scope(spark):
                        _run(equal, n, run_id, row, runs, cands)
    return spark.createDataFrame(sorted(runs), RUNS_SCHEMA), spark.createDataFrame(sorted(cands), RUN_CANDIDATES_SCHEMA)


def _run(equal: DataFrame, n: int, run_id: int, row: SweepRow, runs: list, cands: list) -> None:
    """One SON run; appends its rows to ``runs`` and ``cands``."""
    prof = IS.transaction_profile(equal).first()
    t0 = time.perf_counter()
    son = IS.son(equal, row.num_partitions, support=row.support, stats=True, prepared=True, n=n)
    n_itemsets = son.itemsets.count()
    seconds = time.perf_counter() - t0
    runs.append(
        (run_id, row.dataset, int(prof["n"]), float(prof["avg_len"]), int(prof["distinct_items"]), float(prof["density"]),
         float(row.support), int(row.num_partitions), int(son.local_min), int(n_itemsets), float(seconds))
    )
    for r in son.candidate_stats.groupBy("k").agg(F.sum("n_candidates").alias("n")).collect():
        cands.append((run_id, int(r["k"]), int(r["n"])))

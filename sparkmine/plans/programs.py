"""The reference's three programs as single calls on whitespace text files:
Apriori with an FP-Growth cross-check, the SON experiment sweep, and the
mini-batch k-means run with NMI and squared error."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.operators import clustering as CL
from sparkmine.operators import evaluate as EV
from sparkmine.operators import fpm
from sparkmine.operators import itemsets as IS
from sparkmine.plans.experiments import SweepRow, default_grid, run_sweep
from sparkmine.sources import read_points, read_transactions, write_results


@dataclass
class AprioriReport:
    n: int
    avg_len: float
    itemsets: DataFrame  # (k, items, support_count)
    candidate_growth: DataFrame  # (k, n_candidates)
    comparison: DataFrame  # J5 against FP-Growth
    equal: bool
    seconds: float


def apriori_program(spark: SparkSession, path: str, min_count: int, fp_check: bool = True) -> AprioriReport:
    """Read transactions, profile them, mine every frequent itemset (with the
    candidate counts per level) and compare with FP-Growth (sets and counts)."""
    tx, n = IS.prepare_transactions_counted(read_transactions(spark, path))
    avg_len = IS.transaction_profile(tx).first()["avg_len"]
    t0 = time.perf_counter()
    res = IS.mine_frequent(tx, min_count, stats="apriori", prepared=True, n=n)
    res.itemsets.write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - t0
    comparison = IS.compare_itemsets(res.itemsets, fpm.fp_growth(tx, min_count, n) if fp_check else res.itemsets)
    equal = comparison.where((F.col("side") != "both") | (F.col("count_a") != F.col("count_b"))).isEmpty()
    return AprioriReport(n, float(avg_len), res.itemsets, res.candidate_growth, comparison, equal, seconds)


def son_program(
    spark: SparkSession, path: str, grid: list[SweepRow] | None = None, out: str | None = None, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """The experiment sweeps (default: the 37 runs) -> (runs, run_candidates),
    appended to ``out``/runs and ``out``/run_candidates as CSV when given."""
    tx = read_transactions(spark, path)
    # txn_id from a text source is the dense line number
    runs, cands = run_sweep(tx, grid if grid is not None else default_grid(path.rsplit("/", 1)[-1]), seed, dense_ids=True)
    if out:
        write_results(runs, f"{out}/runs")
        write_results(cands, f"{out}/run_candidates")
    return runs, cands


@dataclass
class KMeansReport:
    centers: DataFrame
    assignment: DataFrame
    nmi: float | None
    sse: float
    seconds: float


def kmeans_program(
    spark: SparkSession,
    images_path: str,
    labels_path: str,
    k: int = 50,
    batch_size: int = 5000,
    max_iter: int = 200,
    seed: int = 0,
) -> KMeansReport:
    """Seeding, mini-batch rounds and the final assignment (timed together),
    then NMI against the labels and the squared error."""
    pts = read_points(spark, images_path, labels_path)
    t0 = time.perf_counter()
    centers, assigned = CL.minibatch_kmeans(pts, k, batch_size, max_iter, seed)
    assigned = assigned.persist()
    assigned.count()
    seconds = time.perf_counter() - t0
    nmi = EV.nmi(assigned, "label", "cluster").first()["nmi"]
    sse = assigned.agg(F.sum(F.col("dist") * F.col("dist"))).first()[0]
    return KMeansReport(centers, assigned, nmi, float(sse), seconds)

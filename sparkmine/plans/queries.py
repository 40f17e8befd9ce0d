"""Registered queries: one per operator of the inventory, each (spark, sf_dir)
-> DataFrame over the whole test tables.

Output conventions (shared with ``plans.oracle``): itemsets are flattened to
'a,b,c' strings, doubles are rounded to 6 places (noise to 4), counts are
bigint and k is int.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.functions.columns import itemset_string, min_count_from_support
from sparkmine.operators import clustering as CL
from sparkmine.operators import evaluate as EV
from sparkmine.operators import fpm
from sparkmine.operators import itemsets as IS
from sparkmine.operators import series as SE
from sparkmine.operators import transform as TR
from sparkmine.plans.catalog import (
    BRAND_SUPPORT,
    SEED,
    SON_BUCKETS,
    TYPE_SUPPORT,
    brand_baskets,
    label_means,
    points,
    table,
    type_baskets,
)
from sparkmine.plans.experiments import SweepRow, run_sweep
from sparkmine.sources.index import with_dense_index

# Parameters of the registered queries.
RULE_CONFIDENCE = 0.3
DIFF_SUPPORT = 0.07
RESTRICT_ITEMS = 3
PAD_TARGET = 4
FRACTION = 0.3
PRUNE_SUPPORT = 0.02
SAMPLE_B = 50
MINIBATCH_B = 100
MINIBATCH_ITERS = 2
KMEANSPP_K = 3
NOISE_SIGMA = 0.05
NOISE_LO, NOISE_HI = -1.0, 1.0
HIST_BINS, HIST_LO, HIST_HI = 50, 0.0, 500.0
SMOOTH_SIGMA = 2.0
SWEEP = [(0.01, 4, None), (0.005, 4, None), (0.005, 4, 0.5)]  # (support, buckets, fraction)


def sweep_grid() -> list:
    return [SweepRow(sup, p, fraction=f, dataset="brand") for sup, p, f in SWEEP]


#: (restrict_items, pad_target) of the runs over modified baskets: F3, F4, none.
MODIFIED = [(12, None), (None, 4), (None, None)]
MODIFIED_SUPPORT, MODIFIED_BUCKETS = 0.02, 3


def modified_grid() -> list:
    return [SweepRow(MODIFIED_SUPPORT, MODIFIED_BUCKETS, restrict_items=m, pad_target=t, dataset="brand") for m, t in MODIFIED]


def _r(c, places: int = 6):
    return F.round(F.col(c) if isinstance(c, str) else c, places)


def _itemset_out(df: DataFrame, *lead) -> DataFrame:
    return df.select(*lead, F.col("k").cast("int").alias("k"), itemset_string("items").alias("items"), F.col("support_count").cast("long").alias("support_count"))


def _prepared(tx: DataFrame, support: float, group_cols=()) -> tuple[DataFrame, int, int]:
    """Transactions written once, their count and ceil(support * n)."""
    base, n = IS.prepare_transactions_counted(tx, group_cols)
    return base, n, min_count_from_support(support, n)


# ---------------------------------------------------------------- itemsets


def q_baskets(spark: SparkSession, d: str) -> DataFrame:
    tx = type_baskets(spark, d)
    return tx.select("txn_id", itemset_string("items").alias("items"))


def q_item_support(spark: SparkSession, d: str) -> DataFrame:
    tx, _, mc = _prepared(brand_baskets(spark, d), BRAND_SUPPORT)
    return IS.item_support(tx, mc).select(F.col("item"), F.col("support_count"))


def q_transaction_profile(spark: SparkSession, d: str) -> DataFrame:
    prof = IS.transaction_profile(type_baskets(spark, d))
    return prof.select(F.col("n").cast("long").alias("n"), _r("avg_len").alias("avg_len"), F.col("distinct_items").cast("long").alias("distinct_items"), _r("density").alias("density"))


def q_apriori_type(spark: SparkSession, d: str) -> DataFrame:
    return _itemset_out(IS.apriori(type_baskets(spark, d), support=TYPE_SUPPORT))


def q_apriori_brand(spark: SparkSession, d: str) -> DataFrame:
    return _itemset_out(IS.apriori(brand_baskets(spark, d), support=BRAND_SUPPORT))


def q_candidate_growth(spark: SparkSession, d: str) -> DataFrame:
    return IS.candidate_growth(brand_baskets(spark, d), convention="apriori", support=BRAND_SUPPORT)


def q_prune_candidates(spark: SparkSession, d: str) -> DataFrame:
    """J1 + J2: the 3-candidates joined from the frequent brand pairs and
    pruned by their 2-subsets (the candidates themselves, not just counts)."""
    l2 = IS.apriori(brand_baskets(spark, d), support=BRAND_SUPPORT).where(F.col("k") == 2).select("items")
    cands = IS.prune_candidates(IS.join_candidates(l2, 3), l2, 3)
    return cands.select(itemset_string("items").alias("items"))


def q_son_type(spark: SparkSession, d: str) -> DataFrame:
    run = IS.son(type_baskets(spark, d), SON_BUCKETS, support=TYPE_SUPPORT, stats=False)
    return _itemset_out(run.itemsets)


def q_son_brand(spark: SparkSession, d: str) -> DataFrame:
    run = IS.son(brand_baskets(spark, d), SON_BUCKETS, support=BRAND_SUPPORT, stats=False)
    return _itemset_out(run.itemsets)


def q_son_local(spark: SparkSession, d: str) -> DataFrame:
    run = IS.son(brand_baskets(spark, d), SON_BUCKETS, support=BRAND_SUPPORT, stats=False)
    return _itemset_out(run.local, F.col("bucket").cast("int").alias("bucket"))


def q_son_candidate_stats(spark: SparkSession, d: str) -> DataFrame:
    run = IS.son(brand_baskets(spark, d), SON_BUCKETS, support=BRAND_SUPPORT, stats=True)
    return run.candidate_stats


def q_count_candidates(spark: SparkSession, d: str) -> DataFrame:
    """J3 over the SON phase-1 candidate family (every count, unfiltered)."""
    tx, n, mc = _prepared(IS.with_bucket(brand_baskets(spark, d), SON_BUCKETS), BRAND_SUPPORT, ["bucket"])
    local_min = -(-mc // SON_BUCKETS)
    local = IS.son_local(tx, local_min, prepared=True).itemsets
    counts = IS.count_candidates(tx, local.select("items"))
    return counts.select(itemset_string("items").alias("items"), "support_count")


def q_prune_infrequent(spark: SparkSession, d: str) -> DataFrame:
    tx, _, mc = _prepared(brand_baskets(spark, d), PRUNE_SUPPORT)
    l1 = IS.item_support(tx, mc)
    return IS.prune_infrequent(tx, l1).select("txn_id", itemset_string("items").alias("items"))


def q_fp_growth(spark: SparkSession, d: str) -> DataFrame:
    tx, n, mc = _prepared(brand_baskets(spark, d), BRAND_SUPPORT)
    return _itemset_out(fpm.fp_growth(tx, mc, n))


def q_association_rules(spark: SparkSession, d: str) -> DataFrame:
    tx, n, mc = _prepared(type_baskets(spark, d), TYPE_SUPPORT)
    rules = fpm.association_rules(IS.mine_frequent(tx, mc, prepared=True).itemsets, n, RULE_CONFIDENCE)
    return rules.select(
        itemset_string("antecedent").alias("antecedent"),
        itemset_string("consequent").alias("consequent"),
        "support_count",
        _r("confidence").alias("confidence"),
        _r("lift").alias("lift"),
        _r("support").alias("support"),
    )


def q_itemset_diff(spark: SparkSession, d: str) -> DataFrame:
    tx, n, mc_a = _prepared(type_baskets(spark, d), TYPE_SUPPORT)
    mc_b = min_count_from_support(DIFF_SUPPORT, n)
    a = IS.mine_frequent(tx, mc_a, prepared=True).itemsets
    b = IS.mine_frequent(tx, mc_b, prepared=True).itemsets
    diff = IS.compare_itemsets(a, b)
    return diff.select(itemset_string("items").alias("items"), "side", "count_a", "count_b")


def q_son_sweep(spark: SparkSession, d: str) -> DataFrame:
    """K1/K2: a small SON sweep (support, and size via F6) over brand baskets;
    the wall-clock column is left out of the registered output."""
    runs, _ = run_sweep(brand_baskets(spark, d), sweep_grid(), SEED)
    return runs.select(
        "run_id", "dataset", "n", _r("avg_len").alias("avg_len"), "distinct_items", _r("density").alias("density"),
        "support", "num_partitions", "local_min", "n_itemsets",
    )


def q_sweep_modified(spark: SparkSession, d: str) -> DataFrame:
    """K1 and K2 (run_candidates) of a sweep over the baskets restricted (F3), padded
    (F4) and as they are: profile and itemsets of each run with the candidates of
    each level, summed over the buckets."""
    runs, cands = run_sweep(brand_baskets(spark, d), modified_grid(), SEED)
    runs = runs.select("run_id", "n", _r("avg_len").alias("avg_len"), "distinct_items", "local_min", "n_itemsets")
    return cands.join(runs, "run_id")


def q_son_hash(spark: SparkSession, d: str) -> DataFrame:
    """A6 with buckets by a seeded hash of the transaction."""
    run = IS.son(brand_baskets(spark, d), SON_BUCKETS, support=BRAND_SUPPORT, bucket="hash", seed=SEED, stats=False)
    return _itemset_out(run.local, F.col("bucket").cast("int").alias("bucket"))


def q_count_open_family(spark: SparkSession, d: str) -> DataFrame:
    """J3 over a family that is not downward closed: every distinct basket of two to
    four brands, counted in all baskets."""
    tx = IS.prepare_transactions(brand_baskets(spark, d))
    counts = IS.count_candidates(tx, tx.select("items").where(F.size("items").between(2, 4)))
    return counts.select(itemset_string("items").alias("items"), "support_count")


# ---------------------------------------------------------------- modifiers


def q_restrict_items(spark: SparkSession, d: str) -> DataFrame:
    # two passes (item counts, then the rewrite): read baskets written once
    out = TR.restrict_items(IS.prepare_transactions(type_baskets(spark, d)), RESTRICT_ITEMS, SEED)
    return out.select("txn_id", itemset_string("items").alias("items"))


def q_pad_transactions(spark: SparkSession, d: str) -> DataFrame:
    out = TR.pad_transactions(IS.prepare_transactions(type_baskets(spark, d)), PAD_TARGET, SEED)
    return out.select("txn_id", itemset_string("items").alias("items"))


def q_take_fraction(spark: SparkSession, d: str) -> DataFrame:
    out = TR.take_fraction(brand_baskets(spark, d), FRACTION)
    return out.select("txn_id", itemset_string("items").alias("items"))


def q_dense_index(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return with_dense_index(orders, ["o_orderdate", "o_orderkey"], "idx").select("o_orderkey", "idx")


def q_expand_by_weight(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return TR.expand_by_weight(li, "l_quantity").select("l_orderkey", "l_linenumber")


def q_explode_matrix(spark: SparkSession, d: str) -> DataFrame:
    out = TR.explode_matrix(points(spark, d), "embedding", ["vec_id"])
    return out.select("vec_id", F.col("pos").cast("int").alias("pos"), _r(F.col("value").cast("double")).alias("value"))


def q_augment_points(spark: SparkSession, d: str) -> DataFrame:
    pts = points(spark, d)
    m = pts.count()  # as many copies as points: the work grows with the table
    out = TR.augment_points(pts, m, NOISE_SIGMA, NOISE_LO, NOISE_HI, SEED, "vec_id", "embedding")
    return out.select(
        "vec_id", "source_id", "label", F.posexplode("embedding").alias("pos", "value")
    ).select("vec_id", "source_id", "label", F.col("pos").cast("int").alias("pos"), _r("value", 4).alias("value"))


# ---------------------------------------------------------------- clustering


def q_assign_nearest(spark: SparkSession, d: str) -> DataFrame:
    pts = points(spark, d)
    out = CL.assign_nearest(pts, label_means(pts), "embedding")
    return out.select("vec_id", F.col("cluster").cast("int").alias("cluster"), _r("dist").alias("dist"))


def q_sse(spark: SparkSession, d: str) -> DataFrame:
    pts = points(spark, d)
    return CL.sse(pts, label_means(pts), "embedding").select(_r("sse").alias("sse"))


def q_update_centers(spark: SparkSession, d: str) -> DataFrame:
    pts = points(spark, d)
    centers = label_means(pts)
    assigned = CL.assign_nearest(pts, centers, "embedding")
    new = CL.update_centers(assigned, centers, "embedding")
    return new.select("cluster", "n", F.posexplode("center").alias("pos", "value")).select(
        "cluster", "n", F.col("pos").cast("int").alias("pos"), _r("value").alias("value")
    )


def q_sample_exact(spark: SparkSession, d: str) -> DataFrame:
    return CL.sample_exact(points(spark, d), SAMPLE_B, SEED, 0, "vec_id").select("vec_id", "label")


def q_kmeanspp_pick(spark: SparkSession, d: str) -> DataFrame:
    _, ids = CL.kmeanspp(points(spark, d), KMEANSPP_K, SEED, id_col="vec_id", features_col="embedding")
    return spark.createDataFrame([(i, int(v)) for i, v in enumerate(ids)], "step int, vec_id long")


def q_minibatch_2(spark: SparkSession, d: str) -> DataFrame:
    pts = points(spark, d)
    centers, assigned = CL.minibatch_kmeans(
        pts, 10, MINIBATCH_B, MINIBATCH_ITERS, SEED, init=label_means(pts), id_col="vec_id", features_col="embedding"
    )
    return assigned.select("vec_id", F.col("cluster").cast("int").alias("cluster"))


# ---------------------------------------------------------------- evaluation


def q_contingency(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    return EV.contingency(orders, "o_orderpriority", "o_orderstatus")


def q_entropy(spark: SparkSession, d: str) -> DataFrame:
    return EV.entropy(table(spark, d, "orders"), "o_orderpriority").select(_r("entropy").alias("entropy"))


def q_nmi(spark: SparkSession, d: str) -> DataFrame:
    pts = points(spark, d)
    assigned = CL.assign_nearest(pts, label_means(pts), "embedding")
    out = EV.nmi(assigned, "label", "cluster")
    return out.select(*[_r(c).alias(c) for c in ("mi", "h_label", "h_cluster", "nmi")])


def q_frequency_table(spark: SparkSession, d: str) -> DataFrame:
    out = EV.frequency_table(table(spark, d, "events"), "event_type")
    return out.select("value", "n", _r("share").alias("share"))


# ---------------------------------------------------------------- series


def q_histogram_density(spark: SparkSession, d: str) -> DataFrame:
    out = SE.histogram_density(table(spark, d, "events"), "value", HIST_BINS, HIST_LO, HIST_HI)
    return out.select("bin", _r("center").alias("center"), "n", _r("density").alias("density"))


def q_gaussian_smooth(spark: SparkSession, d: str) -> DataFrame:
    hist = SE.histogram_density(table(spark, d, "events"), "value", HIST_BINS, HIST_LO, HIST_HI)
    out = SE.gaussian_smooth(hist, "bin", "density", SMOOTH_SIGMA)
    return out.select(F.col("bin").cast("int").alias("bin"), _r("density").alias("density"))


def q_ordinal_gap(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    return SE.ordinal_gap(events, "user_id", "value", "mid", tiebreak="event_id").select(
        "user_id", "n", _r("gap").alias("gap")
    )


QUERIES = {
    "baskets": q_baskets,
    "item_support": q_item_support,
    "transaction_profile": q_transaction_profile,
    "apriori_type": q_apriori_type,
    "apriori_brand": q_apriori_brand,
    "candidate_growth": q_candidate_growth,
    "prune_candidates": q_prune_candidates,
    "son_type": q_son_type,
    "son_brand": q_son_brand,
    "son_local": q_son_local,
    "son_candidate_stats": q_son_candidate_stats,
    "son_sweep": q_son_sweep,
    "sweep_modified": q_sweep_modified,
    "son_hash": q_son_hash,
    "count_open_family": q_count_open_family,
    "count_candidates": q_count_candidates,
    "prune_infrequent": q_prune_infrequent,
    "fp_growth": q_fp_growth,
    "association_rules": q_association_rules,
    "itemset_diff": q_itemset_diff,
    "restrict_items": q_restrict_items,
    "pad_transactions": q_pad_transactions,
    "take_fraction": q_take_fraction,
    "dense_index": q_dense_index,
    "expand_by_weight": q_expand_by_weight,
    "explode_matrix": q_explode_matrix,
    "augment_points": q_augment_points,
    "assign_nearest": q_assign_nearest,
    "sse": q_sse,
    "update_centers": q_update_centers,
    "sample_exact": q_sample_exact,
    "kmeanspp_pick": q_kmeanspp_pick,
    "minibatch_2": q_minibatch_2,
    "contingency": q_contingency,
    "entropy": q_entropy,
    "nmi": q_nmi,
    "frequency_table": q_frequency_table,
    "histogram_density": q_histogram_density,
    "gaussian_smooth": q_gaussian_smooth,
    "ordinal_gap": q_ordinal_gap,
}

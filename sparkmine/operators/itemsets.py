"""Frequent itemsets on Spark DataFrames.

Operators: F1 explode_items, F2 prune_infrequent, F7 min_support_filter,
A1 item_support, A2 itemset_support, A3 transaction_profile, A4 apriori,
A5 son, A6 son_local, A7 son_verify, A8 candidate_growth, J1 join_candidates,
J2 prune_candidates, J3 count_candidates, J5 compare_itemsets.

Input transactions are ``(txn_id, items)`` with ``items`` a sorted, duplicate
free array (S1/S3 produce that; the miners normalise anyway).  Itemsets are
sorted arrays, so they can be grouped and joined on directly.

How a level is counted (A4/A6/A7).  The frequent itemsets form a prefix tree, one
written table per level: (node, parent, code, path, support_count), where a code
is the level-1 node of an item (unique per group) and a path the codes of a set.
A transaction is an array of codes, made once by an equi-join of its items with
level 1 on (group, item).  For every transaction and frequent (k-1)-set in it
there is an occurrence row (node, tail): the codes after the set's last item.
Level k explodes the tails to (node, y), keeps the pairs that are candidates (J1
and J2 on the tree, so nothing is aggregated that a pruned candidate would count),
aggregates and writes the level; the next occurrence rows are one lookup of
(node, y) in that level.  Every lookup is a hash probe of one key, so the cost of a
row does not depend on the number of frequent items.  Tables are broadcast when the
bytes measured at their writing fit, else both sides are shuffled by the whole key
and hot keys, known from the supports, are broadcast (``joins.probe``).
Occurrence tables are cached, with a written table every CUT_EVERY levels.

Equal transactions are one row with a ``_weight`` (``weighted_transactions``), made by
one shuffle before the levels, and a level sums weights: its work grows with the
different transactions of a group, which are at most the transactions.  Rows without a
``_weight`` count once.
"""

from __future__ import annotations

import logging
import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmine.functions.columns import drop_one_subsets, min_count_from_support, seeded_uniform
from sparkmine.operators.joins import ordered_pairs, probe
from sparkmine.session import cut_lineage, cut_lineage_observed, persist_observed, row_bytes

log = logging.getLogger(__name__)

# Occurrence tables are cached; every CUT_EVERY-th level is written instead,
# so a lost executor replays at most that many map-side steps from a table.
CUT_EVERY = 4
# Bytes of a row of a level table in a hash table: its values and the row itself.
_LONG_BYTES = 8
_ROW_OVERHEAD = 40


def _norm_items(col="items"):
    return F.sort_array(F.array_distinct(F.col(col)))


def _count(weight=()):
    """Rows, or the sum of their ``weight`` column if one is named."""
    return (F.sum(*weight) if weight else F.count(F.lit(1))).alias("support_count")


# ---------------------------------------------------------------------------
# F1, F7, A1, A2, A3
# ---------------------------------------------------------------------------


def explode_items(tx: DataFrame, txn_col: str = "txn_id", items_col: str = "items") -> DataFrame:
    """(txn_id, item). Empty transactions vanish here: take n from ``tx``."""
    return tx.select(txn_col, F.explode(items_col).alias("item"))


def min_support_filter(counts: DataFrame, min_count, count_col: str = "support_count") -> DataFrame:
    """keep rows with ``count >= min_count``."""
    return counts.where(F.col(count_col) >= F.lit(min_count))


def item_support(tx: DataFrame, min_count: int = 1, group_cols=()) -> DataFrame:
    """A1 (+F7): (group..., item, support_count), counted once per transaction."""
    g = list(group_cols)
    counts = (
        tx.select(*g, F.explode(F.array_distinct("items")).alias("item"))
        .groupBy(*g, "item")
        .agg(_count())
    )
    return min_support_filter(counts, min_count)


def itemset_support(occ: DataFrame, min_count: int = 1, group_cols=()) -> DataFrame:
    """A2: occurrence rows (one per transaction and itemset) -> counts >= min."""
    g = list(group_cols)
    return min_support_filter(occ.groupBy(*g, "items").agg(_count()), min_count)


def transaction_profile(tx: DataFrame) -> DataFrame:
    """A3: one row (n, avg_len, distinct_items, density).

    density = avg_len / distinct_items, 0 when there are no items; empty input
    gives n = 0 and avg_len = 0.  Lengths are those of ``items`` as given (a
    bag from F3 counts its copies).  A row of ``weighted_transactions`` stands for
    ``_weight`` transactions, of ``_len`` items each if it has that column."""
    distinct_items = tx.select(F.explode("items").alias("item")).agg(F.count_distinct("item")).scalar()
    length = F.col("_len") if "_len" in tx.columns else F.size("items")
    if "_weight" in tx.columns:
        n = F.coalesce(F.sum("_weight"), F.lit(0))
        avg_len = F.sum(length * F.col("_weight")) / F.sum(F.when(length.isNotNull(), F.col("_weight")))
    else:
        n, avg_len = F.count(F.lit(1)), F.avg(length.cast("double"))
    prof = tx.agg(n.alias("n"), F.coalesce(avg_len, F.lit(0.0)).alias("avg_len"))
    return prof.select(
        "n",
        "avg_len",
        distinct_items.alias("distinct_items"),
        F.when(distinct_items > 0, F.col("avg_len") / distinct_items).otherwise(F.lit(0.0)).alias("density"),
    )


# ---------------------------------------------------------------------------
# keep only frequent single items
# ---------------------------------------------------------------------------


def prune_infrequent(tx: DataFrame, l1: DataFrame, group_cols=(), drop_empty: bool = True) -> DataFrame:
    """restrict each transaction to frequent single items ``l1`` (group..., item).

    One equi-join of the items with ``l1`` and a regroup by row id, so repeated
    txn_ids stay apart and every column stays."""
    g = list(group_cols)
    own = [c for c in ("support_count",) if c in l1.columns]
    keep, m = cut_lineage_observed(
        l1.select(*g, "item", *own), bytes=F.sum(row_bytes([*g, "item"], l1.schema)), total=F.sum("support_count") if own else F.lit(0)
    )
    rows = cut_lineage(tx.withColumn("_rid", F.monotonically_increasing_id()))
    long = rows.select("_rid", *g, F.explode(_norm_items()).alias("item"))
    found = probe(long, keep, [*g, "item"], int(m["bytes"]), int(m["total"]), "left_semi")
    kept = found.groupBy("_rid").agg(F.sort_array(F.collect_list("item")).alias("_keep"))
    out = (
        rows.join(kept, "_rid", "left")
        .withColumn("items", F.coalesce("_keep", F.array().cast(tx.schema["items"].dataType)))
        .select(*tx.columns)
    )
    if drop_empty:
        out = out.where(F.size("items") > 0)
    return out


# ---------------------------------------------------------------------------
# Candidate generation (used for the candidate statistics, A8)
# ---------------------------------------------------------------------------


def join_candidates(l_prev: DataFrame, k: int, group_cols=()) -> DataFrame:
    """K-candidates from two (k-1)-itemsets sharing their first k-2 items.

    For k >= 3 an equi-join on (group, prefix) with a.last < b.last.  A prefix
    group holds at most |L1| itemsets (frequent single items), a bound set by
    the threshold, not by the data volume.  For k = 2 the prefix is empty and
    the candidates are all pairs of frequent items, formed block by block; the
    miner never builds them (their number is C(|L1|, 2))."""
    g = list(group_cols)
    if k == 2:
        singles = l_prev.select(*g, F.element_at("items", 1).alias("x"))
        return ordered_pairs(singles, "x", g).select(*g, F.array("a", "b").alias("items"))
    a = l_prev.select(*g, F.slice("items", 1, k - 2).alias("prefix"), F.element_at("items", -1).alias("a_last"))
    b = l_prev.select(*g, F.slice("items", 1, k - 2).alias("prefix"), F.element_at("items", -1).alias("b_last"))
    return (
        a.join(b, [*g, "prefix"])
        .where(F.col("a_last") < F.col("b_last"))
        .select(*g, F.concat("prefix", F.array("a_last", "b_last")).alias("items"))
    )


def prune_candidates(cands: DataFrame, l_prev: DataFrame, k: int, group_cols=()) -> DataFrame:
    """Keep a candidate only if all its (k-1)-subsets are in ``l_prev``.

    The two subsets that drop one of the last two items are the joined parents,
    so only the k-2 others are checked: explode them, anti-join with L(k-1) to
    find bad candidates, anti-join those away."""
    g = list(group_cols)
    if k <= 2:
        return cands
    subs = cands.select(*g, "items", F.explode(F.slice(drop_one_subsets("items", k), 1, k - 2)).alias("sub"))
    bad = subs.join(l_prev.select(*g, F.col("items").alias("sub")), [*g, "sub"], "left_anti").select(*g, "items")
    return cands.join(bad, [*g, "items"], "left_anti")


# ---------------------------------------------------------------------------
# The level loop
# ---------------------------------------------------------------------------


@dataclass
class MiningResult:
    itemsets: DataFrame  # (group..., k, items, support_count)
    candidate_growth: DataFrame | None  # (group..., k, n_candidates)
    item_counts: DataFrame | None = None  # (group..., item, support_count), every item


@dataclass
class _Level:
    """One level of the prefix tree: (node, parent, code, path, support_count).

    ``code`` is the level-1 node of the set's last item, ``path`` those of all its
    items; ``parent`` is the node of the set without its last item."""

    rows: DataFrame
    n: int
    total: int  # sum of the supports

    def children(self) -> DataFrame:
        return self.rows.select(F.col("parent").alias("_parent"), F.col("code").alias("_code"), F.col("node").alias("_child"), "support_count")


def _candidates(prev: _Level, k: int) -> DataFrame:
    """J1 and J2 on the tree: (node, y, items = path) of every k-set (k >= 3) whose
    (k-1)-subsets are all in the level before."""
    a = prev.rows.select("parent", "node", F.col("path").alias("p"), F.col("code").alias("c"))
    b = prev.rows.select("parent", F.col("code").alias("y"))
    joined = a.join(b, "parent").where(F.col("c") < F.col("y")).select("node", "y", F.concat("p", F.array("y")).alias("items"))
    return prune_candidates(joined, prev.rows.select(F.col("path").alias("items")), k)


def prepare_transactions(tx: DataFrame, group_cols=()) -> DataFrame:
    """Normalised (txn_id, group..., items sorted distinct, _rid), written once to the
    checkpoint folder so every pass of a miner reads the same rows without
    recomputing the upstream joins; ``_rid`` tells rows that share a txn_id apart."""
    return prepare_transactions_counted(tx, group_cols)[0]


def prepare_transactions_counted(tx: DataFrame, group_cols=()) -> tuple[DataFrame, int]:
    """``prepare_transactions`` plus the number of transactions (observed
    during the write, no extra job)."""
    g = list(group_cols)
    rid = F.monotonically_increasing_id().alias("_rid")
    ids = F.col("txn_id") if "txn_id" in tx.columns else F.monotonically_increasing_id().alias("txn_id")
    out, m = cut_lineage_observed(tx.select(ids, *g, _norm_items().alias("items"), rid), n=F.count(F.lit(1)))
    return out, int(m["n"])


def weighted_transactions(tx: DataFrame, group_cols=(), lengths: bool = False) -> tuple[DataFrame, int]:
    """(group..., items sorted distinct, _weight, _rid), one row for all equal
    transactions of a group and ``_weight`` their number, written once; and the number
    of transactions.  Many equal ones are added up per task before the shuffle.
    ``lengths`` adds ``_len``, the number of items as given (a bag repeats items), and
    only transactions that agree in it are equal: then A3 needs no other table."""
    g = list(group_cols)
    own = ["_len"] if lengths else []
    rows = tx.select(*g, _norm_items().alias("items"), *(F.size("items").alias(c) for c in own))
    equal = rows.groupBy(*g, "items", *own).agg(F.count(F.lit(1)).alias("_weight"))
    out, m = cut_lineage_observed(equal.withColumn("_rid", F.monotonically_increasing_id()), n=F.sum("_weight"))
    return out, int(m["n"])


def resolve_threshold(n: int, min_count: int | None, support: float | None) -> int:
    """Absolute threshold; from ``support`` it is ceil(support * n), at least 1
    (a count >= 0 and a count >= 1 keep the same, occurring, itemsets)."""
    if min_count is None:
        if support is None:
            raise ValueError("give min_count or support")
        min_count = max(1, min_count_from_support(support, n))
    if min_count < 1:
        raise ValueError("min_count must be >= 1")
    return int(min_count)


def _per_group(df: DataFrame, g: list) -> dict:
    return {tuple(r[c] for c in g): r["n"] for r in df.groupBy(*g).agg(F.count(F.lit(1)).alias("n")).collect()}


def mine_frequent(
    tx: DataFrame,
    min_count: int | None = None,
    group_cols=(),
    allowed: DataFrame | None = None,
    stats: str | None = None,
    support: float | None = None,
    prepared: bool = False,
    n: int | None = None,
    item_counts: DataFrame | None = None,
) -> MiningResult:
    """Level-wise frequent itemsets of ``tx`` (txn_id, group..., items) with
    count >= min_count (or >= ceil(support * n)).

    ``group_cols`` mines every group separately in the same jobs (SON buckets).
    ``allowed`` (items) restricts every level to a downward-closed candidate
    family (SON phase 2).  ``stats`` = 'apriori' or 'son' also returns the
    candidates per level (A8) under that convention.  ``prepared`` says ``tx``
    already comes from ``prepare_transactions`` or ``weighted_transactions`` (``n`` the
    number of transactions, if known).
    ``item_counts`` (group..., item, support_count) over every item, when
    already known, replaces the level-1 pass over the transactions."""
    g = list(group_cols)
    if prepared:
        base = tx
    else:
        base, n = prepare_transactions_counted(tx, g)
    w = [c for c in ("_weight",) if c in base.columns]
    if min_count is None and n is None:
        n = base.agg(F.coalesce(_count(w), F.lit(0))).first()[0]
    min_count = resolve_threshold(n if n is not None else 0, min_count, support)
    if item_counts is None:
        item_counts = base.select(*g, *w, F.explode("items").alias("item")).groupBy(*g, "item").agg(_count(w))
    # node ids are written with the level, so every later pass sees the same ones
    counts1, m1 = cut_lineage_observed(
        item_counts.select(*g, "item", "support_count", F.monotonically_increasing_id().alias("node")),
        n_l1=F.count_if(F.col("support_count") >= min_count),
        bytes=F.sum(F.when(F.col("support_count") >= min_count, row_bytes([*g, "item", "node"], item_counts.schema))),
        total=F.sum(F.when(F.col("support_count") >= min_count, F.col("support_count"))),
    )
    l1 = counts1.where(F.col("support_count") >= min_count)
    if allowed is not None:
        l1 = l1.join(allowed.where(F.size("items") == 1).select(F.element_at("items", 1).alias("item")), "item", "left_semi")
        l1, m1 = cut_lineage_observed(l1, n_l1=F.count(F.lit(1)), bytes=F.sum(row_bytes([*g, "item", "node"], l1.schema)), total=F.sum("support_count"))
        allowed = _allowed_paths(allowed, l1)
    n_prev = int(m1["n_l1"])

    growth: list[tuple] = []
    alive: dict = {}
    if stats:
        alive = _per_group(l1, g) if g else {(): n_prev}
        first = (_per_group(counts1, g) if g else {(): counts1.count()}) if stats == "son" else {k: c for k, c in alive.items() if c or not g}
        growth += [key + (1, c) for key, c in first.items()]

    # transactions as arrays of frequent level-1 nodes: an equi-join on (group, item), then one regroup by row
    long = base.select("_rid", *w, *g, F.explode("items").alias("item"))
    seen = probe(long, l1.select(*g, "item", "node", "support_count"), [*g, "item"], int(m1["bytes"]), int(m1["total"]))
    rows = seen.groupBy("_rid", *w).agg(F.sort_array(F.collect_list("node")).alias("r")).where(F.size("r") > 1).select("r", *w)
    held, mo = persist_observed(rows, n=F.count(F.lit(1)))
    occ = held.select(F.posexplode("r").alias("pos", "node"), "r", *w).select("node", *w, F.slice("r", F.col("pos") + 2, F.size("r")).alias("tail")).where(F.size("tail") > 0)
    tree: list[_Level] = []
    k, alive_rows = 2, mo["n"]
    while n_prev > 0:
        cands, n_cands = None, None
        if k > 2 and allowed is None:
            cands, n_cands = cut_lineage_observed(_candidates(tree[-1], k), n=F.count(F.lit(1)))
            n_cands = int(n_cands["n"])
        elif allowed is not None:
            cands, n_cands = _allowed_children(allowed, tree[-1] if tree else None, k)
        if stats:
            per = {key: c * (c - 1) // 2 for key, c in alive.items()} if k == 2 else _grouped(cands.select(F.element_at("items", 1).alias("top")), l1, g, n_cands)
            growth += [key + (k, per.get(key, 0)) for key in alive]
            if sum(per.values()) == 0:
                break
        if n_cands == 0 or not alive_rows:
            break
        pairs = occ.select("node", *w, F.explode("tail").alias("y"))
        if cands is not None:
            # J2 before counting: only candidates are aggregated
            pairs = probe(pairs, cands.select("node", "y"), ["node", "y"], n_cands * (2 * _LONG_BYTES + _ROW_OVERHEAD), how="left_semi")
        counted = pairs.groupBy("node", "y").agg(_count(w)).where(F.col("support_count") >= min_count)
        if k == 2:
            paths = counted.select("node", "y", F.array("node", "y").alias("path"), "support_count")
        else:
            paths = counted.join(cands.select("node", "y", F.col("items").alias("path")), ["node", "y"])
        level = paths.select(F.monotonically_increasing_id().alias("node"), F.col("node").alias("parent"), F.col("y").alias("code"), "path", "support_count")
        level, ml = cut_lineage_observed(level, n=F.count(F.lit(1)), total=F.sum("support_count"))
        n_prev = int(ml["n"])
        if n_prev == 0:
            break
        tree.append(_Level(level, n_prev, int(ml["total"])))
        if stats:
            alive = _grouped(level.select(F.element_at("path", 1).alias("top")), l1, g, n_prev)
        # occurrence rows of the level: one probe per item of a tail, whatever the number of frequent items
        at = occ.select("node", *w, "tail", F.posexplode("tail").alias("pos", "y")).where(F.col("pos") + 1 < F.size("tail"))
        at = at.withColumnsRenamed({"node": "_parent", "y": "_code"})
        met = probe(at, tree[-1].children(), ["_parent", "_code"], n_prev * (3 * _LONG_BYTES + _ROW_OVERHEAD), tree[-1].total)
        nxt = met.select(F.col("_child").alias("node"), *w, F.slice("tail", F.col("pos") + 2, F.size("tail")).alias("tail"))
        keep = cut_lineage_observed if k % CUT_EVERY == 0 else persist_observed
        occ, mo = keep(nxt, n=F.count(F.lit(1)))
        alive_rows = mo["n"]
        if held is not None and held.is_cached:
            held.unpersist()
        held = occ
        k += 1
    if held is not None and held.is_cached:
        held.unpersist()

    levels = [l1.select(*g, F.lit(1).alias("k"), F.array("item").alias("items"), "support_count")]
    if tree:
        levels.append(_decoded(tree, l1, g))
    growth_df = None
    if stats:
        schema = T.StructType(
            [base.schema[c] for c in g] + [T.StructField("k", T.IntegerType()), T.StructField("n_candidates", T.LongType())]
        )
        growth_df = base.sparkSession.createDataFrame(growth, schema)
    return MiningResult(reduce(DataFrame.unionByName, levels), growth_df, counts1.drop("node"))


def _grouped(tops: DataFrame, l1: DataFrame, g: list, n: int) -> dict:
    """Rows per group, by the group of the first item's node."""
    if not g:
        return {(): n}
    return _per_group(tops.join(l1.select(*g, F.col("node").alias("top")), "top"), g)


def _decoded(tree: list[_Level], l1: DataFrame, g: list) -> DataFrame:
    """(group..., k, items, support_count) of the levels from 2 on."""
    all_levels = reduce(DataFrame.unionByName, (lv.rows.select(F.lit(i + 2).alias("k"), "node", "path", "support_count") for i, lv in enumerate(tree)))
    long = all_levels.select("k", "node", "support_count", F.explode("path").alias("code"))
    named = long.join(l1.select(*g, "item", F.col("node").alias("code")), "code")
    return (
        named.groupBy(*g, "k", "node", "support_count")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
        .select(*g, "k", "items", "support_count")
    )


def _allowed_paths(allowed: DataFrame, l1: DataFrame) -> DataFrame:
    """The allowed sets of two and more items as paths of level-1 nodes; sets with an
    item that is not frequent vanish."""
    many = allowed.where(F.size("items") > 1).select("items", F.explode("items").alias("item"))
    coded = many.join(l1.select("item", "node"), "item").groupBy("items").agg(F.sort_array(F.collect_list("node")).alias("path"))
    return cut_lineage(coded.where(F.size("path") == F.size("items")).select("path", F.size("path").alias("k")))


def _allowed_children(allowed: DataFrame, prev: _Level | None, k: int) -> tuple[DataFrame, int]:
    """(node, y, items = path) of the allowed k-sets whose prefix is in the level before."""
    own = allowed.where(F.col("k") == k).select("path", F.element_at("path", -1).alias("y"), F.slice("path", 1, k - 1).alias("prefix"))
    if prev is None:
        found = own.select(F.element_at("prefix", 1).alias("node"), "y", F.col("path").alias("items"))
    else:
        found = own.join(prev.rows.select("node", F.col("path").alias("prefix")), "prefix").select("node", "y", F.col("path").alias("items"))
    out, m = cut_lineage_observed(found, n=F.count(F.lit(1)))
    return out, int(m["n"])


def apriori(tx: DataFrame, min_count: int | None = None, support: float | None = None) -> DataFrame:
    """A4: every frequent itemset with its count: (k, items, support_count).
    Threshold: ``min_count`` or ceil(``support`` * n)."""
    base, n = weighted_transactions(tx)
    return mine_frequent(base, min_count, support=support, prepared=True, n=n).itemsets


def candidate_growth(
    tx: DataFrame, min_count: int | None = None, convention: str = "apriori", group_cols=(), support: float | None = None
) -> DataFrame:
    """Candidates per level, (group..., k, n_candidates).

    'apriori': k=1 counts the frequent items, k>=2 the joined and pruned
    candidates, with a last row for the level that came out empty.
    'son': k=1 counts the distinct items seen (per group)."""
    base, n = weighted_transactions(tx, group_cols)
    return mine_frequent(base, min_count, group_cols, stats=convention, support=support, prepared=True, n=n).candidate_growth


# ---------------------------------------------------------------------------
# SON (A5-A7)
# ---------------------------------------------------------------------------


def with_bucket(tx: DataFrame, num_partitions: int, how: str = "mod", seed: int = 0) -> DataFrame:
    """Deterministic bucket column: pmod(txn_id, p) or floor(u(seed, txn_id) * p)."""
    if how == "mod":
        b = F.pmod(F.col("txn_id"), F.lit(num_partitions))
    elif how == "hash":
        b = F.floor(seeded_uniform(seed, F.col("txn_id")) * num_partitions)
    else:
        raise ValueError(how)
    return tx.withColumn("bucket", b.cast("int"))


def son_local(
    tx: DataFrame, local_min: int, bucket_col: str = "bucket", stats: bool = False, prepared: bool = False
) -> MiningResult:
    """Locally frequent itemsets of every bucket, (bucket, k, items, support_count).

    One grouped level loop for all buckets: no per-partition lists in memory,
    the buckets are keys and the work spreads over every task."""
    if local_min <= 1:
        log.warning("local threshold is 1: every subset of every transaction is a candidate; use fewer buckets")
    return mine_frequent(tx, local_min, [bucket_col], stats="son" if stats else None, prepared=prepared)


def son_verify(
    tx: DataFrame, candidates: DataFrame, min_count: int, prepared: bool = False, item_counts: DataFrame | None = None
) -> DataFrame:
    """Global count of a downward-closed candidate family, kept if >= min_count.

    (The union of per-bucket frequent families is downward closed.)"""
    cands = cut_lineage(candidates.select("items").distinct())
    return mine_frequent(tx, min_count, allowed=cands, prepared=prepared, item_counts=item_counts).itemsets


@dataclass
class SonRun:
    itemsets: DataFrame  # (k, items, support_count)
    local: DataFrame  # (bucket, k, items, support_count)
    candidate_stats: DataFrame | None  # (bucket, k, n_candidates)
    n: int
    min_count: int
    local_min: int


def son(
    tx: DataFrame,
    num_partitions: int,
    support: float | None = None,
    min_count: int | None = None,
    bucket: str = "mod",
    seed: int = 0,
    stats: bool = True,
    prepared: bool = False,
    n: int | None = None,
) -> SonRun:
    """A5: two-phase partitioned mining; the result equals ``apriori``.

    min_count = ceil(support * n), local_min = ceil(min_count / p): every
    globally frequent set is locally frequent in at least one bucket.  ``prepared`` says
    ``tx`` comes from ``weighted_transactions`` by the ``bucket`` of ``with_bucket`` and
    ``n`` is its number of transactions, so runs at several thresholds share that table."""
    if prepared:
        base = tx
        if n is None:
            n = base.agg(F.coalesce(F.sum("_weight"), F.lit(0))).first()[0]
    else:
        base, n = weighted_transactions(with_bucket(tx, num_partitions, bucket, seed), ["bucket"])
    min_count = resolve_threshold(n, min_count, support)
    local_min = int(math.ceil(min_count / num_partitions))
    local = son_local(base, local_min, stats=stats, prepared=True)
    # global item counts = per-bucket item counts summed (no second pass)
    global_items = local.item_counts.groupBy("item").agg(F.sum("support_count").cast("long").alias("support_count"))
    verified = son_verify(base.drop("bucket"), local.itemsets, min_count, prepared=True, item_counts=global_items)
    return SonRun(verified, local.itemsets, local.candidate_growth, n, min_count, local_min)


# ---------------------------------------------------------------------------
# Support of an arbitrary candidate set
# ---------------------------------------------------------------------------


def _candidate_tree(cands: DataFrame) -> DataFrame:
    """The prefix tree of any set of itemsets, as a written table (j, parent, item,
    node, items): one row per distinct prefix ``items`` of j items."""
    prefixes = (
        cands.select(F.explode(F.sequence(F.lit(1), F.size("items"))).alias("j"), "items")
        .select(F.col("j").cast("int").alias("j"), F.slice("items", 1, F.col("j")).alias("items"))
        .distinct()
    )
    nodes = cut_lineage(prefixes.withColumn("node", F.monotonically_increasing_id()))
    above = nodes.select(F.col("items").alias("_prefix"), F.col("node").alias("parent"))
    own = nodes.select("j", "items", "node", F.element_at("items", -1).alias("item"), F.slice("items", 1, F.col("j") - 1).alias("_prefix"))
    return cut_lineage(own.join(above, "_prefix", "left").select("j", "parent", "item", "node", "items"))


def count_candidates(tx: DataFrame, candidates: DataFrame) -> DataFrame:
    """(items, support_count) for every candidate itemset, 0 if absent.  The
    family need not be downward closed.

    Walks the prefix tree of the candidates level by level: an occurrence row
    (node, tail) goes on with every item of its tail that is a child of the node.
    Work is the number of items met after (transaction, candidate prefix)
    containments, one lookup of (node, item) each."""
    cands = cut_lineage(candidates.select(_norm_items().alias("items")).where(F.size("items") > 0).distinct())
    tree = _candidate_tree(cands)
    sizes = tree.groupBy("j").agg(F.sum(row_bytes(["parent", "item", "node"], tree.schema)).alias("bytes")).collect()
    per_level = {r["j"]: int(r["bytes"]) for r in sizes}  # as many rows as the longest candidate has items
    occ, held, counts = None, None, []
    for k in range(1, max(per_level, default=0) + 1):
        children = tree.where(F.col("j") == k).select(F.col("parent").alias("_parent"), F.col("item").alias("_item"), F.col("node").alias("_child"))
        if k == 1:
            at = tx.select(_norm_items().alias("tail")).select("tail", F.posexplode("tail").alias("pos", "_item"))
            met = probe(at, children.drop("_parent"), ["_item"], per_level[k])
        else:
            at = occ.select(F.col("node").alias("_parent"), "tail", F.posexplode("tail").alias("pos", "_item"))
            met = probe(at, children, ["_parent", "_item"], per_level[k])
        nxt = met.select(F.col("_child").alias("node"), F.slice("tail", F.col("pos") + 2, F.size("tail")).alias("tail"))
        keep = cut_lineage_observed if k % CUT_EVERY == 0 else persist_observed
        occ, m = keep(nxt, n=F.count(F.lit(1)))
        counts.append(cut_lineage(occ.groupBy("node").agg(_count())))  # one row per prefix
        if held is not None and held.is_cached:
            held.unpersist()
        held = occ
        if m["n"] == 0:
            break
    if held is not None and held.is_cached:
        held.unpersist()
    zero = F.coalesce("support_count", F.lit(0)).cast("long").alias("support_count")
    if not counts:
        return cands.select("items", F.lit(0).cast("long").alias("support_count"))
    named = tree.select("items", "node").join(reduce(DataFrame.unionByName, counts), "node").select("items", "support_count")
    return cands.join(named, "items", "left").select("items", zero)


# ---------------------------------------------------------------------------
# Compare two itemset results
# ---------------------------------------------------------------------------


def compare_itemsets(a: DataFrame, b: DataFrame) -> DataFrame:
    """Full outer join on items -> (items, side, count_a, count_b), side in
    'both' / 'left_only' / 'right_only'. The results are equal iff every row
    is 'both' with equal counts."""
    left = a.select("items", F.col("support_count").alias("count_a"))
    right = b.select("items", F.col("support_count").alias("count_b"))
    return left.join(right, "items", "full_outer").select(
        "items",
        F.when(F.col("count_a").isNull(), F.lit("right_only"))
        .when(F.col("count_b").isNull(), F.lit("left_only"))
        .otherwise(F.lit("both"))
        .alias("side"),
        "count_a",
        "count_b",
    )

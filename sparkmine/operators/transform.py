"""Dataset modifiers and reshaping: F3 restrict_items, F4 pad_transactions,
F6 take_fraction, F8 augment_points, F9 explode_matrix, F10 expand_by_weight.

All randomness is the seeded uniform of ``functions.columns`` (K3): a pure
function of (seed, tag, row key, slot), so re-running a task, changing the
partitioning or counting twice always sees the same data.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.functions.columns import TWO_POW_52, seeded_hash, seeded_uniform
from sparkmine.operators.joins import probe
from sparkmine.session import cut_lineage, cut_lineage_observed, cut_lineage_sized, row_bytes
from sparkmine.sources.index import with_dense_index, with_group_rank_counted

# Tags separating the random streams of the modifiers.
TAG_RESTRICT = "restrict"
TAG_PAD = "pad"
TAG_SOURCE = "source"
TAG_NOISE_R = "noise_r"
TAG_NOISE_T = "noise_t"


def _draw_from_pool(tx: DataFrame, need: str, pool: DataFrame, n_pool: int, pool_bytes: int, seed, tag: str) -> DataFrame:
    """Add array column ``drawn``: for slot s in 1..need, the item of ``pool`` (idx,
    item) with idx = floor(u(seed, tag, txn_id, s) * n_pool) (with replacement), in
    slot order.  ``tx`` has a row id ``_rid``: repeated txn_ids stay apart."""
    slots = (
        tx.where(F.col(need) > 0)
        .select("_rid", "txn_id", F.explode(F.sequence(F.lit(1), F.col(need))).alias("slot"))
        .withColumn("idx", F.floor(seeded_uniform(seed, F.lit(tag), F.col("txn_id"), F.col("slot")) * n_pool).cast("long"))
    )
    # every idx is drawn alike often, so no key is hot
    picked = probe(slots, pool, ["idx"], pool_bytes).groupBy("_rid").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("slot", "item"))), lambda st: st["item"]).alias("drawn")
    )
    return tx.join(picked, "_rid", "left").withColumn("drawn", F.coalesce("drawn", F.array().cast(tx.schema["items"].dataType)))


def _with_row_id(tx: DataFrame) -> DataFrame:
    """``tx`` as a written table with a row id ``_rid``; ``prepare_transactions``
    has made one already."""
    if "_rid" in tx.columns:
        return tx
    return cut_lineage(tx.withColumn("_rid", F.monotonically_increasing_id()))


def restrict_items(tx: DataFrame, n_items: int, seed: int = 0, as_set: bool = False) -> DataFrame:
    """keep the ``n_items`` most frequent items (ties: smaller item first)
    and replace every dropped item by a random kept one, with replacement, so
    the length stays.  The result is a bag (kept items in order, then the
    draws) unless ``as_set``."""
    counts = tx.select(F.explode(F.array_distinct("items")).alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    # top-k is the feature; k is the caller's bound, so the places are numbered in one task
    top = counts.orderBy(F.desc("n"), F.asc("item")).limit(n_items)
    place = (F.row_number().over(Window.orderBy(F.desc("n"), F.asc("item"))) - 1).cast("long")
    ranked = top.select(place.alias("idx"), "item", F.col("n").alias("support_count"))
    pool, m = cut_lineage_observed(ranked, n=F.count(F.lit(1)), bytes=F.sum(row_bytes(ranked.columns, ranked.schema)), total=F.sum("support_count"))
    n_pool, pool_bytes, total = int(m["n"]), int(m["bytes"]), int(m["total"])
    if n_pool == 0:
        return tx.withColumn("items", F.array().cast(tx.schema["items"].dataType))
    rows = _with_row_id(tx)
    # distinct items in input order
    long = rows.select("_rid", F.posexplode(F.array_distinct("items")).alias("pos", "item"))
    kept_long = probe(long, pool.select("item", "support_count"), ["item"], pool_bytes, total, "left_semi")
    kept = kept_long.groupBy("_rid").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "item"))), lambda p: p["item"]).alias("_kept"))
    staged = rows.join(kept, "_rid", "left").withColumn("_kept", F.coalesce("_kept", F.array().cast(tx.schema["items"].dataType)))
    staged = staged.withColumn("_need", F.size("items") - F.size("_kept"))
    drawn = _draw_from_pool(staged, "_need", pool.drop("support_count"), n_pool, pool_bytes, seed, TAG_RESTRICT)
    items = F.concat("_kept", "drawn")
    if as_set:
        items = F.sort_array(F.array_distinct(items))
    return drawn.withColumn("items", items).select(*tx.columns)


def pad_transactions(tx: DataFrame, target_len: int, seed: int = 0) -> DataFrame:
    """a transaction shorter than ``target_len`` gets (target - len) items
    drawn with replacement from all distinct items (ascending order defines the
    pool index), then collapses to a set (so it can end up shorter)."""
    distinct = tx.select(F.explode("items").alias("item")).distinct()
    pool, n_pool, pool_bytes = cut_lineage_sized(with_dense_index(distinct, ["item"], "idx").select("idx", "item"))
    if n_pool == 0:
        return tx
    staged = _with_row_id(tx).withColumn("_need", F.greatest(F.lit(target_len) - F.size("items"), F.lit(0)))
    drawn = _draw_from_pool(staged, "_need", pool, n_pool, pool_bytes, seed, TAG_PAD)
    return drawn.withColumn("items", F.sort_array(F.array_distinct(F.concat("items", "drawn")))).select(*tx.columns)


def take_fraction(tx: DataFrame, fraction: float, order_cols=("txn_id",), dense_ids: bool = False) -> DataFrame:
    """the first int(n * fraction) rows in ``order_cols`` order.

    ``dense_ids`` says ``txn_id`` already is the 0..n-1 source position (text
    sources): then it is a filter, with no ranking pass."""
    if dense_ids:
        n = tx.count()
        return tx.where(F.col("txn_id") < int(n * fraction))
    order = list(order_cols)
    keys, n = with_group_rank_counted(tx.select(*order), order, (), "_idx")
    keep = int(n * fraction)
    if keep == 0:
        return tx.limit(0)
    # only keys are ordered; the rows are filtered by the last kept key
    last = keys.where(F.col("_idx") == keep - 1).select(*order).first()
    key = F.struct(*order)
    limit = F.struct(*(F.lit(last[c]).cast(tx.schema[c].dataType).alias(c) for c in order))
    tied = keys.where(F.struct(*order) == limit).agg(F.count(F.lit(1)).alias("n"), F.min("_idx").alias("low")).first()
    if tied["low"] + tied["n"] == keep:
        return tx.where(key <= limit)
    # rows equal in the whole key, of which only some are kept: any of them
    return tx.where(key < limit).unionByName(tx.where(key == limit).limit(keep - tied["low"]))


def augment_points(
    points: DataFrame,
    m: int,
    sigma: float = 15.0,
    lo: float = 0.0,
    hi: float = 255.0,
    seed: int = 0,
    id_col: str = "point_id",
    features_col: str = "features",
) -> DataFrame:
    """F8: append ``m`` noisy copies of uniformly chosen points (with
    replacement): N(0, sigma) per coordinate (Box-Muller on seeded uniforms),
    clamped to [lo, hi], label copied.  Copies get ids max_id + 1 + copy and a
    ``source_id``; originals have source_id = NULL.  Vectors come out as
    array<double>."""
    spark = points.sparkSession
    n = points.count()
    if n == 0 or m <= 0:
        return points.withColumn(features_col, F.col(features_col).cast("array<double>")).withColumn("source_id", F.lit(None).cast("long"))
    max_id = points.agg(F.max(id_col)).first()[0]
    indexed = with_dense_index(points, [id_col], "_src_idx")
    copies = spark.range(m).select(
        F.col("id").alias("_copy"),
        F.floor(seeded_uniform(seed, F.lit(TAG_SOURCE), F.col("id")) * n).cast("long").alias("_src_idx"),
    )
    joined = copies.join(indexed, "_src_idx")

    def noisy(x, i):
        u1 = (seeded_hash(seed, F.lit(TAG_NOISE_R), F.col("_copy"), i) + F.lit(0.5)) / F.lit(TWO_POW_52)
        u2 = seeded_uniform(seed, F.lit(TAG_NOISE_T), F.col("_copy"), i)
        z = F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)
        return F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), x.cast("double") + F.lit(float(sigma)) * z))

    others = [c for c in points.columns if c not in (id_col, features_col)]
    new = joined.select(
        (F.lit(max_id + 1) + F.col("_copy")).cast("long").alias(id_col),
        F.transform(features_col, noisy).alias(features_col),
        *others,
        F.col(id_col).cast("long").alias("source_id"),
    )
    orig = points.select(
        F.col(id_col).cast("long").alias(id_col),
        F.col(features_col).cast("array<double>").alias(features_col),
        *others,
        F.lit(None).cast("long").alias("source_id"),
    )
    return orig.unionByName(new)


def explode_matrix(df: DataFrame, arr_col: str, keep_cols=()) -> DataFrame:
    """one row per element: (keep..., pos, value)."""
    return df.select(*keep_cols, F.posexplode(arr_col).alias("pos", "value"))


def expand_by_weight(df: DataFrame, weight_col: str, chunk: int = 1_000_000) -> DataFrame:
    """repeat every row ``weight`` times; rows with weight <= 0 vanish.

    Rows with at most ``chunk`` copies are expanded in place.  Heavier rows are
    cut into chunks of ``chunk`` copies, and the chunk rows are spread over
    tasks before the copies are generated, so one heavy row never sits in a
    single task (that branch shuffles nothing when no row is heavy)."""
    w = F.col(weight_col).cast("long")
    cols = df.columns
    light = df.where((w >= 1) & (w <= chunk)).withColumn("_r", F.explode(F.sequence(F.lit(1).cast("long"), w))).select(*cols)
    heavy = (
        df.where(w > chunk)
        .withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((w - 1) / chunk).cast("long"))))
        .withColumn("_len", F.least(F.lit(chunk).cast("long"), w - F.col("_c") * chunk))
        .repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_c", *cols)
        .withColumn("_r", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_len"))))
        .select(*cols)
    )
    return light.unionByName(heavy)

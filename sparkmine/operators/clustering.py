"""Mini-batch k-means on Spark: J6 assign_nearest, A14 sse, A15 update_centers,
A16 kmeanspp, A17 minibatch_kmeans, A18 sample_exact.

The model (k centres of d doubles) of mini-batch k-means lives on the driver between
iterations, as in MLlib; every pass over the points is a Spark job.  An assignment
takes centres of any number: blocks of at most the broadcast bound are brought to
the executors one after the other, with a running minimum.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmine import session
from sparkmine.functions.columns import euclidean_distance, race_key, seeded_hash
from sparkmine.session import cut_lineage, cut_lineage_observed
from sparkmine.sources.index import with_dense_index

# Tags of the random streams.
TAG_SAMPLE = "sample"
TAG_SEED = "kmeanspp"

CENTERS_SCHEMA = T.StructType(
    [
        T.StructField("cluster", T.IntegerType()),
        T.StructField("center", T.ArrayType(T.DoubleType())),
        T.StructField("n", T.LongType()),
    ]
)


def centers_frame(spark, centers: np.ndarray, counts=None) -> DataFrame:
    counts = np.zeros(len(centers), dtype=np.int64) if counts is None else counts
    rows = [(i, [float(v) for v in c], int(counts[i])) for i, c in enumerate(centers)]
    return spark.createDataFrame(rows, CENTERS_SCHEMA)


def _center_blocks(centers, block_bytes: int | None = None):
    """(cluster ids ascending, matrix) of the centres in blocks of at most
    ``block_bytes``; a table's blocks are fetched one at a time."""
    limit = block_bytes or session.BROADCAST_LIMIT_BYTES
    if not isinstance(centers, DataFrame):
        if isinstance(centers, tuple):
            ids, mat = np.asarray(centers[0], dtype=np.int32), np.asarray(centers[1], dtype=np.float64)
        else:
            mat = np.asarray(centers, dtype=np.float64)
            ids = np.arange(len(mat), dtype=np.int32)
        order = np.argsort(ids, kind="stable")
        ids, mat = ids[order], mat[order]
        size = max(1, limit // (8 * max(1, mat.shape[1] if mat.ndim == 2 else 1)))
        for lo in range(0, len(ids), size):
            yield ids[lo : lo + size], mat[lo : lo + size]
        return
    table, m = cut_lineage_observed(centers.select("cluster", "center"), k=F.count(F.lit(1)), d=F.max(F.size("center")))
    size = max(1, limit // (8 * max(1, m["d"])))
    # the places of the centres only matter where they are cut into blocks
    parts = [table]
    if m["k"] > size:
        ranked = cut_lineage(with_dense_index(table, ["cluster"], "_at"))
        parts = [ranked.where((F.col("_at") >= lo) & (F.col("_at") < lo + size)) for lo in range(0, m["k"], size)]
    for part in parts if m["k"] else []:
        rows = sorted(part.select("cluster", "center").collect())
        yield np.array([r["cluster"] for r in rows], dtype=np.int32), np.array([r["center"] for r in rows], dtype=np.float64)


def _vectors(features: pd.Series, d: int) -> np.ndarray:
    """The feature vectors as a matrix; a null, ragged or NaN vector raises."""
    if features.isna().any():
        raise ValueError("null feature vector")
    if any(len(v) != d for v in features):
        raise ValueError(f"feature vectors must have {d} values")
    x = np.stack(features.to_numpy()).astype(np.float64) if len(features) else np.zeros((0, d))
    if np.isnan(x).any():
        raise ValueError("NaN in a feature vector")
    return x


def _nearest(ids: np.ndarray, mat: np.ndarray, x: np.ndarray, arg: np.ndarray, best: np.ndarray) -> None:
    """Lower ``best`` (squared distances) and ``arg`` (cluster ids) by the centres of
    a block.  |x - c| is at least | |x| - |c| |: where that reaches the best distance
    of a row already, the row skips the centre; ties keep the lower cluster."""
    norms, own = np.sqrt(np.einsum("ij,ij->i", mat, mat)), np.sqrt(np.einsum("ij,ij->i", x, x))
    for j in range(len(ids)):
        gap = own - norms[j]
        near = np.flatnonzero(gap * gap * (1 - 1e-9) < best)
        if not len(near):
            continue
        diff = x - mat[j] if len(near) == len(x) else x[near] - mat[j]
        d = np.einsum("ij,ij->i", diff, diff)
        lower = d < best[near]
        best[near[lower]] = d[lower]
        arg[near[lower]] = ids[j]


def _arrow_assigner(spark, ids: np.ndarray, mat: np.ndarray):
    """Nearest centre of a block, going on from (cluster, squared distance) of the
    blocks before it."""
    bc = spark.sparkContext.broadcast((ids, mat))

    @F.pandas_udf("cluster int, d double")
    def assign(features: pd.Series, cluster: pd.Series, d: pd.Series) -> pd.DataFrame:
        c_ids, c = bc.value
        x = _vectors(features, c.shape[1])
        best = d.fillna(np.inf).to_numpy(dtype=np.float64, copy=True)
        arg = cluster.fillna(-1).to_numpy(dtype=np.int32, copy=True)
        _nearest(c_ids, c, x, arg, best)
        return pd.DataFrame({"cluster": arg, "d": best})

    return assign


def assign_nearest(points: DataFrame, centers, features_col: str = "features", method: str = "arrow", block_bytes: int | None = None) -> DataFrame:
    """Add (cluster, dist): nearest centre, ties to the lowest cluster id.

    'arrow': a vectorised pandas UDF (squared differences in double).
    'native': built-in higher-order functions over a literal centre array.
    Centres beyond ``block_bytes`` (the broadcast bound) are taken in blocks, each
    with a running minimum; the points are written every few blocks.  A null, ragged
    or NaN vector raises; without any centre cluster and dist are null."""
    names = [c for c in points.columns]
    state = points.withColumns({"_cluster": F.lit(None).cast("int"), "_d": F.lit(None).cast("double")})
    for i, (ids, mat) in enumerate(_center_blocks(centers, block_bytes)):
        if i and i % 8 == 0:
            state = cut_lineage(state)
        if method == "arrow":
            fn = _arrow_assigner(points.sparkSession, ids, mat)
            state = state.withColumn("_a", fn(F.col(features_col), "_cluster", "_d"))
        else:
            state = state.withColumn("_a", _native_nearest(F.col(features_col), ids, mat))
        state = state.select(*names, F.col("_a.cluster").alias("_cluster"), F.col("_a.d").alias("_d"))
    return state.select(*names, F.col("_cluster").alias("cluster"), F.sqrt("_d").alias("dist"))


def _native_nearest(features, ids: np.ndarray, mat: np.ndarray):
    """(cluster, d) of the nearest of the literal centres and the running minimum."""
    width = int(mat.shape[1])
    bad = features.isNull() | (F.size(features) != width) | F.exists(features, lambda x: x.isNull() | F.isnan(x.cast("double")))
    checked = F.when(F.coalesce(bad, F.lit(True)), F.raise_error(F.lit("null, ragged or NaN feature vector")).cast("array<double>")).otherwise(features.cast("array<double>"))
    lit_c = F.lit([[float(v) for v in row] for row in mat]).cast("array<array<double>>")
    lit_ids = F.lit([int(i) for i in ids]).cast("array<int>")
    square = lambda c: F.aggregate(F.zip_with(checked, c, lambda x, y: (x - y) * (x - y)), F.lit(0.0).cast("double"), lambda acc, v: acc + v)
    found = F.transform(lit_c, lambda c, i: F.struct(square(c).alias("d"), F.element_at(lit_ids, i + 1).alias("cluster")))
    before = F.when(F.col("_d").isNotNull(), F.array(F.struct(F.col("_d").alias("d"), F.col("_cluster").alias("cluster"))))
    best = F.array_min(F.concat(F.coalesce(before, F.slice(found, 1, 0)), found))
    return F.struct(best["cluster"].alias("cluster"), best["d"].alias("d"))


def sse(points: DataFrame, centers, features_col: str = "features", method: str = "arrow") -> DataFrame:
    """One row, sum of squared distances to the nearest centre."""
    assigned = assign_nearest(points, centers, features_col, method)
    return assigned.agg(F.sum(F.col("dist") * F.col("dist")).alias("sse"))


def _partial_sums(features_col: str):
    """(cluster, m, total) of every Arrow batch: k rows instead of n x d."""

    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            own, at = np.unique(pdf["cluster"].to_numpy(), return_inverse=True)
            x = _vectors(pdf[features_col], len(pdf[features_col].iloc[0]))
            total = np.zeros((len(own), x.shape[1]))
            np.add.at(total, at, x)
            yield pd.DataFrame({"cluster": own.astype(np.int32), "m": np.bincount(at).astype(np.int64), "total": list(total)})

    return run


def _vector_sums(assigned: DataFrame, features_col: str) -> DataFrame:
    """(cluster, m, total array<double>): per-cluster count and coordinate sums.

    Every task sums its batches, so a cluster holding most points never meets in one
    task; the sums of the batches are added up by (cluster, position)."""
    part = assigned.select("cluster", features_col).mapInPandas(_partial_sums(features_col), "cluster int, m long, total array<double>")
    per_pos = part.select("cluster", "m", F.posexplode("total").alias("pos", "v")).groupBy("cluster", "pos").agg(F.sum("v").alias("s"), F.sum("m").alias("m"))
    return per_pos.groupBy("cluster").agg(
        F.max("m").alias("m"),
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "s"))), lambda st: st["s"]).alias("total"),
    )


def update_centers(assigned: DataFrame, centers: DataFrame, features_col: str = "features") -> DataFrame:
    """Running-mean update with counts kept across batches:
    c' = (n c + sum x) / (n + m), n' = n + m; clusters without points keep c, n."""
    sums = _vector_sums(assigned, features_col)
    joined = centers.join(sums, "cluster", "left")
    n = F.col("n").cast("double")
    m = F.col("m").cast("double")
    new_center = F.when(
        F.col("m").isNull(), F.col("center")
    ).otherwise(F.zip_with("center", "total", lambda c, s: (n * c + s) / (n + m)))
    return joined.select(
        F.col("cluster").cast("int").alias("cluster"),
        new_center.alias("center"),
        (F.col("n") + F.coalesce(F.col("m"), F.lit(0))).cast("long").alias("n"),
    )


def sample_exact(df: DataFrame, b: int, seed: int, iteration: int, id_col: str = "point_id", n: int | None = None) -> DataFrame:
    """B distinct rows, uniform: the rows with the b smallest (seeded
    hash, id) keys.  The b-th key is found by counting ranges of keys
    (``batch_cutoffs``), and the sample is a filter on the scan: the rows are
    neither sorted nor moved, and no task meets b of them."""
    n = df.count() if n is None else n
    if b > n:
        raise ValueError(f"batch size {b} exceeds the {n} rows")
    if b == 0:
        return df.limit(0)
    h, i = batch_cutoffs(df, b, seed, 1, id_col, n, first=iteration)[iteration]
    return df.where(_sample_key(seed, F.lit(iteration), id_col) <= _key_literal(df, id_col, h, i))


def _key_literal(df: DataFrame, id_col: str, h, i):
    return F.struct(F.lit(h).cast("long").alias("h"), F.lit(i).cast(df.schema[id_col].dataType).alias("id"))


def _sample_key(seed: int, iteration, id_col: str):
    return F.struct(
        seeded_hash(seed, F.lit(TAG_SAMPLE), iteration, F.col(id_col)).alias("h"), F.col(id_col).alias("id")
    )


# Ranges that one step of the selection counts, and keys it leaves to be ordered.
_RANGES = 64
_LEFT = 1000


def batch_cutoffs(df: DataFrame, b: int, seed: int, iterations: int, id_col: str, n: int, first: int = 0) -> dict:
    """The b-th smallest (hash, id) key of the rounds ``first`` .. ``first + iterations
    - 1`` (the samples do not depend on the centres).

    One scan writes the keys below twice the expected b-th hash (about 2b per round);
    a round that got fewer than b is scanned again with a higher bound.  Then the
    interval of hashes that holds the b-th key is cut into ranges, their keys are
    counted, and the one with the b-th key is cut again, until few keys are left."""
    found: dict = {}
    missing = list(range(first, first + iterations))
    limit = 2.0 * b / max(n, 1) * 2**52 + 2**32
    while missing and b:
        bound = int(min(limit, float(2**52)))
        rounds = F.explode(F.array(*[F.lit(it) for it in missing])).alias("it")
        keyed = df.select(F.col(id_col), rounds).select("it", _sample_key(seed, F.col("it"), id_col).alias("k"))
        near = cut_lineage(keyed.where(F.col("k.h") < F.lit(bound)).select("it", "k.h", "k.id"))
        each = near.groupBy("it", "h", "id").agg(F.count(F.lit(1)).alias("c"))
        sizes = each.groupBy("it").agg(F.sum("c").alias("n"), F.max("c").alias("most")).collect()
        if any(r["most"] > 1 for r in sizes):
            raise ValueError(f"{id_col} is not unique")
        got = {r["it"]: r["n"] for r in sizes}
        enough = [it for it in missing if got.get(it, 0) >= b]
        found |= _kth_keys(near, b, {it: got[it] for it in enough}, bound)
        if bound == 2**52 and len(enough) < len(missing):
            raise ValueError(f"batch size {b} exceeds the rows")
        missing = [it for it in missing if it not in found]
        limit *= 4
    return found


def _kth_keys(near: DataFrame, b: int, sizes: dict, bound: int) -> dict:
    """The b-th key of each round: (it, lowest hash, width, keys below) is narrowed to
    one range of the hashes at a time."""
    spark = near.sparkSession
    at = {it: (0, bound, 0, n) for it, n in sizes.items()}  # low, width, keys before low, keys inside
    while wide := {it: v for it, v in at.items() if v[3] > _LEFT and v[1] > 1}:
        rows = [(it, low, -(-width // _RANGES), low + width) for it, (low, width, _, _) in wide.items()]
        cuts = spark.createDataFrame(rows, "it int, low long, step long, top long")
        inside = near.join(F.broadcast(cuts), "it").where((F.col("h") >= F.col("low")) & (F.col("h") < F.col("top")))
        cell = F.floor((F.col("h") - F.col("low")) / F.col("step")).cast("long")
        counted = inside.groupBy("it", cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).orderBy("it", "cell").collect()
        for it, low, step, top in rows:
            before = at[it][2]
            for r in (r for r in counted if r["it"] == it):
                if before + r["n"] >= b:
                    start = low + r["cell"] * step
                    at[it] = (start, min(step, top - start), before, r["n"])
                    break
                before += r["n"]
    rows = [(it, low, low + width) for it, (low, width, _, _) in at.items()]
    if not rows:
        return {}
    cuts = spark.createDataFrame(rows, "it int, low long, top long")
    left = near.join(F.broadcast(cuts), "it").where((F.col("h") >= F.col("low")) & (F.col("h") < F.col("top"))).select("it", "h", "id").collect()
    keys: dict = {}
    for r in left:
        keys.setdefault(r["it"], []).append((r["h"], r["id"]))
    return {it: sorted(keys[it])[b - at[it][2] - 1] for it in at}


def kmeanspp(
    points: DataFrame,
    k: int,
    seed: int = 0,
    power: float = 1.0,
    id_col: str = "point_id",
    features_col: str = "features",
    cut_every: int = 4,
    written: bool = False,
) -> tuple[DataFrame, list]:
    """Weighted seeding.  The first centre is uniform; each next one is
    drawn with probability proportional to (distance to the nearest chosen
    centre) ** power via an exponential race (smallest -ln(u)/w wins, ties by
    id); chosen points are left out, so equal points never repeat one.  Returns (centres frame, chosen ids).

    The vectors are written once (not at all if ``points`` is ``written`` already),
    cached by id and never rewritten.  The state is a table (id, distance to the
    nearest centre so far) of 16 bytes a point, written every ``cut_every`` steps; it
    meets the cached vectors by id, and the centres chosen since are applied to it in
    one pass, which takes the race's winner."""
    spark = points.sparkSession
    pts = points.select(id_col, features_col)
    pts = (pts if written else cut_lineage(pts)).repartition(F.col(id_col)).persist()
    n = pts.count()
    if k > n:
        pts.unpersist()
        raise ValueError(f"k = {k} exceeds the {n} points")
    first = pts.orderBy(seeded_hash(seed, F.lit(TAG_SEED), F.lit(0), F.col(id_col)), id_col).limit(1).collect()[0]
    chosen_ids = [first[id_col]]
    chosen = [np.asarray(first[features_col], dtype=np.float64)]
    state, applied = None, 0
    for step in range(1, k):
        near = [euclidean_distance(features_col, F.lit([float(v) for v in c]).cast("array<double>")) for c in chosen[applied:]]
        if state is None:
            rows = pts
        else:
            rows = pts.join(state, F.col(id_col) == F.col("_id")).drop("_id")
            near.append(F.col("_before"))
        rows = rows.withColumn("_min_dist", F.least(*near) if len(near) > 1 else near[0]).drop("_before")
        if len(chosen) - applied >= cut_every:
            state = cut_lineage(rows.select(F.col(id_col).alias("_id"), F.col("_min_dist").alias("_before")))
            applied = len(chosen)
            rows = pts.join(state.withColumnRenamed("_before", "_min_dist"), F.col(id_col) == F.col("_id")).drop("_id")
        weight = F.pow(F.col("_min_dist"), F.lit(float(power))) if power != 1.0 else F.col("_min_dist")
        key = race_key(seed, weight, F.lit(TAG_SEED), F.lit(step), F.col(id_col))
        pick = rows.where(~F.col(id_col).isin(chosen_ids)).orderBy(key.asc_nulls_last(), F.col(id_col)).limit(1).collect()[0]
        chosen_ids.append(pick[id_col])
        chosen.append(np.asarray(pick[features_col], dtype=np.float64))
    pts.unpersist()
    return centers_frame(spark, np.vstack(chosen)), chosen_ids


def minibatch_kmeans(
    points: DataFrame,
    k: int,
    batch_size: int,
    max_iter: int = 200,
    seed: int = 0,
    init: DataFrame | None = None,
    id_col: str = "point_id",
    features_col: str = "features",
    method: str = "arrow",
) -> tuple[DataFrame, DataFrame]:
    """Seed (A16 unless ``init``), then ``max_iter`` rounds of
    sample (A18) -> assign against the round's starting centres (J6) ->
    running-mean update (A15), then a full assignment.
    Returns (centres (cluster, center, n), assignment points + cluster, dist)."""
    spark = points.sparkSession
    pts = cut_lineage(points)
    n = pts.count()
    if init is None:
        init, _ = kmeanspp(pts, k, seed, id_col=id_col, features_col=features_col, written=True)
    rows = init.orderBy("cluster").collect()
    ids = np.array([r["cluster"] for r in rows], dtype=np.int32)
    mat = np.array([r["center"] for r in rows], dtype=np.float64)
    counts = np.array([r["n"] for r in rows], dtype=np.int64)
    slot = {int(c): i for i, c in enumerate(ids)}
    if batch_size > n:
        raise ValueError(f"batch size {batch_size} exceeds the {n} rows")
    if not (max_iter and batch_size):
        centers = _as_frame(spark, ids, mat, counts)
        return centers, assign_nearest(points, centers, features_col, method)
    rounds = _batches(pts.select(id_col, features_col), batch_size, seed, max_iter, id_col, n)
    for it in range(max_iter):
        batch = rounds.where(F.col("it") == it)
        assigned = assign_nearest(batch, (ids, mat.copy()), features_col, method)
        # the sums are the model's own size (k x d), assembled where the model lives
        totals = np.zeros_like(mat)
        hits = np.zeros(len(mat), dtype=np.int64)
        for r in _vector_sums(assigned, features_col).collect():
            j = slot[int(r["cluster"])]
            totals[j] = r["total"]
            hits[j] = r["m"]
        for j in np.nonzero(hits)[0]:
            mat[j] = (counts[j] * mat[j] + totals[j]) / (counts[j] + hits[j])
            counts[j] += hits[j]
    return _as_frame(spark, ids, mat, counts), assign_nearest(points, (ids, mat), features_col, method)


def _batches(points: DataFrame, b: int, seed: int, rounds: int, id_col: str, n: int) -> DataFrame:
    """The samples of all rounds, (it, columns of ``points``), from one scan: every row
    goes to the rounds whose cutoff its key does not exceed, into a table partitioned
    by round.  A round then reads its own folder (b rows) instead of the points."""
    spark = points.sparkSession
    cutoffs = batch_cutoffs(points, b, seed, rounds, id_col, n)
    limits = F.array(*[_key_literal(points, id_col, *cutoffs[it]) for it in range(rounds)])
    drawn = F.filter(F.sequence(F.lit(0), F.lit(rounds - 1)), lambda it: _sample_key(seed, it, id_col) <= F.element_at(limits, it + 1))
    path = f"{session.ensure_checkpoint_dir(spark).rstrip('/')}/sparkmine-tables/{uuid.uuid4().hex}"
    out = points.withColumn("it", F.explode(drawn))
    # a round's rows in as many files as they need, not one per task of the scan
    spread = F.pmod(F.xxhash64(id_col), F.lit(-(-b // _ROWS_PER_FILE)))
    out.repartition(F.col("it"), spread).write.partitionBy("it").parquet(path)
    session.own_table(path)
    schema = T.StructType([*points.schema.fields, T.StructField("it", T.IntegerType())])
    return spark.read.schema(schema).parquet(path)


# Rows of one file of a round's sample.
_ROWS_PER_FILE = 20_000


def _as_frame(spark, ids, mat, counts) -> DataFrame:
    rows = [(int(ids[i]), [float(v) for v in mat[i]], int(counts[i])) for i in range(len(ids))]
    return spark.createDataFrame(rows, CENTERS_SCHEMA)

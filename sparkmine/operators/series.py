"""Series operators: W1 ordinal_gap, W2 histogram_density, W3 gaussian_smooth."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.session import maybe_broadcast
from sparkmine.sources.index import with_group_rank


def ordinal_gap(df: DataFrame, grp: str, value: str, n="mid", tiebreak: str | None = None) -> DataFrame:
    """Per group, (n-th smallest value) - ((n-1)-th smallest), 0-based.

    ``n`` is an int or 'mid' (n = group size // 2, the middle gap).  Ranks come
    from a range-partitioned dense index (F5 within groups), so a group with a
    third of all rows is spread over many tasks instead of one window.
    Groups with fewer than n + 1 values give no row."""
    order = [value] + ([tiebreak] if tiebreak else [])
    ranked = with_group_rank(df.select(grp, *order), order, [grp], "_rank")
    if n == "mid":
        sizes = df.groupBy(F.col(grp).alias("_own")).agg(F.count(F.lit(1)).alias("_size"))
        n_groups = sizes.count()
        ranked = ranked.join(maybe_broadcast(sizes, n_groups, 48), F.col(grp).eqNullSafe(F.col("_own"))).drop("_own")
        target = F.floor(F.col("_size") / 2)
    else:
        target = F.lit(int(n))
    picked = ranked.where((F.col("_rank") == target) | (F.col("_rank") == target - 1)).withColumn("_t", target)
    agg = picked.groupBy(grp).agg(
        F.max(F.when(F.col("_rank") == F.col("_t"), F.col(value))).alias("_hi"),
        F.max(F.when(F.col("_rank") == F.col("_t") - 1, F.col(value))).alias("_lo"),
        F.max("_t").alias("n"),
    )
    return agg.where(F.col("_hi").isNotNull() & F.col("_lo").isNotNull()).select(
        grp, F.col("n").cast("long").alias("n"), (F.col("_hi") - F.col("_lo")).alias("gap")
    )


def _edge(i, lo: float, hi: float, bins: int):
    step = (hi - lo) / bins
    return F.when(i >= bins, F.lit(float(hi))).otherwise(i.cast("double") * F.lit(step) + F.lit(float(lo)))


def histogram_density(df: DataFrame, col: str, bins: int = 1000, lo: float = -3.0, hi: float = 3.0) -> DataFrame:
    """Equal-width histogram on [lo, hi] -> (bin, center, n, density).

    Bin index and edges follow NumPy (last bin closed, edges = i * step + lo,
    index corrected against the edges); density = n / width / in-range total,
    NULL when nothing is in range; empty bins appear with n = 0."""
    spark = df.sparkSession
    if not (hi > lo) or bins < 1:
        raise ValueError(f"need lo < hi and bins >= 1, got ({lo}, {hi}) and {bins}")
    v = F.col(col).cast("double")
    inr = df.select(v.alias("v")).where(F.col("v").isNotNull() & (F.col("v") >= lo) & (F.col("v") <= hi))
    f = (F.col("v") - F.lit(float(lo))) / F.lit(float(hi - lo)) * F.lit(float(bins))
    i0 = F.floor(f).cast("int")
    i1 = F.when(i0 == bins, F.lit(bins - 1)).otherwise(i0)
    i2 = F.when(F.col("v") < _edge(i1, lo, hi, bins), i1 - 1).otherwise(i1)
    i3 = F.when((F.col("v") >= _edge(i2 + 1, lo, hi, bins)) & (i2 != bins - 1), i2 + 1).otherwise(i2)
    counts = inr.groupBy(i3.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    b = F.col("bin")
    lo_e, hi_e = _edge(b, lo, hi, bins), _edge(b + 1, lo, hi, bins)
    return (
        spark.range(bins)
        .select(F.col("id").cast("int").alias("bin"))
        .join(counts, "bin", "left")
        .select(
            "bin",
            ((lo_e + hi_e) / F.lit(2.0)).alias("center"),
            F.coalesce("n", F.lit(0)).cast("long").alias("n"),
            F.when(total > 0, F.coalesce("n", F.lit(0)).cast("double") / (hi_e - lo_e) / total).alias("density"),
        )
    )


def gaussian_kernel(sigma: float, truncate: float = 4.0) -> list[float]:
    """Normalised weights for offsets -r..r, r = int(truncate * sigma + 0.5)."""
    r = int(truncate * sigma + 0.5)
    raw = [math.exp(-0.5 * j * j / (sigma * sigma)) for j in range(-r, r + 1)]
    s = sum(raw)
    return [w / s for w in raw]


def gaussian_smooth(df: DataFrame, pos: str, value: str, sigma: float = 2.0, truncate: float = 4.0) -> DataFrame:
    """Gaussian smoothing of the series ``value`` at positions 0..n-1
    (mode 'reflect': x[-1] = x[0], x[n] = x[n-1]).

    The 2r mirrored boundary values are joined in from a 2r-row table, then
    each value is spread to its 2r + 1 neighbours and summed per position
    (partial aggregation first).  A constant series stays constant and the
    total is kept."""
    spark = df.sparkSession
    weights = gaussian_kernel(sigma, truncate)
    r = (len(weights) - 1) // 2
    series = df.select(F.col(pos).cast("long").alias("q"), F.col(value).cast("double").alias("v"))
    shape = series.agg(F.count(F.lit(1)).alias("n"), F.min("q").alias("lo"), F.max("q").alias("hi"), F.count_distinct("q").alias("d")).first()
    n = shape["n"]
    if n == 0:
        return series.select(F.col("q").alias(pos), F.col("v").alias(value))
    if (shape["lo"], shape["hi"], shape["d"]) != (0, n - 1, n):
        raise ValueError("positions must be 0..n-1, each once (index the series first, F5)")
    bounds = spark.range(-r, 0).union(spark.range(n, n + r)).select(F.col("id").alias("q"))
    m = F.pmod(F.col("q"), F.lit(2 * n))
    bounds = bounds.withColumn("s", F.when(m < n, m).otherwise(F.lit(2 * n - 1) - m))
    mirrored = series.select(F.col("q").alias("s"), "v").join(F.broadcast(bounds), "s").select("q", "v")
    ext = series.unionByName(mirrored)
    w = F.lit(weights).cast("array<double>")
    spread = ext.select("q", "v", F.explode(F.sequence(F.lit(-r), F.lit(r))).alias("j")).select(
        (F.col("q") - F.col("j")).alias("i"), (F.element_at(w, (F.col("j") + r + 1).cast("int")) * F.col("v")).alias("c")
    )
    return (
        spread.where((F.col("i") >= 0) & (F.col("i") < n))
        .groupBy("i")
        .agg(F.sum("c").alias(value))
        .select(F.col("i").alias(pos), value)
    )

"""Column expressions shared by the operators (K3, C1 and itemset helpers).

All of them are built-in Spark expressions, so they stay JVM-side.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The seeded uniform keeps the first 13 hex digits of an md5,
# i.e. 52 bits, so h is exact in a double and u = h / 2**52 lies in [0, 1).
HEX_DIGITS = 13
TWO_POW_52 = float(2**52)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seeded_hash(seed, *keys) -> Column:
    """h = first 52 bits of md5('seed:key1:key2...') as a bigint (K3).

    A pure function of its inputs: the same rows get the same numbers under any
    partitioning, on any engine that has md5 (DuckDB gives identical values).
    """
    parts = [F.lit(str(seed))] + [_col(k).cast("string") for k in keys]
    digest = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("bigint")


def seeded_uniform(seed, *keys) -> Column:
    """u = h / 2^52 in [0, 1)."""
    return seeded_hash(seed, *keys) / F.lit(TWO_POW_52)


def race_key(seed, weight: Column, *keys) -> Column:
    """Exponential-race key -ln(u)/w with u = (h + 0.5)/2^52 in (0, 1).

    Taking the row with the smallest key picks a row with probability
    proportional to ``weight``. Rows with zero weight get NULL (sort them last).
    """
    u = (seeded_hash(seed, *keys) + F.lit(0.5)) / F.lit(TWO_POW_52)
    return F.when(weight > 0, -F.log(u) / weight)


def squared_distance(a, b) -> Column:
    """Sum of squared coordinate differences, accumulated in double."""
    diffs = F.zip_with(_col(a), _col(b), lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.aggregate(diffs, F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def euclidean_distance(a, b) -> Column:
    """Euclidean distance of two equal-length vectors."""
    return F.sqrt(squared_distance(a, b))


def drop_one_subsets(items, k: int) -> Column:
    """All k drop-one subsets of a sorted k-array, in order of the dropped position."""
    arr = _col(items)
    return F.array(*[F.concat(F.slice(arr, 1, i - 1), F.slice(arr, i + 1, k - i)) if i > 1 else F.slice(arr, 2, k - 1) for i in range(1, k + 1)])


def itemset_string(items) -> Column:
    """Flatten a sorted itemset to 'a,b,c' (used for comparable query output)."""
    return F.concat_ws(",", F.transform(_col(items), lambda x: x.cast("string")))


def min_count_from_support(support: float, n: int) -> int:
    """Absolute threshold ceil(support * n) in double arithmetic."""
    return int(math.ceil(float(support) * n))


def is_subset(candidate, transaction) -> Column:
    """True when every item of ``candidate`` is in ``transaction``."""
    return F.size(F.array_except(_col(candidate), _col(transaction))) == 0


def bitstring_value(bits) -> Column:
    """Integer value of a '0'/'1' string (most significant bit first)."""
    return F.conv(_col(bits), 2, 10).cast("long")


def bitstring_phase(bits, n_bits: int) -> Column:
    """Measured phase value / 2^n_bits of a counting-register bit string."""
    return bitstring_value(bits) / F.lit(float(2**n_bits))

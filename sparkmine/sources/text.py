"""Whitespace text readers with a dense line index in source order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmine.session import cut_lineage, cut_lineage_sized, probe


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with ``line_no`` = 0-based position in source order.

    Source order is (file path, split start, position in the split).  The lines are
    written once, each with its split and a scan-time id that grows within the split;
    the splits' sizes and first ids are then counted in that written table, so the
    numbers rest on one scan of the text, however later passes cut their splits.
    A line's number is the number of lines in the splits before its own plus its
    position there: one small aggregate per split and a join with it; the lines
    themselves are neither shuffled nor sorted.
    """
    raw = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_scan_id"),
    )
    lines = cut_lineage(raw)
    splits = lines.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_scan_id").alias("_first"))
    # one row per input split (data size / split size): small enough for one ordered pass
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    splits, _, size = cut_lineage_sized(splits)
    return probe(lines, splits, ["_file", "_block"], size).select("value", (F.col("_offset") + F.col("_scan_id") - F.col("_first")).alias("line_no"))


def _tokens(value_col: str = "value"):
    toks = F.split(F.trim(F.col(value_col)), r"\s+")
    return F.filter(toks, lambda t: t != "")


def read_transactions(spark: SparkSession, path: str, item_type: str = "int") -> DataFrame:
    """One transaction per line -> (txn_id, items sorted distinct).

    A blank line is an empty transaction (it still counts in n); a token that
    is not a number raises (ANSI cast)."""
    lines = read_lines(spark, path)
    items = F.sort_array(F.array_distinct(_tokens().cast(f"array<{item_type}>")))
    return lines.select(F.col("line_no").alias("txn_id"), items.alias("items"))


def read_points(spark: SparkSession, features_path: str, labels_path: str) -> DataFrame:
    """Feature lines and label lines paired by position ->
    (point_id, features array<float>, label int). Raises on unequal line
    counts, ragged vectors or NaN."""
    feats = read_lines(spark, features_path).select(
        F.col("line_no").alias("point_id"), _tokens().cast("array<float>").alias("features")
    )
    labels = read_lines(spark, labels_path).select(
        F.col("line_no").alias("point_id"), F.trim("value").cast("int").alias("label")
    )
    stats = feats.agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.size("features")).alias("lo"),
        F.max(F.size("features")).alias("hi"),
        F.count_if(F.exists("features", lambda x: F.isnan(x))).alias("nan"),
    ).first()
    n_labels = labels.count()
    if stats["n"] != n_labels:
        raise ValueError(f"{stats['n']} feature lines but {n_labels} label lines")
    if stats["n"] and stats["lo"] != stats["hi"]:
        raise ValueError(f"ragged feature vectors: lengths {stats['lo']}..{stats['hi']}")
    if stats["nan"]:
        raise ValueError(f"{stats['nan']} feature vectors contain NaN")
    return feats.join(labels, "point_id")

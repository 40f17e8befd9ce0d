"""Streaming use of the batch operators.

The reference has no streaming: no watermark, window, state store or late
data (SURVEY section 2.9), so nothing stream-specific is built.  The two
plain counting operators, item support (A1) and the frequency table (A19),
are groupBy aggregations that Structured Streaming maintains incrementally in
its state store; these helpers give them a streaming source.  The level-wise
miners need whole-table passes per level and stay batch-only (run them per
micro-batch with ``foreachBatch`` if needed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_item_support(tx_stream: DataFrame) -> DataFrame:
    """A1 on a stream of transactions (txn_id, items): running (item,
    support_count); use output mode 'complete' or 'update'."""
    return tx_stream.select(F.explode(F.array_distinct("items")).alias("item")).groupBy("item").agg(
        F.count(F.lit(1)).alias("support_count")
    )


def stream_frequency_table(stream: DataFrame, col: str) -> DataFrame:
    """A19 counts on a stream: running (value, n); the share is n / sum(n) of
    the emitted table."""
    return stream.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))

"""S3: transactions from a long table (one row per transaction and item)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def baskets(df: DataFrame, txn_col: str, item_col: str) -> DataFrame:
    """(txn_id, items): sorted distinct items per transaction; a null
    transaction or item is an error.

    collect_set is de-duplicated in the partial (map-side) aggregate, so a
    transaction's row never holds more than its distinct items."""

    def given(name: str):
        return F.coalesce(F.col(name), F.raise_error(F.lit(f"null in column {name}")))

    return df.groupBy(given(txn_col).alias("txn_id")).agg(F.sort_array(F.collect_set(given(item_col))).alias("items"))

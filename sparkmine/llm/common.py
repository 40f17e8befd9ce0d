"""Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.session import cut_lineage

#: White space that separates words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = "[\\x20\\x09-\\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array (null: none), in built-in functions."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """UTF-8 bytes of all texts (one aggregate over the text column)."""
    return docs.agg(F.sum(F.octet_length(F.col(text_col)).cast("long"))).head()[0] or 0


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


__all__ = ["SPACES", "cut_lineage", "documents", "text_bytes", "unused", "words"]

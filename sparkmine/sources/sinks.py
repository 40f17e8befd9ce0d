"""Result writer (CSV with a header, or parquet), appending by default."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType


def write_results(df: DataFrame, path: str, fmt: str = "csv", mode: str = "append") -> None:
    out = df
    if fmt == "csv":
        # CSV has no array type: flatten arrays to 'a,b,c' strings.
        for field in df.schema.fields:
            if isinstance(field.dataType, ArrayType):
                out = out.withColumn(field.name, F.concat_ws(",", F.col(field.name).cast("array<string>")))
        out.write.mode(mode).option("header", True).csv(path)
    else:
        out.write.mode(mode).format(fmt).save(path)

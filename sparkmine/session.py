"""Session helpers: a local session for tests/bench, the checkpoint folder,
and size-checked broadcast decisions."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Upper bound (bytes, estimated from exact row counts) for hinting a broadcast.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "sparkmine") -> SparkSession:
    """A local session with AQE on; used by tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARKMINE_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for kv in filter(None, os.environ.get("SPARKMINE_CONF", "").split(",")):
        key, _, value = kv.partition("=")
        builder = builder.config(key.strip(), value.strip())
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, reading ``spark.checkpoint.dir``.

    On a cluster the folder must be shared storage named by the cluster; only a
    local-mode session (tests) gets its own folder when nothing is configured.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared folder for the cluster "
            "(iterative operators cut their lineage with reliable checkpoints)"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="sparkmine-ckpt-"))
    return sc.getCheckpointDir()


# Tables and caches of the open scopes, innermost last.
_scopes: list[list] = []


def own_table(path: str) -> None:
    """The innermost open scope deletes the table at ``path`` when it ends."""
    if _scopes:
        _scopes[-1].append(path)


@contextmanager
def table_scope(spark: SparkSession):
    """Owns the tables written and the caches filled inside it and releases them at its
    end, also after an error.  What leaves the scope must be on the driver or in a
    table of the caller's own."""
    _scopes.append([])
    try:
        yield
    finally:
        for item in _scopes.pop():
            if isinstance(item, DataFrame):
                item.unpersist()
            else:
                path = spark._jvm.org.apache.hadoop.fs.Path(item)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder and
    read it back: one job, columnar and compressed, no lineage to the inputs,
    and it survives executor loss.  ``compression``: a codec other than the session's."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    path = f"{root.rstrip('/')}/sparkmine-tables/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path, compression=compression)
    own_table(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage_observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """``cut_lineage`` that also returns global aggregates computed while the
    table is written (DataFrame.observe), so counts cost no extra job."""
    obs = Observation(f"sparkmine_{uuid.uuid4().hex}")
    exprs = [c.alias(name) for name, c in metrics.items()]
    out = cut_lineage(df.observe(obs, *exprs))
    got = obs.get
    return out, {k: (got.get(k) if got.get(k) is not None else 0) for k in metrics}


def persist_observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """Cache a table and compute ``metrics`` in the same job.  A lost cached
    partition is recomputed from what it was made of: callers write a table every
    few steps, which bounds the steps that are replayed."""
    obs = Observation(f"sparkmine_{uuid.uuid4().hex}")
    exprs = [c.alias(name) for name, c in metrics.items()]
    out = df.observe(obs, *exprs).persist()
    if _scopes:
        _scopes[-1].append(out)
    out.write.format("noop").mode("overwrite").save()
    got = obs.get
    return out, {k: (got.get(k) if got.get(k) is not None else 0) for k in metrics}


def row_bytes(columns, schema: T.StructType) -> Column:
    """Bytes that a row's values take: the UTF-8 length of strings, the elements of
    arrays, 8 for anything else, and 40 for the row itself.  Summed while a table is
    written, it is the size that decides on a broadcast."""
    kinds = {f.name: f.dataType for f in schema.fields}
    total = F.lit(40).cast("long")
    for c in columns:
        kind = kinds.get(c)
        if isinstance(kind, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(F.col(c)).cast("long"), F.lit(0))
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
            total = total + F.coalesce(F.aggregate(F.col(c), F.lit(0).cast("long"), lambda n, x: n + 16 + F.octet_length(x)), F.lit(0))
        elif isinstance(kind, T.ArrayType):
            total = total + F.lit(8) * F.greatest(F.size(F.col(c)), F.lit(0))
        else:
            total = total + 8
    return total


def cut_lineage_sized(df: DataFrame) -> tuple[DataFrame, int, int]:
    """``cut_lineage`` that also returns the rows and bytes it wrote."""
    out, m = cut_lineage_observed(df, n=F.count(F.lit(1)), bytes=F.sum(row_bytes(df.columns, df.schema)))
    return out, int(m["n"]), int(m["bytes"])


def maybe_broadcast(df: DataFrame, n_rows: int, row_bytes: int) -> DataFrame:
    """Hint a broadcast only when the exact row count times the size of a row (rows
    of fixed width; ``cut_lineage_sized`` measures others) fits under ``BROADCAST_LIMIT_BYTES``; otherwise let the planner/AQE choose."""
    if n_rows * row_bytes <= BROADCAST_LIMIT_BYTES:
        return F.broadcast(df)
    return df


# A key with at least this fraction of the rows (1 / HOT_PARTS) is hot.
HOT_PARTS = 64


def probe(rows: DataFrame, table: DataFrame, on: list[str], table_bytes: int, total: int | None = None, how: str = "inner") -> DataFrame:
    """Join ``rows`` with ``table`` (one row per key ``on``); one hash lookup a row.

    ``table_bytes`` is the table's size as measured when it was written: within
    the broadcast bound the table is broadcast and the rows stay where they are.
    Beyond it both sides are shuffled by the whole key.  ``table`` may carry
    ``support_count``, how many rows hold the key (``total``: their sum): at most
    HOT_PARTS keys can hold 1 / HOT_PARTS of the rows each, so those are broadcast
    whatever the size of the table, and no hot key meets in one task."""
    plain = table.drop("support_count")
    if table_bytes <= BROADCAST_LIMIT_BYTES:
        return rows.join(F.broadcast(plain), on, how)
    if total is None or "support_count" not in table.columns:
        return rows.join(plain.hint("merge"), on, how)
    is_hot = F.col("support_count") * HOT_PARTS >= F.lit(total)
    hot = table.where(is_hot).drop("support_count")
    cold = table.where(~is_hot).drop("support_count")
    spread = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(cold.hint("merge"), on, how)
    return rows.join(F.broadcast(hot), on, how).unionByName(spread)

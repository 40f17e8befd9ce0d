"""Operator 9: mixing sources to target weights, in built-in functions only.

Words are summed per source (map-side first).  Sources in code-point order, null
last, take the weights 3, 1, 2 in turn and share 150% of all words.  No target
exceeds twice its source's size; the excess goes to the others by weight until
none is above, which is a water level: targets are min(2 * size, level * weight).
The level comes from running sums over the sources (one row each) by ascending
size / weight.

A source's repetition rate is target / size.  Every document is emitted
floor(rate) times, plus once more where a seeded hash of its doc_id and text is below
the fraction, so a mix is reproducible row by row.

Defined cases: null text has size 0; the null source is a source of its own; null,
repeated or default doc_ids are drawn apart by their texts, and only rows equal in
both share their draw; a source without words has target 0 and is emitted 0 times;
an empty table gives an empty mix; other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmine.functions.columns import seeded_uniform
from sparkmine.llm.common import documents, words

#: Weights that the sources take in turn, and the mix's size and cap.
WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MAX_REPEATS = 2
SEED = 9


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, weight, target) of a table (source, size).

    The two orderings run in one task each over one row per source."""
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(place, F.lit(len(WEIGHTS))) + 1).cast("int"))
    weighed = total.withColumn("weight", weight.cast("long"))
    up = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    every = Window.partitionBy()
    sums = weighed.select(
        "*",
        F.coalesce(F.sum("source_size").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("size_before"),
        F.coalesce(F.sum("weight").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("weight_before"),
        F.sum("source_size").over(every).alias("size_all"),
        F.sum("weight").over(every).alias("weight_all"),
    )
    # with the sources before it full, is this one above its cap at the level of the rest?
    budget = F.col("size_all") * F.lit(SHARE_PERCENT / 100.0) - F.lit(float(MAX_REPEATS)) * F.col("size_before")
    rest = F.col("weight_all") - F.col("weight_before")
    sums = sums.withColumn("full", budget * F.col("weight") >= F.lit(float(MAX_REPEATS)) * F.col("source_size") * rest)
    done = sums.select(
        "*",
        F.coalesce(F.sum(F.when(F.col("full"), F.col("source_size"))).over(every), F.lit(0)).alias("size_full"),
        F.coalesce(F.sum(F.when(F.col("full"), F.col("weight"))).over(every), F.lit(0)).alias("weight_full"),
    )
    shared = (F.col("size_all") * F.lit(SHARE_PERCENT / 100.0) - F.lit(float(MAX_REPEATS)) * F.col("size_full")) * F.col("weight") / (F.col("weight_all") - F.col("weight_full"))
    target = F.when(F.col("full"), F.lit(float(MAX_REPEATS)) * F.col("source_size")).otherwise(shared)
    return done.select("source", "source_size", "weight", target.alias("target"))


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def text_key(text: Column) -> Column:
    """What a row's text adds to its draw (null: nothing)."""
    return F.coalesce(F.md5(text), F.lit(""))


def repeats(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """A table with columns doc_id, source, size, text_key plus source_size, target and
    copies: how often the mix takes the row."""
    targets = source_targets(docs.select("source", "size")).withColumnRenamed("source", "own_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    once_more = seeded_uniform(seed, F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_key")) < rate - F.floor(rate)
    return docs.join(targets, F.col("source").eqNullSafe(F.col("own_source"))).withColumn("copies", F.floor(rate) + once_more.cast("long")).drop("own_source", "weight", "text_key")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their own columns."""
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    sized = docs.select(own, F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"), text_key(F.col(text_col)).alias("text_key"))
    taken = repeats(sized, seed).where(F.col("copies") > 0)
    return taken.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy")).select("_row.*")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9 over all ``documents``."""
    docs = documents(spark, sf_dir).select("doc_id", "source", n_words(F.col("text")).alias("size"), text_key(F.col("text")).alias("text_key"))
    return repeats(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP9_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(md5(text), '') AS text_key, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3, 1, 2][(row_number() OVER (ORDER BY source IS NULL, source COLLATE "C") - 1)::INT % 3 + 1] AS weight
  FROM d GROUP BY source),
a AS (SELECT sum(source_size) * 1.5::DOUBLE AS budget FROM s),
fill AS (
  SELECT 0 AS step, source, source_size, weight, false AS was_full, NULL::DOUBLE AS target FROM s
  UNION ALL
  SELECT step + 1, source, source_size, weight, was_full OR share >= 2.0::DOUBLE * source_size,
         CASE WHEN was_full OR share >= 2.0::DOUBLE * source_size THEN 2.0::DOUBLE * source_size ELSE share END
  FROM (SELECT f.step, f.source, f.source_size, f.weight, f.was_full,
               (a.budget - 2.0::DOUBLE * coalesce(sum(CASE WHEN was_full THEN source_size END) OVER (), 0)) * weight
               / coalesce(sum(CASE WHEN NOT was_full THEN weight END) OVER (), 1) AS share
        FROM fill f, a) x
  WHERE step <= (SELECT count(*) FROM s)),
t AS (SELECT source, source_size, target FROM fill WHERE step = (SELECT max(step) FROM fill)),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('9:' || coalesce(d.doc_id::VARCHAR, '') || ':' || d.text_key), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       ((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM r
"""

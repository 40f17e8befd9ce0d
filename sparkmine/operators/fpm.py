"""A9 fp_growth (Spark ML's parallel FP-Growth) and A10 association_rules."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fp_growth(tx: DataFrame, min_count: int, n: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Frequent itemsets by FP-Growth -> (k, items sorted, support_count).

    Spark's threshold is ceil(minSupport * n); passing (min_count - 0.5) / n
    lands strictly between min_count - 1 and min_count, so the absolute
    threshold is exactly min_count (c/n*n can round above c)."""
    n = tx.count() if n is None else n
    if n == 0:
        item_type = tx.schema["items"].dataType.simpleString()
        return tx.sparkSession.createDataFrame([], f"k int, items {item_type}, support_count long")
    fp = FPGrowth(itemsCol="items", minSupport=(min_count - 0.5) / n, minConfidence=1.0)
    if num_partitions:
        fp = fp.setNumPartitions(num_partitions)
    model = fp.fit(tx.select(F.array_distinct("items").alias("items")))
    return model.freqItemsets.select(
        F.size("items").cast("int").alias("k"),
        F.sort_array("items").alias("items"),
        F.col("freq").cast("long").alias("support_count"),
    )


def association_rules(itemsets: DataFrame, n: int, min_confidence: float = 0.8) -> DataFrame:
    """A10: single-consequent rules X -> {y} from frequent itemsets
    (k, items, support_count): support_count of X + {y}, confidence, lift,
    support; kept if confidence >= min_confidence.  Every subset of a frequent
    set is frequent, so the antecedent and consequent counts come from two
    equi-joins with the itemset table itself."""
    full = itemsets.where(F.col("k") >= 2).select(
        F.col("items").alias("_full"), F.col("support_count").alias("_c_full"), F.explode("items").alias("_y")
    )
    rules = full.select(
        F.array_remove("_full", F.col("_y")).alias("antecedent"), F.array("_y").alias("consequent"), "_c_full"
    )
    ante = itemsets.select(F.col("items").alias("antecedent"), F.col("support_count").alias("_c_ante"))
    cons = itemsets.where(F.col("k") == 1).select(F.col("items").alias("consequent"), F.col("support_count").alias("_c_cons"))
    conf = F.col("_c_full") / F.col("_c_ante")
    return (
        rules.join(ante, "antecedent")
        .join(cons, "consequent")
        .where(conf >= F.lit(min_confidence))
        .select(
            "antecedent",
            "consequent",
            F.col("_c_full").cast("long").alias("support_count"),
            conf.alias("confidence"),
            (conf / (F.col("_c_cons") / F.lit(float(n)))).alias("lift"),
            (F.col("_c_full") / F.lit(float(n))).alias("support"),
        )
    )


def model_rules(tx: DataFrame, min_count: int, min_confidence: float, n: int | None = None) -> DataFrame:
    """A10 through Spark ML: FPGrowthModel.associationRules."""
    n = tx.count() if n is None else n
    fp = FPGrowth(itemsCol="items", minSupport=(min_count - 0.5) / n, minConfidence=min_confidence)
    return fp.fit(tx.select(F.array_distinct("items").alias("items"))).associationRules

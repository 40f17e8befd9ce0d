"""Plan-shape checks: the properties the design relies on at scale."""

import contextlib
import io

import numpy as np
from pyspark.sql import functions as F

from sparkmine import session
from sparkmine.operators import clustering as CL
from sparkmine.operators import itemsets as IS
from sparkmine.operators import joins as J
from sparkmine.plans.catalog import brand_baskets
from sparkmine.session import cut_lineage_sized

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_basket_scan_is_pruned_and_pre_aggregated(spark):
    p = plan(brand_baskets(spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in p
    assert "partial_collect_set" in p


def test_sample_is_a_filter_on_the_scan(spark):
    pts = spark.range(1000).select(F.col("id").alias("point_id"))
    p = plan(CL.sample_exact(pts, 10, 1, 0, "point_id", n=1000))
    assert "Sort" not in p and "Exchange" not in p and "TakeOrdered" not in p


def test_a_round_reads_only_its_own_part(spark):
    pts = spark.range(500).select(F.col("id").alias("point_id"), F.array(F.col("id").cast("double")).alias("features"))
    rounds = CL._batches(pts, 20, 3, 6, "point_id", 500)
    assert {r["it"]: r["count"] for r in rounds.groupBy("it").count().collect()} == dict.fromkeys(range(6), 20)
    for it in (0, 5):
        want = {r["point_id"] for r in CL.sample_exact(pts, 20, 3, it, n=500).collect()}
        assert {r["point_id"] for r in rounds.where(F.col("it") == it).collect()} == want
    p = plan(rounds.where(F.col("it") == 2))
    assert "PartitionFilters: [isnotnull(it" in p and "(it#" in p


def test_probe_broadcasts_by_measured_bytes(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "n long, item string")
    table, n, size = cut_lineage_sized(spark.createDataFrame([("a" * 1000,), ("b",)], "item string"))
    assert n == 2 and size > 1000
    assert "BroadcastHashJoin" in plan(J.probe(rows, table, ["item"], size))
    assert "SortMergeJoin" in plan(J.probe(rows, table, ["item"], 65 * 2**20))


def test_probe_broadcasts_only_hot_keys_of_a_large_table(spark):
    """A third of the rows has one key: it is broadcast, the others are shuffled by the whole key."""
    rows = spark.range(900).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("b"), (F.col("id") % 7).alias("item"), "id")
    table = rows.groupBy("b", "item").agg(F.count(F.lit(1)).alias("support_count")).where("item < 5").withColumn("node", F.col("b") * 10 + F.col("item"))
    small = J.probe(rows, table, ["b", "item"], 0, 900)
    large = J.probe(rows, table, ["b", "item"], 2**40, 900)
    order = ["b", "item", "id", "node"]
    assert sorted(map(tuple, small.select(order).collect())) == sorted(map(tuple, large.select(order).collect()))
    p = plan(large)
    assert "SortMergeJoin" in p and "BroadcastHashJoin" in p


def test_miner_joins_on_group_and_item(spark, tiny, monkeypatch):
    """No join of the miner is on the bucket alone, whatever the size of its tables."""
    made = []
    inner = J.probe
    monkeypatch.setattr(IS, "probe", lambda rows, table, on, *a, **k: made.append(on) or inner(rows, table, on, *a, **k))
    for limit in (2**26, 0):
        monkeypatch.setattr(session, "BROADCAST_LIMIT_BYTES", limit)
        IS.son_local(IS.with_bucket(tiny, 3), 2).itemsets.collect()
    assert ["bucket", "item"] in made and ["bucket"] not in made
    assert all(len(on) == 2 for on in made)


def test_pairs_are_formed_block_by_block(spark):
    df = spark.createDataFrame([("x", i) for i in range(57)] + [("y", 1), ("y", 2), (None, 5), (None, 6)], "g string, v long")
    pairs = J.ordered_pairs(df, "v", ["g"], block=10)
    want = {("x", a, b) for a in range(57) for b in range(a + 1, 57)} | {("y", 1, 2), (None, 5, 6)}
    got = [tuple(r) for r in pairs.collect()]
    assert len(got) == len(want) and set(got) == want
    p = plan(pairs)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    one = J.ordered_pairs(df.where("g = 'x'").drop("g"), "v", block=7)
    assert {tuple(r) for r in one.collect()} == {(a, b) for a in range(57) for b in range(a + 1, 57)}


def test_assignment_is_one_arrow_udf(spark):
    pts = spark.createDataFrame([(0, [0.0, 1.0])], "point_id long, features array<double>")
    p = plan(CL.assign_nearest(pts, (np.arange(2), np.zeros((2, 2)))))
    assert "ArrowEvalPython" in p and "Exchange" not in p

import os
import tempfile

from sparkmine.plans.experiments import SweepRow, default_grid, run_sweep
from sparkmine.sources import write_results
from sparkmine.streaming import stream_frequency_table, stream_item_support


def test_default_grid_has_37_runs():
    grid = default_grid("mushroom")
    assert len(grid) == 37
    assert sum(1 for r in grid if r.pad_target is not None and r.restrict_items == 80) == 7


def test_run_sweep(spark, tiny):
    grid = [SweepRow(2 / 9, 3), SweepRow(2 / 9, 2, fraction=0.7), SweepRow(2 / 9, 2, pad_target=3, restrict_items=3)]
    runs, cands = run_sweep(tiny, grid, seed=1)
    r = {x["run_id"]: x for x in runs.collect()}
    assert (r[0]["n"], r[0]["distinct_items"], r[0]["local_min"], r[0]["n_itemsets"]) == (9, 5, 1, 13)
    assert r[1]["n"] == 6
    assert r[2]["distinct_items"] <= 3
    k1 = {x["run_id"]: x["n_candidates"] for x in cands.collect() if x["k"] == 1}
    assert set(k1) == {0, 1, 2}
    out = os.path.join(tempfile.mkdtemp(prefix="sm-k2-"), "runs")
    write_results(runs, out)
    assert len(os.listdir(out)) > 0


def test_streaming_counts(spark, tiny):
    d = tempfile.mkdtemp(prefix="sm-stream-")
    tiny.write.mode("overwrite").parquet(d + "/tx")
    stream = spark.readStream.schema(tiny.schema).parquet(d + "/tx")
    q = stream_item_support(stream).writeStream.outputMode("complete").format("memory").queryName("sm_items").start()
    q.processAllAvailable()
    q.stop()
    got = {r["item"]: r["support_count"] for r in spark.sql("SELECT * FROM sm_items").collect()}
    assert got == {1: 6, 2: 7, 3: 6, 4: 2, 5: 2}
    q2 = stream_frequency_table(stream, "txn_id").writeStream.outputMode("complete").format("memory").queryName("sm_ft").start()
    q2.processAllAvailable()
    q2.stop()
    assert spark.sql("SELECT sum(n) AS s FROM sm_ft").first()["s"] == 9

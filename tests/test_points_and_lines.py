"""Points beyond the broadcast bound, bad vectors, exact samples, numbered lines, F6 on keys."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmine.operators import clustering as CL
from sparkmine.operators import transform as TR
from sparkmine.sources import read_transactions


@pytest.mark.parametrize("method", ["arrow", "native"])
def test_blocks_of_centres_equal_brute_force(spark, method):
    rng = np.random.default_rng(1)
    x, c = rng.normal(size=(200, 3)).round(1), rng.normal(size=(37, 3)).round(1)
    c[20] = c[3]  # ties go to the lower cluster
    pts = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "point_id long, features array<double>")
    d = ((x[:, None, :] - c[None]) ** 2).sum(-1)
    want = {i: (int(d[i].argmin()), round(float(np.sqrt(d[i].min())), 9)) for i in range(len(x))}
    for block in (None, 8 * 3 * 4, 1):
        out = CL.assign_nearest(pts, CL.centers_frame(spark, c), method=method, block_bytes=block) if block != 1 or method == "arrow" else None
        if out is not None:
            assert {r["point_id"]: (r["cluster"], round(r["dist"], 9)) for r in out.collect()} == want


@pytest.mark.parametrize("method", ["arrow", "native"])
@pytest.mark.parametrize("bad", [None, [1.0], [1.0, float("nan")], [1.0, 2.0, 3.0]])
def test_bad_vectors_raise(spark, method, bad):
    pts = spark.createDataFrame([(0, [0.0, 1.0]), (1, bad)], "point_id long, features array<double>")
    with pytest.raises(Exception, match="feature vector"):
        CL.assign_nearest(pts, np.zeros((2, 2)), method=method).collect()


def test_no_points_and_no_centres(spark):
    pts = spark.createDataFrame([], "point_id long, features array<double>")
    assert CL.assign_nearest(pts, np.zeros((2, 2))).count() == 0
    some = spark.createDataFrame([(0, [1.0])], "point_id long, features array<double>")
    assert CL.assign_nearest(some, CL.centers_frame(spark, np.zeros((0, 1)))).head()["cluster"] is None


def test_selection_narrows_to_the_exact_key(spark, monkeypatch):
    """Tiny ranges: several steps of counting; a low first bound: a second scan."""
    monkeypatch.setattr(CL, "_LEFT", 2)
    monkeypatch.setattr(CL, "_RANGES", 4)
    pts = spark.range(400).select(F.col("id").alias("point_id"))
    keys = {it: sorted((r["h"], r["point_id"]) for r in pts.select("point_id", CL._sample_key(5, F.lit(it), "point_id")["h"].alias("h")).collect()) for it in (0, 1, 2)}
    for b, n in ((1, 400), (150, 400), (400, 400), (40, 4000)):
        cut = CL.batch_cutoffs(pts, b, 5, 3, "point_id", n)
        assert cut == {it: keys[it][b - 1] for it in keys}


def test_input_scans_do_not_grow_with_rounds(spark, monkeypatch):
    """The points are filtered by key once for the cutoffs and once for all samples."""
    pts = spark.range(300).select(F.col("id").alias("point_id"), F.array(F.col("id").cast("double")).alias("features"))
    calls = []
    inner = CL._sample_key
    monkeypatch.setattr(CL, "_sample_key", lambda *a: calls.append(1) or inner(*a))
    init = CL.centers_frame(spark, np.array([[1.0], [200.0]]))
    CL.minibatch_kmeans(pts, 2, 20, max_iter=2, init=init)
    two = len(calls)
    calls.clear()
    CL.minibatch_kmeans(pts, 2, 20, max_iter=6, init=init)
    assert len(calls) == two


def test_seeding_equals_brute_force_for_any_state_interval(spark, monkeypatch):
    """The picks do not depend on how often the state is written, and the vectors are written once."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(60, 2)).round(1)
    pts = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "point_id long, features array<double>")
    key = lambda step, w: -np.log((h[step] + 0.5) / 2**52) / w if w > 0 else np.inf
    picks = []
    for step in range(9):
        h = {step: None}
        hs = {r["point_id"]: r["h"] for r in pts.select("point_id", CL.seeded_hash(4, F.lit(CL.TAG_SEED), F.lit(step), F.col("point_id")).alias("h")).collect()}
        if step == 0:
            picks.append(min(hs, key=lambda i: (hs[i], i)))
            continue
        best = {}
        for i in hs:
            if i not in picks:
                h[step] = hs[i]
                best[i] = key(step, min(np.sqrt(((x[i] - x[j]) ** 2).sum()) for j in picks))
        picks.append(min(best, key=lambda i: (best[i], i)))
    written, inner = [], CL.cut_lineage
    monkeypatch.setattr(CL, "cut_lineage", lambda df: written.append(df.columns) or inner(df))
    for every in (1, 4, 100):
        written.clear()
        assert CL.kmeanspp(pts, 9, seed=4, cut_every=every)[1] == picks
        assert sum("features" in c for c in written) == 1


def test_line_numbers_rest_on_one_scan(spark, tmp_path):
    """Other split sizes when the numbered lines are read again."""
    for f in range(2):
        (tmp_path / f"part{f}.txt").write_text("".join(f"{f} {i}\n" for i in range(5000)))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "4096")
        tx = read_transactions(spark, str(tmp_path))
        spark.conf.set(key, "50000")
        got = tx.orderBy("txn_id").collect()
        spark.conf.set(key, "1000")
        again = tx.orderBy("txn_id").collect()
    finally:
        spark.conf.set(key, before)
    assert [r["txn_id"] for r in got] == list(range(10000)) and got == again
    assert [r["items"] for r in got] == [sorted({f, i}) for f in range(2) for i in range(5000)]


def test_fraction_by_keys(spark):
    rows = [(i % 7, i, "x") for i in range(70)]
    df = spark.createDataFrame(rows, "txn_id long, part long, note string").repartition(4)
    got = TR.take_fraction(df, 0.33, ("txn_id", "part"))
    assert sorted(tuple(r) for r in got.collect()) == sorted(rows)[: int(70 * 0.33)] and got.columns == df.columns
    # ties at the cut: the count is exact, the lower keys are all there
    tied = [r[0] for r in TR.take_fraction(df, 0.33, ("txn_id",)).collect()]
    assert sorted(tied) == sorted(r[0] for r in rows)[:23]
    assert TR.take_fraction(df, 0.0).count() == 0 and TR.take_fraction(df, 1.0).count() == 70


import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmine.operators import clustering as CL
from sparkmine.operators import evaluate as EV
from sparkmine.operators import series as SE


@pytest.fixture(scope="module")
def four(spark):
    return spark.createDataFrame(
        [(0, [0.0, 0.0], "a"), (1, [0.0, 1.0], "a"), (2, [10.0, 10.0], "b"), (3, [10.0, 11.0], "b")],
        "point_id long, features array<float>, label string",
    )


@pytest.fixture(scope="module")
def start(spark):
    return CL.centers_frame(spark, np.array([[0.0, 0.0], [10.0, 10.0]]))


@pytest.mark.parametrize("method", ["arrow", "native"])
def test_assign_and_update(four, start, method):
    assigned = CL.assign_nearest(four, start, method=method)
    assert [r["cluster"] for r in assigned.orderBy("point_id").collect()] == [0, 0, 1, 1]
    c1 = CL.update_centers(assigned, start)
    got = {r["cluster"]: (r["center"], r["n"]) for r in c1.collect()}
    assert got == {0: ([0.0, 0.5], 2), 1: ([10.0, 10.5], 2)}
    c2 = CL.update_centers(CL.assign_nearest(four, c1, method=method), c1)
    assert {r["cluster"]: (r["center"], r["n"]) for r in c2.collect()} == {0: ([0.0, 0.5], 4), 1: ([10.0, 10.5], 4)}
    assert CL.sse(four, c1, method=method).first()["sse"] == pytest.approx(1.0)


@pytest.mark.parametrize("method", ["arrow", "native"])
def test_tie_goes_to_lowest_index(spark, method):
    pts = spark.createDataFrame([(0, [0.0, 0.0])], "point_id long, features array<float>")
    centers = CL.centers_frame(spark, np.array([[-1.0, 0.0], [1.0, 0.0]]))
    assert CL.assign_nearest(pts, centers, method=method).first()["cluster"] == 0


def test_update_equals_sequential_rule(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 3))
    c0 = rng.normal(size=(4, 3))
    n0 = np.array([0, 3, 1, 0])
    pts = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "point_id long, features array<double>")
    centers = CL.centers_frame(spark, c0, n0)
    assigned = CL.assign_nearest(pts, centers)
    lab = {r["point_id"]: r["cluster"] for r in assigned.collect()}
    seq, cnt = c0.copy(), n0.copy()
    for i in range(len(x)):
        j = lab[i]
        cnt[j] += 1
        seq[j] = (1 - 1 / cnt[j]) * seq[j] + (1 / cnt[j]) * x[i]
    got = {r["cluster"]: (np.array(r["center"]), r["n"]) for r in CL.update_centers(assigned, centers).collect()}
    for j in range(4):
        assert np.allclose(got[j][0], seq[j], atol=1e-12) and got[j][1] == cnt[j]


def test_nmi_and_entropy(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 1), (1, 1)], "label int, cluster int")
    assert EV.nmi(df, "label", "cluster").first()["nmi"] == pytest.approx(1.0)
    df2 = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (1, 1)], "label int, cluster int")
    assert EV.nmi(df2, "label", "cluster").first()["nmi"] == pytest.approx(0.0, abs=1e-12)
    df3 = spark.createDataFrame([(0, 0), (0, 0)], "label int, cluster int")
    assert EV.nmi(df3, "label", "cluster").first()["nmi"] is None
    assert EV.entropy(df2, "label").first()["entropy"] == pytest.approx(1.0)
    r = EV.nmi(df, "label", "cluster").first()
    s = EV.nmi(df.select(F.col("cluster").alias("label"), F.col("label").alias("cluster")), "label", "cluster").first()
    assert r["nmi"] == pytest.approx(s["nmi"])


def test_contingency_and_frequency(spark):
    df = spark.createDataFrame([("x", "p"), ("x", "q"), ("y", "p")], "a string, b string")
    got = {(r["a"], r["b"], r["gid"]): r["n"] for r in EV.contingency(df, "a", "b").collect()}
    assert got[("x", "p", 0)] == 1 and got[("x", None, 1)] == 2 and got[(None, "p", 2)] == 2 and got[(None, None, 3)] == 3
    ft = {r["value"]: (r["n"], r["share"]) for r in EV.frequency_table(df, "a").collect()}
    assert ft["x"] == (2, pytest.approx(2 / 3))


def test_sampling_and_seeding(spark, four):
    s = CL.sample_exact(four, 3, seed=1, iteration=0)
    ids = [r["point_id"] for r in s.collect()]
    assert len(set(ids)) == 3
    assert ids == [r["point_id"] for r in CL.sample_exact(four.repartition(3), 3, seed=1, iteration=0).collect()]
    with pytest.raises(ValueError):
        CL.sample_exact(four, 5, seed=1, iteration=0)
    centers, chosen = CL.kmeanspp(four, 2, seed=4)
    assert len(set(chosen)) == 2
    # the second pick lies in the other blob (weights of the first blob are ~1, of the other ~14)
    assert centers.count() == 2
    with pytest.raises(ValueError):
        CL.kmeanspp(four, 5, seed=4)


def test_minibatch_kmeans(spark):
    rng = np.random.default_rng(1)
    blobs = np.vstack([rng.normal(loc=c, scale=0.2, size=(30, 2)) for c in ([0, 0], [5, 5], [0, 5])])
    pts = spark.createDataFrame([(i, [float(v) for v in row], i // 30) for i, row in enumerate(blobs)], "point_id long, features array<double>, label int")
    centers, assigned = CL.minibatch_kmeans(pts, 3, 20, max_iter=5, seed=2)
    assert sum(r["n"] for r in centers.collect()) == 100
    assert EV.nmi(assigned, "label", "cluster").first()["nmi"] > 0.9


def test_histogram_fixture(spark):
    df = spark.createDataFrame([(v,) for v in (-3.0, -1.5, 0.0, 3.0, 7.0)], "v double")
    rows = SE.histogram_density(df, "v", 4, -3.0, 3.0).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [1, 1, 1, 1]
    assert [r["center"] for r in rows] == pytest.approx([-2.25, -0.75, 0.75, 2.25])
    assert [r["density"] for r in rows] == pytest.approx([1 / 6] * 4)


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(5)
    vals = np.concatenate([rng.normal(size=3000), np.linspace(-3, 3, 61)])
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    rows = SE.histogram_density(df, "v", 37, -3.0, 3.0).orderBy("bin").collect()
    dens, edges = np.histogram(vals, bins=37, range=(-3, 3), density=True)
    counts, _ = np.histogram(vals, bins=37, range=(-3, 3))
    assert [r["n"] for r in rows] == list(counts)
    assert np.allclose([r["density"] for r in rows], dens, rtol=1e-12)
    assert np.allclose([r["center"] for r in rows], (edges[:-1] + edges[1:]) / 2)
    assert sum(r["density"] * (6.0 / 37) for r in rows) == pytest.approx(1.0)


def test_gaussian_smooth(spark):
    w = SE.gaussian_kernel(2.0)
    assert len(w) == 17
    half = [0.199475, 0.176036, 0.120987, 0.064760, 0.026996, 0.008764, 0.002216, 0.000436, 0.000067]
    assert w[8:] == pytest.approx(half, abs=1e-6)
    const = spark.createDataFrame([(i, 3.0) for i in range(20)], "p long, v double")
    assert all(r["v"] == pytest.approx(3.0) for r in SE.gaussian_smooth(const, "p", "v", 2.0).collect())
    rng = np.random.default_rng(2)
    x = rng.random(12)
    ser = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "p long, v double")
    out = {r["p"]: r["v"] for r in SE.gaussian_smooth(ser, "p", "v", 2.0).collect()}
    assert sum(out.values()) == pytest.approx(x.sum())
    # reference implementation of mode 'reflect' (x[-1] = x[0]) with the same kernel
    n = len(x)

    def refl(q):
        m = q % (2 * n)
        return m if m < n else 2 * n - 1 - m

    want = [sum(w[j + 8] * x[refl(i + j)] for j in range(-8, 9)) for i in range(n)]
    assert [out[i] for i in range(n)] == pytest.approx(want)


def test_ordinal_gap(spark):
    df = spark.createDataFrame([("g", v, i) for i, v in enumerate([5.0, 1.0, 4.0, 9.0])] + [("h", 2.0, 9)], "grp string, v double, id long")
    got = {r["grp"]: r["gap"] for r in SE.ordinal_gap(df, "grp", "v", 2, "id").collect()}
    assert got == {"g": 1.0}
    mid = {r["grp"]: (r["n"], r["gap"]) for r in SE.ordinal_gap(df, "grp", "v", "mid", "id").collect()}
    assert mid == {"g": (2, 1.0)}


def test_batch_cutoffs_equal_exact_samples(spark):
    pts = spark.range(300).select(F.col("id").alias("point_id"))
    for b in (7, 290):  # 290 of 300: the 2x threshold cannot hold b keys, so the exact fallback runs
        cut = CL.batch_cutoffs(pts, b, seed=9, iterations=4, id_col="point_id", n=300)
        for it in range(4):
            want = sorted(r["point_id"] for r in CL.sample_exact(pts, b, 9, it, "point_id", n=300).collect())
            key = CL._sample_key(9, F.lit(it), "point_id")
            got = sorted(
                r["point_id"]
                for r in pts.where(key <= F.struct(F.lit(cut[it][0]).alias("h"), F.lit(cut[it][1]).cast("long").alias("id"))).collect()
            )
            assert got == want and len(got) == b


def test_series_validation(spark):
    df = spark.createDataFrame([(0, 1.0), (2, 1.0)], "p long, v double")
    with pytest.raises(ValueError):
        SE.gaussian_smooth(df, "p", "v", 2.0)
    with pytest.raises(ValueError):
        SE.histogram_density(df, "v", 4, 1.0, 1.0)

import pytest
from pyspark.errors import PySparkException

from sparkmine.operators import clustering as CL
from sparkmine.operators import evaluate as EV
from sparkmine.operators import series as SE
from sparkmine.sources import baskets, with_group_rank


def test_null_transactions_and_items_are_rejected(spark):
    for rows in ([(1, 1), (1, None)], [(None, 2), (1, 1)]):
        with pytest.raises(PySparkException, match="null in column"):
            baskets(spark.createDataFrame(rows, "t long, i long"), "t", "i").collect()


def test_null_groups_are_kept(spark):
    df = spark.createDataFrame([("a", 1), (None, 5), ("a", 4), (None, 2), (None, 9)], "g string, v int")
    got = sorted((str(r["g"]), r["v"], r["idx"]) for r in with_group_rank(df, ["v"], ["g"], "idx").collect())
    assert got == [("None", 2, 0), ("None", 5, 1), ("None", 9, 2), ("a", 1, 0), ("a", 4, 1)]
    gap = {r["g"]: r["gap"] for r in SE.ordinal_gap(df, "g", "v").collect()}
    assert gap == {None: 3, "a": 3}


def test_null_labels_count_as_a_value(spark):
    df = spark.createDataFrame([("x", 0), ("x", 0), (None, 1), ("y", 2)], "l string, c int")
    assert EV.nmi(df, "l", "c").head()["nmi"] == pytest.approx(1.0)
    one = spark.createDataFrame([("x", 0), ("x", 0)], "l string, c int")
    assert EV.nmi(one, "l", "c").head()["nmi"] is None


def test_nmi_reads_its_input_once(spark, tmp_path):
    spark.createDataFrame([("x", 0), ("y", 1)], "l string, c int").write.parquet(str(tmp_path / "t"))
    plan = EV.nmi(spark.read.parquet(str(tmp_path / "t")), "l", "c")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_equal_points_give_distinct_centres(spark):
    pts = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(5)], "point_id long, features array<double>")
    assert len(set(CL.kmeanspp(pts, 3)[1])) == 3


def test_repeated_ids_are_rejected_by_exact_samples(spark):
    pts = spark.createDataFrame([(1,), (1,), (1,)], "point_id long")
    with pytest.raises(ValueError, match="not unique"):
        CL.sample_exact(pts, 2, 0, 0)

"""Null, default and repeated ids: draws, training rows and the pipeline's second stage."""

import random

import duckdb
import pytest

import corpus_pipeline as P
from sparkmine.llm import mixing as M
from sparkmine.llm import toxicity as T

R = random.Random(4)
VOCAB = [f"v{i}" for i in range(2000)]


def text(n):
    return " ".join(R.choice(VOCAB) for _ in range(n))


@pytest.mark.parametrize("ids", [lambda i: None, lambda i: 0, lambda i: i % 5])
def test_mix_meets_its_targets_whatever_the_ids(spark, tmp_path, ids):
    rows = [(ids(i), text(R.choice([20, 40])), R.choice("aabcccccd")) for i in range(3000)] + [(None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    out = M.op9_mixing(spark, str(tmp_path)).collect()
    taken, target, size = {}, {}, {}
    for r in out:
        key = r["source_size"]
        taken[key] = taken.get(key, 0) + r["taken"]
        target[key] = r["target"]
        assert r["taken"] <= 2 * r["size"]
    for key in taken:
        assert taken[key] == pytest.approx(target[key], rel=0.07)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(con.execute(M.OP9_SQL).fetchall(), key=str) == sorted(map(tuple, out), key=str)


def test_training_rows_have_a_bound(spark, monkeypatch):
    fitted = []
    monkeypatch.setattr(T, "fit", lambda rows, labels: fitted.append((len(rows), labels.tolist())))
    ids = [r[0] for r in spark.range(200).where(~T.held_out(T.F.col("id"))).collect()]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    docs = spark.createDataFrame([(ids[0], f"text {i} of one id") for i in range(5000)] + [(ids[1], "the same row")] * 3000 + [(ids[2], None), (ids[3], "")], "doc_id long, text string")
    T.train(docs, labels, max_train=10)
    T.train(docs.where(T.F.col("doc_id") != ids[0]), labels, max_train=10)
    T.train(docs.repartition(7), labels, max_train=400)
    # every label among the first ten by hash, or the rows of all of them
    assert fitted[0][0] <= 10 and fitted[1][0] <= 3 and 300 <= fitted[2][0] <= 400


def test_second_stage_keeps_texts_that_share_an_id(spark, tmp_path):
    a, b, c = text(60), text(60), text(80)
    rows = [(7, a, 1, "x"), (7, b, 2, "x"), (7, c, 3, "x"), (3, c + " more", 4, "x"), (3, b, 5, "y"), (9, a, 6, "x"), (9, a, 6, "x"), (None, a, 7, "x"), (None, a, 7, "x"), (8, None, 8, "x"), (8, "", 9, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _stays long, number string").repartition(3)
    out = P.near_duplicate_stage(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    assert sorted(r["_stays"] for r in out.collect()) == [1, 4, 5, 7, 7, 8, 9]

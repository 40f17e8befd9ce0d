from collections import Counter

import pytest

from sparkmine.llm import token_counts as C
from sparkmine.llm import tokenfiles as TF

ROWS = [(i, "ananas " * (i % 37)) for i in range(400)] + [(None, "no id"), (7, None)]
SIZE = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def folder(spark, tmp_path):
    # small row groups, so that the splits can fall inside a file
    out = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3).write
    out.option("parquet.block.size", 256).option("parquet.page.size.row.check.min", 1).option("parquet.block.size.row.check.min", 1).parquet(f"{tmp_path}/d")
    keep = spark.conf.get(SIZE)
    yield f"{tmp_path}/d"
    spark.conf.set(SIZE, keep)


def want():
    encode = TF.bpe().encode_ordinary
    return Counter((d, len(encode(t or ""))) for d, t in ROWS)


def test_splits_that_change_between_the_scans(spark, folder, monkeypatch):
    write = TF.write_flat

    def write_then_change(*a, **k):
        write(*a, **k)
        spark.conf.set(SIZE, "300")

    monkeypatch.setattr(C.TF, "write_flat", write_then_change)
    df = spark.read.parquet(folder)
    assert Counter(tuple(r) for r in C.document_token_counts(df).collect()) == want()


def test_a_table_without_file_places(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert Counter(tuple(r) for r in C.document_token_counts(df).collect()) == want()


def test_lost_counts_raise(spark, folder, monkeypatch):
    scan = C.token_counts
    monkeypatch.setattr(C, "token_counts", lambda *a, **k: scan(*a, **k).where("ordinal > 0"))
    with pytest.raises(RuntimeError, match="documents and"):
        C.document_token_counts(spark.read.parquet(folder))

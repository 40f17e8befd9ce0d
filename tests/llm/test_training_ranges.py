import glob
import os

import pytest

from sparkmine.llm import tokenfiles as TF
from sparkmine.llm import training_order as O

ROWS = [(i, "Ein Text " * (i % 40) + str(i)) for i in range(200)] + [(None, "no id"), (300, None), (301, ""), (5, "Ein Text again"), (5, "Ein Text again"), (302, "w " * 20_000)]


def shards(path):
    found = {}
    for f in glob.glob(f"{path}/shard=*/part-*"):
        with open(f, "rb") as h:
            found[f.split("shard=")[1].split("/")[0]] = h.read()
    assert len(found) == len(glob.glob(f"{path}/shard=*"))
    return found


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3, "doc_id")


def test_the_number_of_ranges_changes_no_byte(spark, docs, tmp_path):
    written = {}
    for ranges in (1, 3, 1000):
        path = str(tmp_path / str(ranges))
        total = O.write_training_order(docs, path, length=16, shard_slots=50, tokenizer=TF.TOKENIZER, ranges=ranges)
        written[ranges] = shards(path)
        assert sum(map(len, written[ranges].values())) == total * O.record_type(16).itemsize
        assert len(written[ranges]) == -(-total // 50)
    assert written[1] == written[3] == written[1000]


def test_the_token_table_goes_and_the_setting_stays(spark, docs, tmp_path):
    root = spark.sparkContext.getCheckpointDir()
    tables = set(glob.glob(f"{root.removeprefix('file:')}/sparkmine-tables/*")) if root else set()
    before = spark.conf.get(O.SHUFFLE_CLEANUP)
    O.write_training_order(docs, str(tmp_path / "o"), length=16, shard_slots=50)
    root = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    assert set(glob.glob(f"{root}/sparkmine-tables/*")) <= tables and os.path.isdir(f"{root}/sparkmine-tables")
    assert spark.conf.get(O.SHUFFLE_CLEANUP) == before


def test_an_existing_folder_is_not_touched(spark, docs, tmp_path):
    with pytest.raises(FileExistsError):
        O.write_training_order(docs, str(tmp_path), length=16)
    assert not os.listdir(tmp_path)


def test_other_columns_of_any_name(spark, docs, tmp_path):
    from pyspark.sql import functions as F

    more = docs.select("*", F.lit(1).alias("part"), F.lit(2).alias("SLOT"), F.lit(3).alias("tokens"), F.lit(4).alias("shard"))
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    assert O.write_training_order(docs, a, length=16, shard_slots=50) == O.write_training_order(more, b, length=16, shard_slots=50)
    assert shards(a) == shards(b)

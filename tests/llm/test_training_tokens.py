import glob
import os
import re
from collections import Counter, defaultdict

import numpy as np

from sparkmine.llm import tokenfiles as TF
from sparkmine.llm import training_order as O

TEXTS = {i: f"Text {i}:\n  " + "the ananas é ñandú 12.5 <x>\t" * (i % 50) for i in range(120)} | {500: "w " * 9_000, 501: " \n", 502: "猫 und 🐈"}


def decoded(path, length, shard_slots):
    """doc_id -> text, from the flat files only; and the slots."""
    kind, parts, slots = O.record_type(length), defaultdict(dict), []
    for f in glob.glob(f"{path}/shard=*/part-*"):
        rec = np.fromfile(f, kind)
        slots += (int(re.search(r"shard=(\d+)", f)[1]) * shard_slots + np.arange(len(rec))).tolist()
        for r in rec:
            parts[int(r["doc_id"])][int(r["seq"])] = r["tokens"][: r["n"]].tolist()
    return {d: TF.bpe().decode([x for s in sorted(p) for x in p[s]]) for d, p in parts.items()}, sorted(slots)


def test_shards_decode_to_the_texts(spark, tmp_path):
    df = spark.createDataFrame([*TEXTS.items(), (900, ""), (901, None)], "doc_id long, text string").repartition(3)
    total = O.write_training_order(df, str(tmp_path / "o"), length=16, shard_slots=100, tokenizer=TF.TOKENIZER)
    got, slots = decoded(str(tmp_path / "o"), 16, 100)
    assert got == TEXTS and slots == list(range(total))


def test_query_writes_the_tokenizers_ids(spark, tmp_path, monkeypatch):
    spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(O, "ensure_checkpoint_dir", lambda s: str(tmp_path))
    rows = O.op4_training_order(spark, str(tmp_path)).collect()
    got, _ = decoded(glob.glob(f"{tmp_path}/training-order/*")[0], O.LENGTH, O.SHARD_SLOTS)
    assert got == TEXTS and Counter(r["doc_id"] for r in rows).keys() == TEXTS.keys()
    assert not os.path.exists(f"{tmp_path}/shard=0")


def test_the_table_is_scanned_once(spark, tmp_path):
    """Splits that change between two scans cannot move a sequence: there is one scan."""
    spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/d.parquet")
    scans = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            scans.add(batch.num_rows)
            yield batch

    df = spark.read.parquet(f"{tmp_path}/d.parquet").mapInArrow(count, "doc_id long, text string")
    total = O.write_training_order(df, str(tmp_path / "o"), length=16, shard_slots=100, tokenizer=TF.TOKENIZER)
    got, slots = decoded(str(tmp_path / "o"), 16, 100)
    assert scans.value == len(TEXTS) and got == TEXTS and slots == list(range(total))

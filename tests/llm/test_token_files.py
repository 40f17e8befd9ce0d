import hashlib
import random
import struct
from collections import Counter

import numpy as np
import pytest

from sparkmine.llm import token_counts as C
from sparkmine.llm import tokenfiles as TF
from sparkmine.llm import training_order as O

R = random.Random(11)


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    rows = [(i, " ".join(R.choice(["the", "ananas", "é", "\n", "<x>", "12"]) for _ in range(R.choice([0, 1, 40, 900])))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, " \n"), (None, "no id here"), (5, "same id other text"), (1003, "w " * 30_000), (1004, "w"), (1004, "w")]
    path = str(tmp_path_factory.mktemp("tok"))
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_tokens int").repartition(3).write.parquet(f"{path}/documents.parquet")
    return spark.read.parquet(f"{path}/documents.parquet"), rows, path


@pytest.mark.parametrize("block", [1, 3, 7, 1 << 20])
def test_scan_of_any_block_size(spark, tmp_path, block):
    want = {}
    for f in range(4):
        body, n = [], 0
        for _ in range(R.randrange(0, 30)):
            k = R.choice([0, 0, 1, 5, 40])
            body += [R.randrange(100) for _ in range(k)] + [500]
            want[(f, n)] = k
            n += 1
        if f == 2:
            body += [1, 2, 3]
            want[(f, n)] = 3
        (tmp_path / f"part-{f}").write_bytes(struct.pack(f"<{len(body)}H", *body))
    got = {(int(r["file"][-1]), r["ordinal"]): r["n_tokens"] for r in C.token_counts(spark, str(tmp_path), 500, "uint16", block).collect()}
    assert got == want


def test_counts_equal_the_tokenizer(spark, docs, monkeypatch):
    df, rows, path = docs
    monkeypatch.setattr(C, "DOCS_PER_FILE", 17)
    encode = TF.bpe().encode_ordinary
    got = Counter(tuple(r) for r in C.op7_token_counts(spark, path).collect())
    assert got == Counter((d, len(encode(t or ""))) for d, t in rows)
    assert C.document_token_counts(spark.read.parquet(f"{path}/documents.parquet").limit(0)).count() == 0


def test_permutation_is_a_keyed_bijection():
    for n in (1, 2, 3, 5, 100, 1023, 1025, 70_000):
        s = O.slot_of(np.arange(n), n)
        assert np.array_equal(np.sort(s), np.arange(n))
        assert np.array_equal(O.index_of(s, n), np.arange(n))
    a, b = O.slot_of(np.arange(1000), 1000, 1), O.slot_of(np.arange(1000), 1000, 2)
    assert (a == b).mean() < 0.05 and abs(np.corrcoef(a, np.arange(1000))[0, 1]) < 0.15


def test_round_trip_of_the_shards(spark, docs, tmp_path):
    df, rows, _ = docs
    path = str(tmp_path / "o")
    total = O.write_training_order(df, path, length=16, shard_slots=100)
    got = O.read_training_order(spark, path, length=16, shard_slots=100).collect()
    assert sorted(r["slot"] for r in got) == list(range(total))
    assert all(r["slot"] == r["shard"] * 100 + r["position"] for r in got)
    import pyarrow as pa

    want = Counter()
    for d, t in rows:
        (ids,) = TF.word_ids(pa.array([t], pa.string()), O.VOCABULARY)
        for s in range(0, len(ids), 16):
            part = ids[s : s + 16].astype("<u2")
            want[(-1 if d is None else d, s // 16, len(part), hashlib.sha256(part.tobytes()).hexdigest())] += 1
    assert Counter((r["doc_id"], r["seq"], r["n_tokens"], r["tokens_sha256"]) for r in got) == want
    size = O.record_type(16).itemsize
    import glob
    import os

    for f in glob.glob(f"{path}/shard=*/part-*"):
        assert os.path.getsize(f) % size == 0
    assert len(glob.glob(f"{path}/shard=*")) == -(-total // 100) == len(glob.glob(f"{path}/shard=*/part-*"))


def test_order_of_an_empty_table(spark, docs, tmp_path):
    df, _, _ = docs
    assert O.write_training_order(df.limit(0), str(tmp_path / "e")) == 0

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from sparkmine.llm import decontaminate as D
from sparkmine.llm import textkernel as K
from sparkmine.llm import toxicity as T

R = random.Random(7)
VOCAB = [f"v{i}" for i in range(3000)]


def prose(n):
    return [R.choice(VOCAB) for _ in range(n)]


ITEMS = [(i, " ".join(prose(n))) for i, n in enumerate([15, 24, 40, 40, 60, 60])] + [(90, "too short item"), (91, None), (92, "")]


def rows():
    out = [(i, " ".join(prose(R.choice([3, 80, 400])))) for i in range(60)]
    leak = {}
    for j, (i, text) in enumerate(ITEMS[:6]):
        w = text.split()
        out.append((100 + j, " ".join(prose(50) + w + prose(70))))
        out.append((200 + j, " ".join(prose(20)) + "\n" + text.upper() + ".\n" + " ".join(prose(9))))
        out.append((300 + j, text))
        leak |= {(k + j, i): 1.0 for k in (100, 200, 300)}
    w = ITEMS[4][1].split()
    w[30] = "changed"
    out.append((400, " ".join(prose(33) + w + prose(33))))
    leak[(400, 4)] = 51 / 61
    out.append((401, " ".join(prose(33) + ITEMS[4][1].split()[:20] + prose(33))))  # a third of an item
    out += [(402, None), (403, ""), (404, " \t\n"), (None, ITEMS[2][1]), (405, " ".join(prose(30_000) + ITEMS[1][1].split() + prose(10_000)))]
    leak |= {(None, 2): 1.0, (405, 1): 1.0}
    return out, leak


def test_finds_the_leaks_and_only_those(spark):
    docs, leak = rows()
    df = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, item_id string").repartition(3)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    for block in (D.ITEM_BLOCK, 3):
        got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in D.find_contamination(df, bench, item_block=block).collect()}
        assert got.keys() == leak.keys()
        if block == D.ITEM_BLOCK:  # all shingles weigh the same here
            assert got == pytest.approx(leak)
    kept = D.decontaminate(df, bench)
    assert kept.columns == df.columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(str(d) for d, _ in docs if d not in {x for x, _ in leak})
    assert D.find_contamination(df.limit(0), bench).count() == 0
    assert D.find_contamination(df, bench.limit(0)).count() == 0
    assert D.decontaminate(df, bench.limit(0)).count() == len(docs)


def test_multi_index_finds_all_within_the_radius():
    r = np.random.default_rng(3)
    items = D.Items(list(range(300)), [" ".join(prose(20)) for _ in range(300)])
    prints = items.prints[r.integers(0, 300, 500)].copy()
    for _ in range(15):
        prints ^= np.left_shift(np.uint64(1), r.integers(0, 64, 500, dtype=np.uint64))
    win, item = items.near(prints, np.ones(300, bool))
    apart = np.bitwise_count(prints[:, None] ^ items.prints[None, :])
    assert set(zip(win.tolist(), item.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(apart <= D.RADIUS))))


def test_toxicity_on_held_out_rows(spark, tmp_path):
    bad = ["idiotword", "scumword", "trashword", "loserword"]
    docs, labels = [], []
    for i in range(1500):
        toxic = R.random() < 0.15
        w = prose(R.choice([5, 40, 200])) + (R.sample(bad, R.choice([1, 2, 3])) if toxic else [])
        R.shuffle(w)
        docs.append((i, " ".join(w), "en", "s"))
        if R.random() < 0.8:
            labels.append((i, 1, int(toxic)))
    docs += [(5000, None, "en", "s"), (5001, "", "en", "s"), (None, "some words", "en", "s"), (5002, "Muslim women and gay men met old immigrants", "en", "s"), (5003, "what an IDIOTWORD, a trashword!", "en", "s")]
    labels += [labels[0], (None, 1, 1), (7, 0, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, toxic string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r["doc_id"]: r for r in T.op10_toxicity(spark, str(tmp_path)).collect()}
    assert len(got) == len(docs)
    truth = {d: any(b in (t or "") for b in bad) for d, t, *_ in docs[:1500]}
    wrong = [d for d, t in truth.items() if got[d]["predicted"] != int(t)]
    assert len(wrong) <= 3, wrong
    assert got[5003]["predicted"] == 1 and got[5002]["predicted"] == 0 and got[5000]["score"] == got[5001]["score"] < 0.5
    for d, r in got.items():
        assert r["held_out"] == (d is not None and zlib.crc32(str(d).encode()) % 3 == 1)


def test_swapping_terms_hardly_changes_a_score():
    """A term that occurs in toxic rows mostly would be weighted without the penalty."""
    (chunk,) = K.chunks(pa.array(["muslim insultword plain other"]))
    muslim, insult, plain, other = (int(x) for x in (chunk.words(lower=True)[0] % K.U64(T.HASHED)))
    rows, y = [], []
    for i in range(400):
        toxic = i % 4 == 0
        rows.append(np.array([plain if i % 2 else other] + ([insult] if toxic and i % 3 else []) + ([muslim] if toxic or i % 16 == 1 else []), dtype=np.int32))
        y.append(float(toxic))
    model = T.fit(rows, np.array(y))
    keep = T.PENALTY
    T.PENALTY = 0.0
    free = T.fit(rows, np.array(y))
    T.PENALTY = keep
    assert abs(model.weight[muslim]) < 0.6 * abs(free.weight[muslim]) and model.weight[insult] > abs(model.weight[muslim])


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    assert T.score(docs, T.train(docs, empty)).head()["score"] == 0.5
    assert re.search("christian", T.IDENTITY_TERMS[0])

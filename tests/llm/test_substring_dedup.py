import hashlib
import random
import re

import pytest

from sparkmine.llm import substring_dedup as S


def brute(rows, k):
    """rows: (doc_id, text) -> sorted (doc_id, n_words, n_removed, sha)"""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    big = float("inf")
    for (d, _), w in zip(rows, words):
        for i in range(len(w) - k + 1):
            key = tuple(w[i : i + k])
            first[key] = min(first.get(key, big), big if d is None else d)
    out = []
    for (d, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - k + 1):
            if first[tuple(w[i : i + k])] < (big if d is None else d):
                gone.update(range(i, i + k))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed=3):
    r = random.Random(seed)
    vocab = ["aa", "b", "çé", "the", "of", "d.", "E", "ñandú", "x" * 50]
    passages = [" ".join(r.choice(vocab) for _ in range(30)) for _ in range(4)]
    rows = []
    for i in r.sample(range(1000), 60):
        parts = [" ".join(r.choice(vocab) for _ in range(r.randrange(0, 40))), r.choice(passages) if r.random() < 0.6 else "", "\t\n tail " + str(r.randrange(3))]
        r.shuffle(parts)
        rows.append((i, " \x0b".join(parts)))
    rows += [(1001, None), (1002, ""), (1003, " \n\t "), (1004, rows[0][1]), (1005, rows[0][1]), (None, rows[0][1]), (1006, "w " * 400), (1007, "w " * 400)]
    rows += [(1008, " ".join(str(r.random()) for _ in range(20000)))]
    rows.append((1009, rows[-1][1][5000:]))
    return rows


@pytest.mark.parametrize("max_group", [S.MAX_GROUP, 60])
def test_equals_brute_force(spark, max_group):
    """A tiny max_group takes longer prefixes and the salted hot passages."""
    rows = corpus()
    rows += [rows[5], rows[5]]  # repeated rows
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((tuple(r) for r in S.substring_dedup(df, k=5 if max_group == 60 else 13, max_group=max_group).collect()), key=str)
    assert got == brute(rows, 5 if max_group == 60 else 13)


def test_empty_table_and_extra_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, n_words string, grp long")
    out = S.substring_dedup(df)
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"] and out.count() == 0
    df = spark.createDataFrame([(1, "a b", "x", 5)], "doc_id long, text string, n_words string, grp long")
    assert S.substring_dedup(df).head()["n_words"] == 2

import random
import re

import numpy as np
import pytest

from sparkmine.llm import jaccard_join as J
from sparkmine.llm.components import connected_components


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return sorted(((d, len(s), None if d is None else low[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed, n=25):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    line = " ".join(r.choice(vocab) for _ in range(60))
    rows, ids = [], iter(r.sample(range(10_000), 2000))
    for _ in range(n):
        w = [r.choice(vocab) for _ in range(r.choice([3, 6, 9, 14, 30, 60, 150, 400]))]
        if r.random() < 0.3:
            w += line.split()
        for _ in range(r.choice([1, 1, 2, 8])):
            v = list(w)
            for _ in range(r.randrange(0, 1 + max(1, len(v) // 40))):
                v[r.randrange(len(v))] = r.choice(vocab)
            if r.random() < 0.3:
                v = v[: max(1, int(len(v) * r.uniform(0.75, 1)))]
            rows.append((next(ids), " ".join(x.upper() if r.random() < 0.1 else x for x in v)))
    rows += [(next(ids), rows[0][1]) for _ in range(20)] + [(20_000, None), (20_001, ""), (20_002, " \t\n"), (None, rows[0][1]), (20_003, "é É x")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((tuple(r) for r in J.jaccard_components(df, max_bucket=500).collect()), key=str)
    assert got == brute(rows)


def test_signatures_never_miss_a_linked_pair():
    r = np.random.default_rng(5)
    for _ in range(4000):
        n = int(r.integers(1, 300))
        a = np.unique(r.integers(0, 2**63, n, dtype=np.uint64))
        drop = int(r.integers(0, 1 + n // 8))
        b = np.unique(np.concatenate((a[drop:], r.integers(0, 2**63, int(r.integers(0, 1 + n // 8)), dtype=np.uint64))))
        same = len(np.intersect1d(a, b))
        if len(b) and 100 * same >= 80 * (len(a) + len(b) - same):
            assert len(np.intersect1d(J.band_signatures(a), J.band_signatures(b)))
            apart = int(np.bitwise_count(J.sketch(a) ^ J.sketch(b)).sum())
            assert apart <= len(a) + len(b) - 2 * same <= (len(a) + len(b)) / 9


def test_wide_sketches_bound_the_difference():
    r = np.random.default_rng(6)
    assert J.wide_sketch(np.arange(J.LONG, dtype=np.uint64)) is None
    for _ in range(40):
        a = np.unique(r.integers(0, 2**63, int(r.integers(J.LONG + 400, 20_000)), dtype=np.uint64))
        b = np.unique(np.concatenate((a[int(r.integers(0, 300)) :], r.integers(0, 2**63, int(r.integers(0, 1 + len(a))), dtype=np.uint64))))
        differ = len(np.setxor1d(a, b))
        assert J.wide_distance(J.wide_sketch(a), J.wide_sketch(b)) <= differ
        other = np.unique(r.integers(0, 2**63, len(a), dtype=np.uint64))
        assert 180 * J.wide_distance(J.wide_sketch(a), J.wide_sketch(other)) > 20 * (len(a) + len(other))


def test_long_sets_equal_brute_force(spark):
    r = random.Random(3)
    vocab = [f"w{i}" for i in range(5000)]
    rows, base = [], [r.choice(vocab) for _ in range(4500)]
    for i in range(14):
        w = list(base) if i % 2 else [r.choice(vocab) for _ in range(r.choice([2300, 4200, 6000]))] + base[:300]
        for _ in range(r.choice([0, 20, 60, 95, 110, 140])):
            w[r.randrange(len(w))] = r.choice(vocab)
        rows.append((i, " ".join(w)))
    # ids 20 and 21 have a long text and a short one each; the short ones link
    rows += [(d, " ".join(r.choice(vocab) for _ in range(3000))) for d in (20, 21)]
    df = spark.createDataFrame(rows + [(20, "a b c d e f g"), (21, "a b c d e f g h")] + [(20, "p q r s t u v w x y"), (21, "p q r s t u v w x z")], "doc_id long, text string")
    found = {x["component_id"] for x in J.jaccard_components(df, max_bucket=2000).where("doc_id >= 20").collect()}
    assert found == {20, 21}  # 7 of 10 and 5 of 7 shingles are no link
    df = spark.createDataFrame(rows + [(d, "a b c d e f g h i" + " j" * (d - 20)) for d in (20, 21)], "doc_id long, text string")
    assert {x["component_id"] for x in J.jaccard_components(df, max_bucket=2000).where("doc_id >= 20 AND n_shingles < 10").collect()} == {20}
    rows = rows[:-2]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(x) for x in J.jaccard_components(df, max_bucket=2000).collect()), key=str) == brute(rows)


def test_empty_table_and_repeated_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string, n long")
    assert J.jaccard_components(df).count() == 0
    df = spark.createDataFrame([(3, "a b c d e f", 1)] * 3 + [(1, "A B c d e f", 2)], "doc_id long, text string, grp long")
    assert [tuple(r) for r in J.jaccard_components(df).orderBy("doc_id").collect()] == [(1, 2, 1)] + [(3, 2, 1)] * 3


def test_chain_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 5), (200, 201), (7, 7)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys([*range(61), 100], 0), 200: 200, 201: 200}

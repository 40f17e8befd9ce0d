import collections
import random

import numpy as np
import pytest

from sparkmine.llm import jaccard_join as J
from sparkmine.llm import textkernel as K

from .test_jaccard_join import brute


def thin(shingles, band):
    """Whether a set's elements fall in at most D blocks of a band's first hash."""
    _, d, m = J._BANDS[band]
    return len(np.unique(((shingles >> K.U64(32)) * K.U64(m)) >> K.U64(32))) <= d


def test_short_unrelated_sets_share_few_signatures():
    """100,000 sets of ten elements without a common one: no signature grows with them."""
    r = np.random.default_rng(1)
    seen, n_thin = collections.Counter(), 0
    for _ in range(100_000):
        s = np.unique(r.integers(0, 2**63, 10, dtype=np.uint64) << K.U64(1))
        n_thin += thin(s, 5)
        seen.update(set(J.band_signatures(s).tolist()))
    assert n_thin > 300  # the case is there
    assert max(seen.values()) <= 3


@pytest.mark.parametrize("n", [4, 5, 7, 9, 10, 11, 13, 16, 20, 26])
def test_thin_sets_share_a_signature_with_what_they_link(n):
    r = np.random.default_rng(n)
    met = 0
    for _ in range(400):
        base = r.integers(0, 2**60, n, dtype=np.uint64)
        # few high halves: all elements in one or two blocks of the first hash
        top = r.integers(0, 2**32, 2, dtype=np.uint64)[r.integers(0, 2, n)]
        a = np.unique((top << K.U64(32)) | (base & K.U64(0xFFFFFFFF)))
        out, more = int(r.integers(0, 1 + n // 5)), int(r.integers(0, 1 + n // 5))
        b = np.unique(np.concatenate((a[out:], r.integers(0, 2**63, more, dtype=np.uint64))))
        same = len(np.intersect1d(a, b))
        if 100 * same >= 80 * (len(a) + len(b) - same):
            met += 1
            assert len(np.intersect1d(J.band_signatures(a), J.band_signatures(b)))
    assert met > 20


def test_sets_thin_at_every_hash(monkeypatch):
    """With one hash only, the empty blocks are emitted and no pair is missed."""
    monkeypatch.setattr(J, "LEVELS", 1)
    test_thin_sets_share_a_signature_with_what_they_link(10)


def texts(seed):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(r.choice(vocab) for _ in range(r.choice([5, 8, 14])))) for i in range(200)]
    near = rows[7][1].split() + [r.choice(vocab) for _ in range(30)]
    rows += [(1000 - i, " ".join(near)) for i in range(100)] + [(2000, " ".join(near + ["x"])), (5, " ".join(near)), (None, " ".join(near))]
    return rows + [(1000, " ".join(near))] * 5 + [(901, rows[3][1])]


@pytest.mark.parametrize("parts", [4, 4096])
def test_heavy_classes_equal_brute_force(spark, monkeypatch, parts):
    monkeypatch.setattr(J, "HEAVY_PARTS", parts)
    rows = texts(parts)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    heavy = J._heavy_classes(J.shingle_profile(df))
    assert 5 in heavy.values() and (parts == 4096 or len(heavy) == 1)
    got = sorted((tuple(r) for r in J.jaccard_components(df, max_bucket=500).collect()), key=str)
    assert got == brute(rows)


def test_a_heavy_class_emits_once(spark):
    rows = texts(1)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    names = "bucket long, docs binary, set_keys binary, counts binary, sigs binary"
    copies = {d for d, t in rows if t == rows[201][1]}
    emitted = collections.Counter()
    for r in df.mapInArrow(J._emit(5, 1, J._heavy_classes(J.shingle_profile(df))), names).collect():
        emitted.update(np.frombuffer(r["docs"], np.int64).tolist())
    assert {d for d in emitted if d in copies} == {5}

import random
import re
from collections import Counter, defaultdict

import pytest

from sparkmine.llm import collocations as C

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, top=2000, least=10):
    """rows: (text, lang) -> (lang, rank, phrase, a, l, r, n, score)"""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {g: a for g, a in c.items() if len(g) > 1 and a >= least}
        found = []
        for g, a in cand.items():
            if any(100 * b >= 50 * a and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1)) for h, b in cand.items() if len(h) > len(g)):
                continue
            score, _, left, right = min((10**6 * a * a // (c[g[:k]] * c[g[k:]]), k, c[g[:k]], c[g[k:]]) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(found)[:top])]
    return sorted(out)


def corpus(seed, docs=120):
    r = random.Random(seed)
    vocab = ["The", "the", "a", "of", "çé", "Éa", "日本", "x-y", "1"] + [f"w{i}" for i in range(30)]
    fixed = ["New York City", "new york", "ad hoc", "the the the"]
    rows = []
    for _ in range(docs):
        parts = [r.choice(fixed) if r.random() < 0.2 else r.choice(vocab) for _ in range(r.randrange(0, 120))]
        text = "".join(p + r.choice([" ", " ", " ", "\t", ". ", ",", "\n", " \r\n", "  ", "!"]) for p in parts)
        rows.append((text, r.choice(["en", "en", "en", "fr", None, "und"])))
    return rows + [(None, "en"), ("", "de"), (" \n", None), (rows[0][0], "en"), (rows[0][0], "en"), ("one two", "xx")]


def got(df, **kw):
    return sorted(tuple(r) for r in C.collocations(df, **kw).collect())


@pytest.mark.parametrize("max_group,flush", [(C.MAX_GROUP, C.FLUSH), (20, 37)])
def test_equals_brute_force(spark, max_group, flush):
    """Tiny groups are dealt by two words and by whole windows; tiny flushes cut texts."""
    rows = corpus(1)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    assert got(df, max_group=max_group, flush=flush) == brute(rows)


def test_limit_and_ties(spark):
    """Many phrases of equal score and count at the last rank go by their bytes."""
    rows = [(f"p{i} q{i}. " * 10 + "Z z. " * 12 + "é è. " * 10, "en") for i in range(60)]
    df = spark.createDataFrame(rows, "text string, lang string")
    assert got(df, top=20) == brute(rows, top=20)
    assert got(df, min_count=601) == brute(rows, least=601)


def test_exact_arithmetic(spark):
    """Products far beyond 64 bits."""
    big = 10**15
    counts = [("en", 0, None, None, None, 4 * big), ("en", 1, 1, None, None, big + 1), ("en", 1, 2, None, None, big + 3), ("en", 2, 1, 2, None, big - 7)]
    df = spark.createDataFrame(counts, "lang string, k int, w1 long, w2 long, w3 long, n long")
    assert [r["score"] for r in C.scored_phrases(df).collect()] == [10**6 * (big - 7) ** 2 // ((big + 1) * (big + 3))]


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([], "text string, lang string, w1 string, n string")
    assert C.collocations(df).count() == 0
    rows = corpus(2, 40)
    df = spark.createDataFrame([(t, g, "x", 5, None) for t, g in rows], "text string, lang string, W1 string, score long, id long")
    assert got(df) == brute(rows)


def test_query(spark, tmp_path):
    rows = corpus(3, 80)
    spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(rows)], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(tuple(r) for r in C.op12_collocations(spark, str(tmp_path)).collect()) == brute(rows)

import hashlib
import random
import re
import zlib

import pytest

from sparkmine.llm import periodic_runs as P


def brute(t):
    """Every run of the words ``t`` as (start, length, period)."""
    n, out = len(t), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and t[j] == t[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                out.append((i, j + q - i, q))
            i = j + 1
    return {r for r in out if not any(s[2] < r[2] and s[0] <= r[0] and s[0] + s[1] >= r[0] + r[1] for s in out)}


def texts(seed, count):
    r = random.Random(seed)
    for _ in range(count):
        k = r.choice([1, 2, 3, 5, 40])
        t = [r.choice(["a", "é", "b.", "longer"]) + str(r.randrange(k)) for _ in range(r.randrange(0, 90))]
        for _ in range(r.randrange(3)):
            u = [str(r.randrange(k)) for _ in range(r.randrange(1, 12))]
            at = r.randrange(len(t) + 1)
            t[at:at] = (u * 9)[: r.randrange(3, 8) * len(u) + r.randrange(len(u))]
        yield t


def test_automaton_equals_brute_force():
    for t in texts(1, 1500):
        assert P.stretch_runs(t, 0, len(t)) == brute(t)


@pytest.mark.parametrize("seed", [2, 3])
def test_operator_equals_brute_force(spark, seed):
    rows = [(i, " \n".join(t)) for i, t in enumerate(texts(seed, 300))]
    rows += [(9001, None), (9002, ""), (9003, " \t "), (None, "x " * 50), rows[5], rows[5]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r["doc_id"], r["n_words"], tuple(tuple(x) for x in r["runs"]), r["kept"]) for r in P.periodic_runs(df).collect()), key=str)
    want = []
    for i, text in rows:
        t = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = sorted(brute(t), key=lambda x: (x[0], x[2]))
        gone = {j for s, m, q in runs for j in range(s + q, s + m)}
        want.append((i, len(t), tuple(runs), " ".join(x for j, x in enumerate(t) if j not in gone)))
    assert got == sorted(want, key=str)


def test_long_periods_and_long_texts(spark):
    """A period of 5,000 words in a text of 40,000, and 100,000 equal words."""
    r = random.Random(4)
    u = [f"w{r.randrange(10**6)}" for _ in range(5000)]
    head = [f"h{j}" for j in range(9000)]
    df = spark.createDataFrame([(1, " ".join(head + (u * 6)[:29000])), (2, "w " * 100_000)], "doc_id long, text string")
    got = {x["doc_id"]: [tuple(y) for y in x["runs"]] for x in P.periodic_runs(df).collect()}
    assert got == {1: [(9000, 29000, 5000)], 2: [(0, 100_000, 1)]}


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([], "doc_id long, text string, runs string, kept long")
    assert P.periodic_runs(df).columns == ["doc_id", "n_words", "runs", "kept"] and P.periodic_runs(df).count() == 0
    df = spark.createDataFrame([(1, "a " * 9, "x", 5)], "doc_id long, text string, RUNS string, kept long")
    assert P.periodic_runs(df).head()["kept"] == "a"


def test_query_plants_periods(spark, tmp_path):
    r = random.Random(5)
    rows = [(i, " ".join(str(r.randrange(40)) for _ in range(r.randrange(0, 120)))) for i in range(400)] + [(1000, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {x["doc_id"]: x for x in P.op13_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    some = 0
    for i, text in rows:
        t = (text or "").split()
        h, n = zlib.crc32(str(i).encode()), len(t)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            t = [t[j] if j < a else t[a + (j - a) % p] for j in range(n)]
        runs = sorted(brute(t), key=lambda x: (x[0], x[2]))
        some += bool(runs)
        top = min(((-m, s, q) for s, m, q in runs), default=None)
        gone = {j for s, m, q in runs for j in range(s + q, s + m)}
        x = got[i]
        assert (x["n_runs"], x["start"], x["length"], x["period"]) == (len(runs), *((top[1], -top[0], top[2]) if top else (None,) * 3))
        assert x["exponent_milli"] == (1000 * -top[0] // top[2] if top else None)
        assert x["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert x["collapsed_sha256"] == hashlib.sha256(" ".join(y for j, y in enumerate(t) if j not in gone).encode()).hexdigest()
    assert some > 10

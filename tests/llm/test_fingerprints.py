import hashlib
import random
import re

from pyspark.sql import functions as F

from sparkmine.llm import fingerprints as P
from sparkmine.llm.common import words


def hashes(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [w[i : i + 5] for i in range(len(w) - 4)] if len(w) >= 5 else [w] if w else []
    return sorted({hashlib.md5(" ".join(g).encode()).hexdigest()[:12] for g in grams})


def sketch(text):
    h = hashes(text)
    return h[: max(P.FLOOR, sum(x <= P._LIMIT for x in h))]


def bound(s):
    return "f" * 12 if len(s) < P.FLOOR else max(P._LIMIT, s[-1])


def near(a, b):
    t = min(bound(a), bound(b))
    x, y = {h for h in a if h <= t}, {h for h in b if h <= t}
    return len(x & y) / len(x | y) if x | y else 1.0


def brute(rows):
    """rows as the operator orders them: id (null last), hash of the text (here: any order of equal ids is tried by the caller)."""
    out = []
    for i, (d, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        e = t[: len(t) - half] + nxt[:half]
        a, b = sketch(t), sketch(e)
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), "".join(a), "".join(b), round(near(a, b), 12), round(near(a, sketch(nxt)), 12)))
    return sorted(out, key=str)


def corpus():
    r = random.Random(7)
    vocab = ["aa", "b", "çé", "日本", "the", "𝄞x", "d."]
    rows = [(i, " ".join(r.choice(vocab) + str(r.randrange(300)) for _ in range(r.choice([0, 1, 3, 30, 200, 900])))) for i in r.sample(range(-500, 1000), 60)]
    return rows + [(2000, None), (2001, ""), (2002, " \t\n"), (2003, rows[0][1]), (2004, rows[0][1] + " more words here")]


def got(df):
    return sorted((tuple(round(x, 12) if isinstance(x, float) else x for x in r) for r in P.edited_fingerprints(df).collect()), key=str)


def test_equals_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(df) == brute(sorted((d, t or "") for d, t in rows))


def test_repeated_rows_and_null_ids(spark):
    """Equal rows follow each other, rows that share an id go by the hash of the text, null ids last."""
    rows = [(5, "a b c d e f g"), (5, "a b c d e f g"), (5, "a b c d e f g"), (5, "x y"), (0, "zero"), (None, "n o n e"), (None, None), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    h = {r["text"]: r["h"] for r in df.fillna("").select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(((d, t or "") for d, t in rows), key=lambda x: (x[0] is None, x[0] or 0, h[x[1]]))
    assert got(df.repartition(4)) == brute(order)


def test_empty_and_single_tables_and_clashing_names(spark):
    df = spark.createDataFrame([], "doc_id long, text string, sketch string")
    assert P.edited_fingerprints(df).count() == 0
    df = spark.createDataFrame([(1, "a b c d", 5, "q")], "doc_id long, text string, H long, copies string")
    assert got(df) == brute([(1, "a b c d")])


def test_merge_and_containment(spark):
    """The merged sketch is the sketch of the union; a short part of a very long text is contained in it."""
    r = random.Random(9)
    long = [f"w{r.randrange(10**7)}" for _ in range(30_000)]
    for a, b in [(long[:20_000], long[15_000:]), (long[:40], long[20:60]), (long, long[:300]), ([], long[:50])]:
        df = spark.createDataFrame([(" ".join(a), " ".join(b))], "a string, b string")
        df = P.with_sketch(P.with_sketch(df, "a", "sa"), "b", "sb")
        union = sorted(set(hashes(" ".join(a))) | set(hashes(" ".join(b))))
        merged, inside = df.select(P.merged(F.col("sa"), F.col("sb")), P.containment(F.col("sb"), F.col("sa"))).head()
        assert merged == union[: max(P.FLOOR, sum(x <= P._LIMIT for x in union))]
        share = len(set(hashes(" ".join(a))) & set(hashes(" ".join(b)))) / len(hashes(" ".join(b)))
        assert abs(inside - share) < 0.1
    df = spark.createDataFrame([("x " * 100,)], "t string").select(P.shingle_hashes(words(F.col("t"))).alias("h"))
    assert len(df.head()["h"]) == 1


def test_fingerprint_reads_back(spark):
    df = spark.createDataFrame([("a b c d e f " * 3,), ("",), (None,)], "t string")
    df = P.with_sketch(df, "t", "s").withColumn("p", P.fingerprint(F.col("s")))
    assert all(r["s"] == r["back"] for r in df.select("s", P.sketch_of(F.col("p")).alias("back")).collect())


def test_native(spark):
    """No Python worker in the plan."""
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = P.edited_fingerprints(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan

import collections
import os
import re

import duckdb
import pytest

from sparkmine.llm import mixing as M
from sparkmine.llm import quality as Q
from sparkmine.llm import sharding as S

EDGE = [
    (1, None, "b"),
    (2, "", "b"),
    (3, " \n\t\x0b ", None),
    (4, "one two three four five one two three four five", "a"),
    (5, "a b c d e " * 40, "a"),
    (6, "x\ny\nx\n \n\nx\nlong line\nlong line ", "é"),
    (7, "Plain words in a row that are all quite different from each other and fine.", "Z"),
    (7, "Plain words in a row that are all quite different from each other and fine.", "Z"),
    (8, " ".join(f"word{i}" for i in range(30_000)), "Z"),
    (9, "*** ### word *** ### more $$$ %%% && || and <so> on it goes *** here ok", "a"),
    (None, "no id but some words in the text which has more than ten words", "a"),
    (10, "  nbsp stays in　word 𝔘𝔫𝔦𝔠𝔬𝔡𝔢 " * 3, "b"),
]


def duck(sql, rows):
    c = duckdb.connect()
    c.execute("create table documents(doc_id bigint, text varchar, source varchar)")
    c.executemany("insert into documents values (?, ?, ?)", rows)
    return sorted(c.execute(sql).fetchall(), key=str)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edge"))
    extra = [(*r, "x", "y", 1) for r in EDGE]
    spark.createDataFrame(extra, "doc_id long, text string, source string, n_words string, _h string, size int").repartition(2).write.parquet(f"{path}/documents.parquet")
    return path


def test_quality_equals_sql_and_brute(spark, folder):
    got = sorted((tuple(r) for r in Q.op1_quality_rules(spark, folder).collect()), key=str)
    assert got == duck(Q.OP1_SQL, EDGE)
    by = {r[0]: r for r in got}
    assert by[4][5] == 10 and by[6][4] == 2 and by[5][6] and not by[7][6] and by[7][7] and not by[9][7]
    for d, t, _ in EDGE:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        where = collections.defaultdict(list)
        for i in range(len(w) - 4):
            where[tuple(w[i : i + 5])].append(i)
        cover = {i + j for p in where.values() if len(p) > 1 for i in p for j in range(5)}
        assert by[d][1:3] == (len(w), sum(map(len, w))) and by[d][5] == len(cover)


def test_quality_filter_keeps_columns_and_order_is_measured(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = Q.quality_filter(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {7, 8, None}
    ranks = [m.rank for m in Q.order_rules(docs, "text", Q.default_rules())]
    assert ranks == sorted(ranks, reverse=True)
    assert Q.quality_filter(docs.limit(0)).count() == 0


def test_quality_is_native(spark, folder):
    plan = Q.op1_quality_rules(spark, folder)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_mixing_equals_sql(spark, folder):
    got = sorted((tuple(r) for r in M.op9_mixing(spark, folder).collect()), key=str)
    assert got == duck(M.OP9_SQL, EDGE)
    assert all(t <= 2 * s for _, s, _, _, t in got)


def test_mixing_targets(spark):
    rows = [("a", 10), ("b", 1000), ("c", 500), (None, 0), ("d", 1)]
    got = {r["source"]: r for r in M.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    assert [got[s]["weight"] for s in ("a", "b", "c", "d", None)] == [3, 1, 2, 3, 1]
    assert sum(r["target"] for r in got.values()) == pytest.approx(1.5 * 1511)
    assert got["a"]["target"] == 20 and got["d"]["target"] == 2 and got["c"]["target"] == 1000 and got[None]["target"] == 0


def test_mix_emits_copies(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = M.mix(docs)
    assert out.columns == docs.columns
    want = collections.Counter()
    for r in M.op9_mixing(spark, folder).collect():
        if r["size"]:
            want[r["doc_id"]] += r["taken"] // r["size"]
    got = collections.Counter(r["doc_id"] for r in out.collect())
    assert {d: n for d, n in got.items() if d not in (1, 2, 3)} == +want  # 1, 2 and 3 have no words
    assert M.mix(docs.limit(0)).count() == 0


def test_lookup_table_by_definition():
    names, slots = ["a", "b", "c"], 13
    got = S.lookup_table(names, slots)
    order = {n: [(S._hash(n, "offset") + j * (S._hash(n, "skip") % 12 + 1)) % 13 for j in range(13)] for n in names}
    want, turn = {}, 0
    while len(want) < slots:
        n = names[turn % 3]
        want[next(s for s in order[n] if s not in want)] = turn % 3
        turn += 1
    assert got == [want[i] for i in range(slots)]
    full = S.lookup_table(S.SHARDS)
    share = collections.Counter(full)
    assert max(share.values()) - min(share.values()) <= 1 and len(share) == 64
    fewer = S.lookup_table(S.SHARDS[:-1])
    assert sum(x != y for x, y in zip(full, fewer)) < 0.1 * S.SLOTS
    with pytest.raises(ValueError):
        S.lookup_table(names, 12)


def test_shards_are_stable_and_written(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumnRenamed("size", "slot")
    out = S.assign_shards(docs)
    assert out.columns == [c for c in docs.columns if c != "slot"] + ["slot", "shard"]
    a = sorted(map(str, out.collect()))
    assert a == sorted(map(str, S.assign_shards(docs.repartition(5)).collect())) and len(a) == len(EDGE)
    S.write_shards(docs, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(EDGE)
    assert any(x.startswith("shard=") for x in os.listdir(tmp_path / "out"))
    assert S.assign_shards(docs.limit(0)).count() == 0


def test_sharding_of_any_column_names(spark):
    from sparkmine.llm import sharding as S

    df = spark.createDataFrame([(1, "a", 5, "x", 2, 3)], "doc_id long, _slot string, _shard long, SLOT string, at int, row int")
    out = S.assign_shards(df)
    assert out.columns == ["doc_id", "_slot", "_shard", "at", "row", "slot", "shard"]
    assert out.head()["at"] == 2 and S.assign_shards(df.limit(0)).count() == 0

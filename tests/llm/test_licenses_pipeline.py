import random

import pytest

import corpus_pipeline as P
from sparkmine.llm import licenses as L
from tests.llm.test_jaccard_join import brute

R = random.Random(5)
VOCAB = [f"word{i}" for i in range(2000)] + ["the", "of", "under", "license", "public", "version", "work", "is"]


def prose(n):
    return " ".join(R.choice(VOCAB) for _ in range(n))


def test_license_scan(spark, tmp_path):
    rows, want = [], {}
    for i in range(200):
        rows.append((i, prose(40) + "\n" + prose(30)))
        want[i] = ""
    lines = {
        300: ("MIT", "Released under the MIT License."),
        301: ("GPL", "This work is licensed under the GNU General Public License, version 3."),
        302: ("Apache-2.0", "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0."),
        303: ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
        304: ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    }
    for i, (family, line) in lines.items():
        rows.append((i, prose(50) + "\n" + line + "\n" + prose(20)))
        want[i] = family
    rows += [(310, lines[300][1] + "\n" + lines[301][1] + "\n" + lines[300][1]), (311, None), (312, ""), (None, lines[300][1]), (313, "The officer asked for a license."), (314, lines[300][1]), (314, prose(20))]
    want |= {310: "GPL,MIT", 311: "", 312: "", 313: ""}
    spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, line string").repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    out = L.op5_license_scan(spark, str(tmp_path))
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(rows)
    by = {d: x for d, x, _ in got if d not in (None, 314)}
    assert by == want
    assert sorted(x for d, x, _ in got if d == 314) == ["", "MIT"] and [x for d, x, _ in got if d is None] == ["MIT"]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert L.scan(docs.limit(0), L.train(spark, L.paragraphs_of(docs).select("text"))).count() == 0


def test_pipeline_against_brute_force(spark, tmp_path):
    items = [(i, " ".join(R.sample(VOCAB, 40))) for i in range(5)]
    rows = []
    for i in range(120):
        rows.append((i, " ".join(R.sample(VOCAB, R.choice([30, 120]))), "en", R.choice(["a", "b", "c", None]), 0))
    rows += [(500, "short text", "en", "a", 0), (501, None, "en", "a", 0), (502, "* # " * 40 + "w " * 3, "en", "a", 0)]
    rows += [(600 + i, rows[i][1] + " extra", "en", "b", 0) for i in range(10)]
    rows += [(700 + i, prose(30) + " " + items[i][1] + " " + prose(30), "en", "c", 0) for i in range(5)]
    rows += [rows[3]]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for i, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        kept.append([tuple(r) for r in docs.collect()])
        if i < 4:
            assert docs.schema.names == ["doc_id", "text", "lang", "source", "n_chars"]
    after_rules = sorted(r[0] for r in kept[0])
    assert after_rules == sorted(r[0] for r in rows if r[0] not in (500, 501, 502))
    groups = brute([(r[0], r[1]) for r in kept[0]])
    assert sorted(r[0] for r in kept[1]) == sorted({c for d, _, c in groups})
    assert sorted(r[0] for r in kept[2]) == sorted(r[0] for r in kept[1] if not 700 <= r[0] < 705)
    assert {r[0] for r in kept[3]} <= {r[0] for r in kept[2]} and max(map([r[0] for r in kept[3]].count, {r[0] for r in kept[3]})) <= 2
    assert sorted(map(str, (r[:5] for r in kept[4]))) == sorted(map(str, kept[3])) and docs.columns[-2:] == ["slot", "shard"]
    again = P.run(spark, str(tmp_path))
    assert sorted(map(str, (tuple(r) for r in again.collect()))) == sorted(map(str, kept[4]))


@pytest.mark.parametrize("stage", range(5))
def test_stages_on_an_empty_table(spark, tmp_path, stage):
    spark.createDataFrame([(1, "a b")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, _row string, a long, node string")
    out = P.STAGES[stage][1](spark, empty, str(tmp_path))
    assert out.columns[:8] == empty.columns and out.count() == 0

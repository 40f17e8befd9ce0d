import hashlib
import re

from sparkmine.llm import substring_dedup as S
from tests.llm.test_substring_dedup import brute, corpus


def test_kept_text_and_spans(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    texts = dict(rows)
    got = S.substring_kept(df).collect()
    assert sorted(((r["doc_id"], r["n_words"], sum(b - a for a, b in r["spans"]), hashlib.sha256(r["kept"].encode()).hexdigest()) for r in got), key=str) == brute(rows, 13)
    for r in got:
        w = re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]] or "")
        assert r["kept"] == " ".join(x for i, x in enumerate(w) if not any(a <= i < b for a, b in r["spans"]))
    assert any(r["spans"] for r in got)

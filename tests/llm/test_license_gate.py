from sparkmine.llm import licenses as L

#: Notices that are no template, by family.
HELD_OUT = [
    ("CC-BY", "CC BY 4.0"),
    ("CC-BY", "Available under CC BY 4.0"),
    ("CC-BY", "Text: CC-BY 4.0."),
    ("CC-BY-NC", "CC BY-NC 4.0"),
    ("CC-BY-NC", "(c) Acme, CC BY-NC 4.0"),
    ("CC-BY-NC", "Photos are licensed under CC BY-NC 4.0"),
    ("MIT", "This library is released under the MIT License."),
    ("Apache-2.0", "It is licensed under the Apache License, Version 2.0"),
    ("GPL", "SPDX-License-Identifier:GPL-3.0-or-later"),
    ("MPL-2.0", "the Mozilla Public License, version 2.0."),
]
PROSE = "the man under the tree had a work of art and the public saw it in the hall of the city under the sun"


def test_short_words_pass_the_gate(spark):
    """Bare notices of short words are found though every paragraph has 'under' and 'the'."""
    docs = [(i, f"{PROSE} {i} times\n{PROSE} in year {i}") for i in range(200)] + [(1000 + i, f"{PROSE}\n{line}") for i, (_, line) in enumerate(HELD_OUT)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    model = L.train(spark, L.paragraphs_of(df).select("text"))
    got = {r["doc_id"]: r["family"] for r in L.scan(df, model).collect() if r["family"] != L.UNKNOWN}
    assert {d for d in got if d < 1000} == set()
    assert {i: got.get(1000 + i) for i in range(6)} == {i: HELD_OUT[i][0] for i in range(6)}


def test_gate_equals_the_bigrams_of_the_words(spark):
    bigrams = ["cc by", "4 0", "by nc", "of the", "by nct"]
    texts = ["CC-BY", "cc  by", "acc by", "cc bye", "x cc\tby", "4.0", "14.0", "4.01", "v4.0!", "by.nc by", "BY--NCT", "by nctx", "of\u00a0the", "of\nthe", "cc by\u2028", "\u212a of the", "", None, "cc cc by", "by"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    w = L._words(L.F.col("text"))
    pairs = L.F.arrays_overlap(L.F.zip_with(w, L.F.slice(w, 2, 1 << 30), lambda a, b: L.F.concat(a, L.F.lit(" "), b)), L.F.array(*map(L.F.lit, bigrams)))
    for r in df.select("text", L._has_bigram(L.F.col("text"), bigrams).alias("gate"), pairs.alias("have")).collect():
        assert bool(r["gate"]) == bool(r["have"]), r

import random

import corpus_pipeline as P

R = random.Random(9)
HAN = [chr(c) for c in range(0x4E00, 0x5200)]


def words(n, vocabulary):
    return " ".join(f"word{R.randrange(vocabulary)}" for _ in range(n))


def test_quality_stage_does_not_reject_for_length_or_script(spark):
    rows = [
        (1, words(40_000, 3_000)),  # a fourteenth of the words are distinct
        (2, words(4_000, 300)),
        (3, " ".join("".join(R.choices(HAN, k=40)) for _ in range(30))),
        (4, words(5_000, 40)),  # few words again and again, in every window
        (5, " ".join("".join(R.choices("abcdefgh", k=40)) for _ in range(30))),
        (6, words(50, 3_000)),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in P.quality_stage(spark, docs, "").collect()) == [1, 2, 3, 6]

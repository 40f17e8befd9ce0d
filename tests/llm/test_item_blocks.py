import random

import pytest

from sparkmine.llm import decontaminate as D

R = random.Random(3)


def prose(n):
    return [f"v{R.randrange(5000)}" for _ in range(n)]


SHARED = [prose(12) for _ in range(4)]
#: Items that share passages, so their shingles weigh differently.
ITEMS = [(i, prose(14) + SHARED[i % 4] + prose(14) + SHARED[(i + 1) % 4]) for i in range(24)]


def corpus():
    rows = []
    for i, w in ITEMS:
        for j, at in enumerate((3, 16, 30)):
            # a word of the item changed, and a passage of other items' shingles after it
            new = w[:at] + ["changed"] + w[at + 1 :]
            rows.append((100 * i + j, " ".join(prose(20) + new + SHARED[(i + 2) % 4] + prose(10))))
        rows.append((100 * i + 9, " ".join(w[:-12] + SHARED[(i + 3) % 4])))
        # the last words replaced by another item's passage: shingles that another block knows
        rows.append((100 * i + 10, " ".join(prose(9) + w[:-7] + SHARED[(i + 3) % 4][:7] + prose(9))))
    return [*rows, (7, rows[0][1]), (7, rows[0][1]), (None, rows[1][1]), (8, None), (9, "")]


def test_results_do_not_depend_on_the_blocks(spark):
    df = spark.createDataFrame([(*r, "x") for r in corpus()], "doc_id long, text string, k1 string").repartition(3)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in ITEMS] + [(90, "too short"), (91, None)], "item_id long, text string")
    every = []
    for block in (D.ITEM_BLOCK, 9, 4):
        found = D.find_contamination(df, bench, item_block=block)
        every.append(sorted(((r["doc_id"], r["item_id"], r["start_word"], r["window_words"], r["similarity"]) for r in found.collect()), key=str))
        kept = D.decontaminate(df, bench, item_block=block)
        assert kept.columns == df.columns
        every[-1].append(sorted(str(r["doc_id"]) for r in kept.collect()))
    assert len(every[0]) > 40 and any(0.8 <= r[4] < 1 for r in every[0][:-1])
    for other in every[1:]:
        assert [r[:4] for r in other[:-1]] == [r[:4] for r in every[0][:-1]] and other[-1] == every[0][-1]
        assert [r[4] for r in other[:-1]] == pytest.approx([r[4] for r in every[0][:-1]], abs=1e-9)

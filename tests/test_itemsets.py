from itertools import combinations

import pytest
from pyspark.sql import functions as F

from conftest import TINY, itemsets
from sparkmine.operators import fpm
from sparkmine.operators import itemsets as IS

EXPECTED = {
    (1,): 6, (2,): 7, (3,): 6, (4,): 2, (5,): 2,
    (1, 2): 4, (1, 3): 4, (1, 5): 2, (2, 3): 4, (2, 4): 2, (2, 5): 2,
    (1, 2, 3): 2, (1, 2, 5): 2,
}


def brute_force(rows, min_count):
    counts = {}
    for t in rows:
        t = sorted(set(t))
        for k in range(1, len(t) + 1):
            for c in combinations(t, k):
                counts[c] = counts.get(c, 0) + 1
    return {c: n for c, n in counts.items() if n >= min_count}


def test_apriori_tiny(tiny):
    assert itemsets(IS.apriori(tiny, 2)) == EXPECTED


def test_apriori_support_threshold(tiny):
    # ceil(2/9 * 9) = 2
    assert itemsets(IS.apriori(tiny, support=2 / 9)) == EXPECTED


def test_candidate_growth_apriori_convention(tiny):
    rows = sorted(tuple(r) for r in IS.candidate_growth(tiny, 2).collect())
    assert rows == [(1, 5), (2, 10), (3, 2), (4, 0)]


def test_min_count_above_n_gives_nothing(tiny):
    assert IS.apriori(tiny, 10).count() == 0
    assert sorted(tuple(r) for r in IS.candidate_growth(tiny, 10).collect()) == [(1, 0)]


@pytest.mark.parametrize("p,how", [(1, "mod"), (2, "mod"), (4, "hash"), (15, "mod")])
def test_son_equals_apriori(tiny, p, how):
    run = IS.son(tiny, p, support=2 / 9, bucket=how, seed=7)
    assert run.min_count == 2
    assert itemsets(run.itemsets) == EXPECTED


def test_son_local_and_stats(tiny):
    run = IS.son(tiny, 3, support=2 / 9)
    assert (run.min_count, run.local_min) == (2, 1)
    local = run.local.collect()
    # every locally frequent set of bucket b is contained in some transaction of b
    by_bucket = {}
    for i, t in enumerate(TINY):
        by_bucket.setdefault(i % 3, []).append(set(t))
    for r in local:
        assert any(set(r["items"]) <= t for t in by_bucket[r["bucket"]])
    stats = {(r["bucket"], r["k"]): r["n_candidates"] for r in run.candidate_stats.collect()}
    # k = 1 counts the distinct items seen in the bucket (SON convention)
    for b, ts in by_bucket.items():
        assert stats[(b, 1)] == len(set().union(*ts))


def test_fp_growth_cross_check(tiny):
    assert itemsets(fpm.fp_growth(tiny, 2)) == EXPECTED


def test_compare_itemsets(tiny):
    a = IS.apriori(tiny, 2)
    b = fpm.fp_growth(tiny, 2)
    diff = IS.compare_itemsets(a, b).collect()
    assert all(r["side"] == "both" and r["count_a"] == r["count_b"] for r in diff)
    c = IS.apriori(tiny, 4)
    sides = {tuple(r["items"]): r["side"] for r in IS.compare_itemsets(a, c).collect()}
    assert sides[(1, 2)] == "both" and sides[(4,)] == "left_only"


def test_association_rules(tiny):
    rules = fpm.association_rules(IS.apriori(tiny, 2), 9, 0.0).collect()
    by = {(tuple(r["antecedent"]), tuple(r["consequent"])): r for r in rules}
    r = by[((5,), (1,))]
    assert (r["support_count"], r["confidence"]) == (2, 1.0)
    assert r["lift"] == pytest.approx(1.5)
    assert by[((1,), (2,))]["confidence"] == pytest.approx(4 / 6)


def test_profile(tiny):
    r = IS.transaction_profile(tiny).first()
    assert (r["n"], r["distinct_items"]) == (9, 5)
    assert r["avg_len"] == pytest.approx(2.555556, abs=1e-6)
    assert r["density"] == pytest.approx(0.511111, abs=1e-6)


def test_profile_empty(spark):
    empty = spark.createDataFrame([], "txn_id long, items array<int>")
    r = IS.transaction_profile(empty).first()
    assert (r["n"], r["avg_len"], r["distinct_items"], r["density"]) == (0, 0.0, 0, 0.0)


def test_count_candidates_arbitrary_set(spark, tiny):
    cands = spark.createDataFrame([([1, 2],), ([1, 2, 3],), ([4],), ([2, 5],), ([1, 3, 5],), ([3, 4, 5],)], "items array<int>")
    got = {tuple(r["items"]): r["support_count"] for r in IS.count_candidates(tiny, cands).collect()}
    assert got == {(1, 2): 4, (1, 2, 3): 2, (4,): 2, (2, 5): 2, (1, 3, 5): 1, (3, 4, 5): 0}


def test_join_and_prune_candidates(tiny):
    res = IS.apriori(tiny, 2)
    l2 = res.where("k = 2")
    c3 = IS.prune_candidates(IS.join_candidates(l2, 3), l2, 3)
    assert sorted(tuple(r["items"]) for r in c3.collect()) == [(1, 2, 3), (1, 2, 5)]
    pairs = IS.join_candidates(res.where("k = 1"), 2).count()
    assert pairs == 10


def test_prune_infrequent(tiny):
    l1 = IS.item_support(tiny, 3)
    got = {r["txn_id"]: r["items"] for r in IS.prune_infrequent(tiny, l1).collect()}
    assert got[1] == [2] and got[7] == [1, 2, 3] and len(got) == 9


def test_random_against_brute_force(spark):
    import random

    rnd = random.Random(3)
    rows = [sorted(rnd.sample(range(12), rnd.randint(0, 7))) for _ in range(120)]
    tx = spark.createDataFrame(list(enumerate(rows)), "txn_id long, items array<int>")
    for mc in (6, 15):
        want = brute_force(rows, mc)
        assert itemsets(IS.apriori(tx, mc)) == want
        assert itemsets(IS.son(tx, 5, min_count=mc, bucket="hash").itemsets) == want


def test_apriori_properties(spark):
    import random

    rnd = random.Random(11)
    rows = [rnd.sample("abcdefgh", rnd.randint(1, 6)) for _ in range(80)]
    tx = spark.createDataFrame(list(enumerate(rows)), "txn_id long, items array<string>")
    got = itemsets(IS.apriori(tx, 8))
    for items, n in got.items():
        assert list(items) == sorted(items)
        for k in range(1, len(items)):
            for sub in combinations(items, k):
                assert sub in got and got[sub] >= n


def test_same_result_under_other_shuffle_partitions(spark, tiny):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        a = itemsets(IS.apriori(tiny, 2))
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        b = itemsets(IS.apriori(tiny, 2))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b == EXPECTED


def test_string_items_and_itemset_support(spark):
    tx = spark.createDataFrame([(0, ["b", "a"]), (1, ["a", "b", "a"]), (2, ["c"])], "txn_id long, items array<string>")
    got = itemsets(IS.apriori(tx, 2))
    assert got == {("a",): 2, ("b",): 2, ("a", "b"): 2}
    occ = IS.explode_items(tx).select(F.array("item").alias("items"))
    assert {tuple(r["items"]): r["support_count"] for r in IS.itemset_support(occ, 2).collect()}[("a",)] == 3


def test_empty_input(spark):
    empty = spark.createDataFrame([], "txn_id long, items array<int>")
    assert IS.apriori(empty, support=0.1).count() == 0
    run = IS.son(empty, 3, support=0.1)
    assert (run.n, run.itemsets.count()) == (0, 0)
    blanks = spark.createDataFrame([(0, []), (1, [])], "txn_id long, items array<int>")
    assert IS.apriori(blanks, 1).count() == 0
    assert IS.transaction_profile(blanks).first()["n"] == 2


def test_hot_item_and_hot_bucket(spark):
    import random

    rnd = random.Random(5)
    # item 0 is in every transaction; a third of the transactions share txn ids = 0 mod 3 (one SON bucket)
    rows = [sorted({0} | set(rnd.sample(range(1, 9), rnd.randint(1, 4)))) for _ in range(150)]
    tx = spark.createDataFrame(list(enumerate(rows)), "txn_id long, items array<int>")
    want = brute_force(rows, 20)
    assert itemsets(IS.apriori(tx, 20)) == want
    assert itemsets(IS.son(tx, 3, min_count=20, bucket="mod").itemsets) == want

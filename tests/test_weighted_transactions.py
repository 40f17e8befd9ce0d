"""Equal transactions are mined as one row: the levels do not grow with copies."""

import random

import pytest

from conftest import itemsets
from sparkmine import session
from sparkmine.operators import itemsets as IS
from sparkmine.plans.experiments import SweepRow, run_sweep
from test_miner_tree import brute

R = random.Random(5)
ROWS = [sorted(R.sample(range(9), R.randrange(0, 6))) for _ in range(40)]
BUCKETS = 4


def copies(spark, n):
    """``ROWS`` n times; a row's copies are in its bucket."""
    return spark.createDataFrame([(c * len(ROWS) + i, x) for c in range(n) for i, x in enumerate(ROWS)], "txn_id long, items array<int>")


def probed(monkeypatch):
    """The rows of every lookup a miner makes, in order."""
    seen, inner = [], IS.probe

    def spy(rows, *args, **kw):
        seen.append(rows.count())
        return inner(rows, *args, **kw)

    monkeypatch.setattr(IS, "probe", spy)
    return seen


@pytest.mark.parametrize("limit", [2**26, 0])
def test_lookups_do_not_grow_with_copies(spark, monkeypatch, limit):
    monkeypatch.setattr(session, "BROADCAST_LIMIT_BYTES", limit)
    seen, per = probed(monkeypatch), {}
    for n in (1, 6):
        seen.clear()
        run = IS.son(copies(spark, n), BUCKETS, min_count=6 * n, bucket="mod", stats=True)
        assert (run.n, run.local_min) == (40 * n, -(-6 * n // BUCKETS))
        assert itemsets(run.itemsets) == {s: c * n for s, c in brute(ROWS, 6).items()}
        assert itemsets(IS.apriori(copies(spark, n), 6 * n)) == itemsets(run.itemsets)
        per[n] = list(seen)
    # local_min is 2 for one copy and 9 for six: never more rows than for one copy
    assert len(per[1]) >= len(per[6]) > 4 and per[6][0] == per[1][0]
    assert max(per[6]) <= max(per[1]) and sum(per[6]) <= sum(per[1])


def test_weights_add_up_to_the_transactions(spark):
    tx = copies(spark, 3).unionByName(spark.createDataFrame([(999, [3, 1, 1])], "txn_id long, items array<int>"))
    got, n = IS.weighted_transactions(tx)
    held = [(tuple(r["items"]), r["_weight"]) for r in got.collect()]
    want = {t: 3 * sum(tuple(r) == t for r in ROWS) for t in map(tuple, ROWS)}
    want[1, 3] = want.get((1, 3), 0) + 1
    assert n == 121 and len(held) == len(want) and dict(held) == want
    assert got.select("_rid").distinct().count() == len(held)
    assert IS.weighted_transactions(tx.limit(0))[1] == 0
    assert IS.resolve_threshold(0, None, 0.5) == 1 and IS.apriori(tx.limit(0), support=0.5).count() == 0


def test_support_is_of_all_transactions(spark):
    """Without ``n`` the weights are added up, not the rows counted."""
    base, _ = IS.weighted_transactions(copies(spark, 5))
    assert itemsets(IS.mine_frequent(base, support=0.2, prepared=True).itemsets) == {s: 5 * c for s, c in brute(ROWS, 8).items()}


def test_sweep_lookups_do_not_grow_with_copies(spark, monkeypatch):
    seen, per = probed(monkeypatch), {}
    for n in (2, 4):
        seen.clear()
        runs, _ = run_sweep(copies(spark, n), [SweepRow(0.2, 2, fraction=0.5)])
        r = runs.first()
        assert (r["n"], r["local_min"], r["n_itemsets"]) == (20 * n, 2 * n, len(brute(ROWS, 8)))
        per[n] = list(seen)
    assert per[2] == per[4]


GRID = [SweepRow(0.3, 2), SweepRow(0.4, 2), SweepRow(0.4, 2, restrict_items=3)]


def test_sweep_reads_a_modified_table_once(spark, monkeypatch):
    """Its profile and every run on it see the rows of equal transactions, whose number does not grow with copies."""
    made, seen, per = [], [], {}
    collapse, profile = IS.weighted_transactions, IS.transaction_profile
    monkeypatch.setattr(IS, "weighted_transactions", lambda *a, **kw: (made.append(a[1]), collapse(*a, **kw))[1])
    monkeypatch.setattr(IS, "transaction_profile", lambda tx: (seen.append(tx.count()), profile(tx))[1])
    for n in (2, 4):
        made.clear(), seen.clear()
        run_sweep(copies(spark, n), GRID[:2])
        assert len(made) == 1 and len(seen) == 2
        per[n] = list(seen)
    assert per[2] == per[4] and max(per[4]) <= 2 * len(set(map(tuple, ROWS)))


def test_shared_runs_equal_single_runs(spark):
    def figures(grid):
        runs, cands = run_sweep(copies(spark, 2), grid, 3)
        return [tuple(r)[1:-1] for r in runs.orderBy("run_id").collect()], sorted((r["run_id"], r["k"], r["n_candidates"]) for r in cands.collect())

    runs, cands = figures(GRID)
    for i in (1, 2):
        one, own = figures([GRID[i]])
        assert one == [runs[i]] and [(i, *c[1:]) for c in own] == [c for c in cands if c[0] == i]
    lengths = [len(r) for r in ROWS]
    assert runs[1][1:4] == (80, sum(lengths) / 40, 9) and runs[2][1:4] == (80, sum(lengths) / 40, 3)  # F3 keeps lengths


def test_profile_of_weighted_rows_is_that_of_the_bags(spark):
    bags = [[1, 1, 3], [3, 1], [1, 3], [1, 1, 3], [], None, [5, 5, 5, 5]]
    tx = spark.createDataFrame(list(enumerate(bags)), "txn_id long, items array<int>")
    rows, n = IS.weighted_transactions(tx, lengths=True)
    assert n == 7 and rows.count() == 5 and IS.transaction_profile(rows).first() == IS.transaction_profile(tx).first()
    none, _ = IS.weighted_transactions(tx.limit(0), lengths=True)
    assert IS.transaction_profile(none).first() == IS.transaction_profile(tx.limit(0)).first()
    # rows that differ in length only are mined as equal ones
    assert itemsets(IS.mine_frequent(rows, 2, prepared=True).itemsets) == {(1,): 4, (3,): 4, (1, 3): 4}


def test_son_of_prepared_rows(spark):
    tx = copies(spark, 3)
    rows, n = IS.weighted_transactions(IS.with_bucket(tx, BUCKETS), ["bucket"])
    for given in (n, None):
        run = IS.son(rows, BUCKETS, support=0.2, prepared=True, n=given)
        assert (run.n, itemsets(run.itemsets)) == (120, itemsets(IS.apriori(tx, support=0.2)))

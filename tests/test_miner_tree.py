"""The miner's prefix tree: many items, candidates before counting, open families, scopes."""

import os
import random
from collections import Counter
from itertools import combinations

import pytest

from sparkmine import session
from sparkmine.operators import itemsets as IS
from sparkmine.plans.experiments import SweepRow, run_sweep


def brute(rows, least):
    c = Counter(s for r in rows for k in range(1, len(set(r)) + 1) for s in combinations(sorted(set(r)), k))
    return {s: n for s, n in c.items() if n >= least}


@pytest.mark.parametrize("limit", [2**26, 0])
def test_30000_frequent_items(spark, monkeypatch, limit):
    """Every one of 30,000 items is frequent; also with nothing broadcast."""
    monkeypatch.setattr(session, "BROADCAST_LIMIT_BYTES", limit)
    r = random.Random(2)
    rows = [sorted({i, (i * 7 + 1) % 30000, r.randrange(30000)}) for i in range(30000)] * 2
    rows += [[1, 2, 3, 4]] * 3
    df = spark.createDataFrame(list(enumerate(rows)), "txn_id long, items array<int>")
    got = {tuple(x["items"]): x["support_count"] for x in IS.apriori(df, 2).collect()}
    assert got == brute(rows, 2)


def test_string_items_equal_brute_force(spark):
    r = random.Random(3)
    rows = [[f"Brand#{r.randrange(12)}" for _ in range(r.randrange(0, 9))] for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(rows)), "txn_id long, items array<string>")
    got = {tuple(x["items"]): x["support_count"] for x in IS.apriori(df, 6).collect()}
    assert got == brute(rows, 6)


def test_only_candidates_are_counted(spark, monkeypatch):
    """The pairs (node, y) that reach the aggregate at level k are at most A8's candidates."""
    r = random.Random(4)
    groups = [range(0, 6), range(4, 10), range(9, 14)]
    rows = [{*r.sample(r.choice(groups), r.randrange(2, 5)), *r.sample(range(14), r.randrange(3))} for _ in range(400)]
    df = spark.createDataFrame([(i, sorted(x)) for i, x in enumerate(rows)], "txn_id long, items array<int>")
    reached, inner = [], IS.probe

    def spy(left, table, on, *args, **kw):
        out = inner(left, table, on, *args, **kw)
        if on == ["node", "y"]:
            reached.append((left.distinct().count(), out.distinct().count()))
        return out

    monkeypatch.setattr(IS, "probe", spy)
    res = IS.mine_frequent(df, 25, stats="apriori")
    growth = {x["k"]: x["n_candidates"] for x in res.candidate_growth.collect()}
    assert len(reached) >= 2 and any(before > after for before, after in reached)
    for k, (_, after) in enumerate(reached, start=3):
        assert after <= growth[k]
    assert {tuple(x["items"]): x["support_count"] for x in res.itemsets.collect()} == brute(rows, 25)


@pytest.mark.parametrize("limit", [2**26, 0])
def test_counts_of_an_open_family(spark, tiny, monkeypatch, limit):
    """Candidates whose subsets are no candidates, repeated, unsorted and absent ones."""
    monkeypatch.setattr(session, "BROADCAST_LIMIT_BYTES", limit)
    family = [[3, 1], [1, 2, 3, 5], [5], [9], [4, 9], [1, 1, 2], []]
    df = spark.createDataFrame([(x,) for x in family], "items array<int>")
    rows = [set(x["items"]) for x in tiny.collect()]
    want = {tuple(sorted(set(f))): sum(set(f) <= x for x in rows) for f in family if f}
    assert {tuple(x["items"]): x["support_count"] for x in IS.count_candidates(tiny, df).collect()} == want
    assert IS.count_candidates(tiny, df.limit(0)).count() == 0


def test_a_sweep_leaves_only_its_result(spark, tiny):
    root = os.path.join(session.ensure_checkpoint_dir(spark).removeprefix("file:"), "sparkmine-tables")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    cached = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    runs, cands = run_sweep(tiny, [SweepRow(0.3, 2), SweepRow(0.3, 2, restrict_items=3)])
    assert set(os.listdir(root)) - before == set()
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() <= cached
    assert runs.count() == 2 and cands.count() > 2


def test_scope_ends_after_an_error(spark):
    with pytest.raises(ZeroDivisionError):
        with session.table_scope(spark):
            path = session.cut_lineage(spark.range(3)).inputFiles()[0].removeprefix("file:")
            assert os.path.exists(path)
            1 / 0
    assert not os.path.exists(path) and not session._scopes

"""Tables are broadcast or not by their measured size; the rows must be the same."""

import pytest

from sparkmine import session
from sparkmine.operators import itemsets as I
from sparkmine.operators import transform as X

ROWS = [(1, [1, 2], "a"), (1, [1, 3], "b"), (2, [3, 1, 1, 9], "c"), (3, [1, 2, 3], "d"), (4, [9], "e"), (5, [], "f"), (6, [2, 3, 7], "g")]


@pytest.fixture
def tx(spark):
    return spark.createDataFrame(ROWS, "txn_id long, items array<int>, note string")


def rows(df):
    return df.columns, sorted(map(str, (tuple(r) for r in df.collect())))


def both(monkeypatch, run):
    small = rows(run())
    monkeypatch.setattr(session, "BROADCAST_LIMIT_BYTES", 0)
    large = rows(run())
    assert small == large
    return small


def test_apriori_keeps_transactions_that_share_an_id(tx, monkeypatch):
    _, got = both(monkeypatch, lambda: I.apriori(tx, min_count=2))
    assert "(2, [1, 2], 2)" in got and "(1, [1], 4)" in got


@pytest.mark.parametrize("drop_empty", [True, False])
def test_prune_infrequent(tx, monkeypatch, drop_empty):
    l1 = tx.sparkSession.createDataFrame([(1,), (3,)], "item int")
    columns, got = both(monkeypatch, lambda: I.prune_infrequent(tx, l1, drop_empty=drop_empty))
    assert columns == ["txn_id", "items", "note"] and len(got) == (5 if drop_empty else 7)


@pytest.mark.parametrize("as_set", [True, False])
def test_restrict_items(tx, monkeypatch, as_set):
    _, got = both(monkeypatch, lambda: X.restrict_items(tx, 2, seed=3, as_set=as_set))
    assert len(got) == len(ROWS)


def test_pad_transactions(tx, monkeypatch):
    _, got = both(monkeypatch, lambda: X.pad_transactions(tx, 4, seed=3))
    assert len(got) == len(ROWS)

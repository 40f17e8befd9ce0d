import __spark_entry__ as E
from sparkmine.plans.oracle import oracle_sql
from sparkmine.plans.queries import QUERIES


def test_entry_flagship(spark):
    rows = E.entry(spark).collect()
    by_k = {}
    for r in rows:
        by_k[r["k"]] = by_k.get(r["k"], 0) + 1
    # part-type baskets at sf0.001, 5% support: 6, 15, 20, 14 frequent sets
    assert by_k == {1: 6, 2: 15, 3: 20, 4: 14}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())

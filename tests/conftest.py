import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparkmine.session import local_session  # noqa: E402

TINY = [[1, 2, 5], [2, 4], [2, 3], [1, 2, 4], [1, 3], [2, 3], [1, 3], [1, 2, 3, 5], [1, 2, 3]]


@pytest.fixture(scope="session")
def spark():
    s = local_session(cpus=4, shuffle_partitions=4, app="sparkmine-tests")
    yield s


@pytest.fixture(scope="session")
def tiny(spark):
    return spark.createDataFrame(list(enumerate(TINY)), "txn_id long, items array<int>")


def itemsets(df):
    """{(items tuple): count} from (k, items, support_count) rows."""
    return {tuple(r["items"]): r["support_count"] for r in df.collect()}

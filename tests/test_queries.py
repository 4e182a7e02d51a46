"""Every registered query against its SQL twin on the smallest tables, and its plan."""

import pytest

from check_oracles import compare, connect
from workload import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
# Few rows at this scale; the result may be empty, but must still agree.
pytestmark = pytest.mark.filterwarnings("ignore")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    if name in ORACLES:
        problems = compare(spark, con, name, lambda *_: df, ORACLES[name], SF_DIR)
        assert [p for p in problems if p != "no rows"] == []
    else:
        assert df.count() > 0


def test_entry_is_the_flagship(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())

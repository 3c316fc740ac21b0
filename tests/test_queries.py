"""Every registered query against its SQL, on the smallest data."""

import pytest

import __spark_entry__ as entry
from checks.compare import duck, frame_differences
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).columns == ["year", "month", "frozen", "dried", "ambiguous", "total"]


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql_and_stays_on_the_jvm(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert frame_differences(df, con, name) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    if name != "workbook_scan":
        assert not any(node in plan for node in ("Python", "InArrow", "InPandas"))

"""Every registered query against its SQL, over whole tables of the smallest folder."""

import os

import pytest
from compare import connect, spark_rows, sql_rows

import __spark_entry__ as contract
from postmill.plans import oracle, queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    columns, rows = spark_rows(contract.queries()[name](spark, SF_DIR))
    want_columns, want = sql_rows(con, oracle.oracle_sql()[name])
    assert columns == want_columns
    assert rows == want


def test_only_the_sketch_has_no_sql(spark):
    without = set(queries.queries()) - set(oracle.oracle_sql())
    assert without == {"distinct_profile_approximate"}
    exact = contract.queries()["distinct_profile"](spark, SF_DIR).first().asDict()
    near = contract.queries()["distinct_profile_approximate"](spark, SF_DIR).first().asDict()
    assert all(abs(near[k] - exact[k]) <= 0.15 * exact[k] for k in exact)


def test_entry_is_lazy_and_stable(spark):
    df = contract.entry(spark)
    assert df.dtypes == [("skill_name", "string"), ("postings", "bigint")]
    assert df.count() > 0

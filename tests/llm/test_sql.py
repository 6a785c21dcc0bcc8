import os

import duckdb
import pytest
from compare import spark_rows, sql_rows

from postmill.llm import queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF_DIR}/pages.parquet'")
    columns, rows = spark_rows(queries.QUERIES[name](spark, SF_DIR))
    assert (columns, rows) == sql_rows(con, queries.ORACLE_SQL[name])

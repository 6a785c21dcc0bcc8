"""Compare a query with its SQL on one data folder, as multisets of rows.

    python tests/compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "part", "orders", "lineitem"]


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], Counter(tuple(row[i] for i in order) for row in rows)


def spark_rows(df):
    return as_rows(df.columns, [tuple(row) for row in df.collect()])


def sql_rows(con, sql):
    result = con.execute(sql)
    return as_rows([d[0] for d in result.description], result.fetchall())


def main():
    import __spark_entry__ as contract
    from postmill.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle = contract.oracle_sql()
    bad = []
    for name, function in contract.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            columns, rows = spark_rows(function(spark, sf_dir))
        except Exception as error:
            bad.append(name)
            print(f"{name}: FAILED {str(error)[:600]}", flush=True)
            continue
        took = time.time() - start
        if name not in oracle:
            print(f"{name}: {sum(rows.values())} rows, no SQL, {took:.1f}s", flush=True)
            continue
        try:
            want_columns, want = sql_rows(con, oracle[name])
        except Exception as error:
            bad.append(name)
            print(f"{name}: SQL FAILED {str(error)[:600]}", flush=True)
            continue
        same = columns == want_columns and rows == want
        print(f"{name}: {'ok' if same else 'DIFFERENT'} {sum(rows.values())} rows {took:.1f}s", flush=True)
        if not same:
            bad.append(name)
            print("  columns", columns, want_columns)
            print("  only spark", list((rows - want).items())[:3])
            print("  only sql  ", list((want - rows).items())[:3])
    print("bad:", bad)


if __name__ == "__main__":
    main()

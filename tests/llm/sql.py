"""Compare a query of the corpus operators with its SQL on DuckDB."""

import glob
import os

import duckdb

from ledgerlens.llm import queries
from ledgerlens.llm.oracle import ORACLE


def sql_rows(folder, sql):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(
            f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{source}')"
        )
    result = con.execute(sql)
    return [item[0] for item in result.description], result.fetchall()


def assert_matches(spark, name, folder):
    df = queries.QUERIES[name](spark, folder)
    columns, expected = sql_rows(folder, ORACLE[name])
    assert sorted(columns) == sorted(df.columns)
    found = [tuple(row) for row in df.select(*columns).collect()]
    key = lambda row: [(value is None, value if value is not None else 0) for value in row]
    assert sorted(found, key=key) == sorted(expected, key=key)

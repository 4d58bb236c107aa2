"""Every registered query against its SQL counterpart, values compared exactly."""

import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as registered

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN",
}
# the corpus operators have their own tests
QUERIES = {
    name: query
    for name, query in registered.queries().items()
    if name != "pipeline" and not re.match(r"op\d+_", name)
}
ORACLE = {name: sql for name, sql in registered.oracle_sql().items() if name in QUERIES}
BASE = os.environ.get("TESTDATA", "/root/testdata")


def oracle_rows(folder, sql):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(
            f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')"
        )
    result = con.execute(sql)
    columns = {item[0]: str(item[1]) for item in result.description}
    return columns, [dict(zip(columns, row)) for row in result.fetchall()]


def ordered(rows, names):
    values = [tuple(row[name] for name in names) for row in rows]
    return sorted(values, key=lambda row: [(value is None, value or 0 if not isinstance(value, str) else value) for value in row])


def check(spark, name, folder):
    df = QUERIES[name](spark, folder)
    columns, expected = oracle_rows(folder, ORACLE[name])
    types = {field.name: TYPES[field.dataType.simpleString()] for field in df.schema}
    assert types == columns
    names = sorted(types)
    found = ordered([row.asDict() for row in df.collect()], names)
    assert len(found) == len(expected)
    assert found == ordered(expected, names)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf_dir, name):
    check(spark, name, sf_dir)


@pytest.mark.parametrize(
    "name", ["account_risk", "account_loss_pareto", "gold_high_risk_accounts", "amount_decile_risk"]
)
def test_limits_that_only_larger_data_reaches(spark, name):
    check(spark, name, f"{BASE}/sf0.1")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert registered.entry(spark).count() == 30

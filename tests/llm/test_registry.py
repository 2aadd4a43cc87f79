"""Registered queries against their SQL, values and types alike."""

import duckdb
import pytest

from fareflow.llm import registry
from tests.test_oracle import KINDS, TABLES, rows_of


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS FROM '{sf_dir}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, sf_dir, duck, name):
    got = registry.queries()[name](spark, sf_dir)
    answer = duck.sql(registry.oracle_sql()[name])
    assert {c: KINDS[k] for c, k in got.dtypes} == dict(zip(answer.columns, map(str, answer.types)))
    columns, rows = rows_of(got.toPandas())
    want_columns, want = rows_of(answer.df())
    assert columns == want_columns and rows == want and rows

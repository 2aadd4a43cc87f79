"""Every registered query against its SQL on another engine, row by row."""

import duckdb
import pytest

import __spark_entry__ as entry
from fareflow.plans import queries as registry

TABLES = ("region nation customer supplier part orders lineitem events "
          "documents embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS FROM '{sf_dir}/{table}.parquet'")
    return con


def rows_of(pdf):
    """Rows as a sorted list of strings, columns by name; floats keep every digit."""
    pdf = pdf[sorted(pdf.columns)].astype(object)
    pdf = pdf.where(pdf.notna(), None)
    return list(pdf.columns), sorted(repr([_plain(v) for v in row]) for row in pdf.values.tolist())


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def _plain(value):
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    return float(value) + 0.0


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, sf_dir, duck, name):
    got = entry.queries()[name](spark, sf_dir)
    sql = entry.oracle_sql()[name]
    answer = duck.sql(sql)
    kinds = {name: KINDS[kind] for name, kind in got.dtypes}
    assert kinds == dict(zip(answer.columns, map(str, answer.types)))
    columns, rows = rows_of(got.toPandas())
    want_columns, want = rows_of(answer.df())
    assert columns == want_columns
    assert len(rows) == len(want)
    assert rows == want

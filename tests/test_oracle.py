"""Every registered query equals its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from paths import SF_SMALL
from mercato.sources.tables import TEST_TABLES

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TEST_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    # Doubles are compared bit for bit: both engines sum exact decimals and
    # divide once, so any difference is a real one.
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    otypes = {d[0]: str(d[1]) for d in cur.description}
    for f in df.schema.fields:                      # same column types on both sides
        assert TYPES.get(f.dataType.simpleString()) == otypes[f.name], (f.name, f.dataType, otypes[f.name])
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(ocols, cur.fetchall())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "net_revenue_amount" in df.columns


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_oracle_runs(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() >= 0

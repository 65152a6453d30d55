"""Differential check: every registered query against its DuckDB oracle at sf0.001."""

import datetime as dt
import decimal
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from strata.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{Path(sf_small) / (t + '.parquet')}')")
    return c


def norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], Counter(tuple(norm(r[i]) for i in order) for r in rows)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "total_sales" in df.columns


def test_every_query_has_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


DUCK_TYPE = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
             "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("key", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, sf_small, key):
    df = catalog.QUERIES[key](spark, sf_small)
    s_cols, s_rows = canon(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(catalog.ORACLE[key])
    d_cols, d_rows = canon(rel.columns, rel.fetchall())
    assert s_cols == d_cols
    spark_types = {f.name: DUCK_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert spark_types == dict(zip(rel.columns, map(str, rel.types)))
    assert s_rows == d_rows

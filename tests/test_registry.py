"""Every registered query runs on sf0.001 and agrees with its DuckDB twin."""

from __future__ import annotations

import math

import duckdb
import pytest
from helpers import SF_SMALL

import __spark_entry__ as E
from faultline.plans.oracle import oracle_sql
from faultline.plans.queries import queries
from faultline.sources.tables import DRIVER_TABLES, table_path

NAMES = sorted(queries())

# Spark simple type name -> DuckDB type name
TYPE_TWINS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
              "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def _canon(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_canon(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 10
    assert df.columns[:2] == ["site_id", "site_name"]


def test_every_query_has_an_oracle_or_is_listed():
    no_sql = set(queries()) - set(oracle_sql())
    assert no_sql == set()
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    s_rows = _rows(df.columns, [tuple(r) for r in df.collect()])
    sql = oracle_sql().get(name)
    if sql is None:
        assert len(s_rows) >= 1
        return
    # One statement reads footers and so names a folder; here it is this one.
    cur = con.execute(sql.replace("/root/testdata/sf0.01", SF_SMALL))
    d_cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(d_cols)
    duck_types = {c[0]: str(c[1]).upper() for c in cur.description}
    assert {n: TYPE_TWINS.get(t, t) for n, t in df.dtypes} == duck_types
    assert s_rows == _rows(d_cols, cur.fetchall())

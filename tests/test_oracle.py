"""Every catalogue query equals its DuckDB oracle on sf0.01 (the driver's gate)."""

import datetime as dt
import decimal

import duckdb
import pytest

from __spark_entry__ import entry
from ordertide.plans import ORACLE_SQL, QUERIES
from tests.conftest import SF01

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


DUCK_TYPE = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
             "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(repr(_norm(r[i])) for i in order) for r in rows))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["window_start", "window_end", "store_id", "total_order_count",
                          "avg_order_value", "avg_wait_time_seconds"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF01)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLE_SQL[name])
    d_cols, d_types, d_rows = rel.columns, [str(t) for t in rel.types], rel.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    s_types = {f.name: DUCK_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in df.schema.fields}
    assert s_types == dict(zip(d_cols, d_types))
    assert len(s_rows) == len(d_rows)
    assert _rows(s_cols, s_rows) == _rows(d_cols, d_rows)


def test_salt_spread_rows(spark):
    rows = QUERIES["salt_spread"](spark, SF01).collect()
    assert sorted(r["salt"] for r in rows) == list(range(16))
    assert sum(r["n"] for r in rows) == 10000
    assert max(r["n"] for r in rows) < 2 * 10000 / 16

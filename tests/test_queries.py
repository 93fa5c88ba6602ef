"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as driver
from checks import inputs
from checks.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TYPES = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in inputs.TABLES:
        con.sql(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= driver.queries().items() and ORACLES.items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("name", list(inputs.SQL))
def test_inputs_agree(spark, duck, name):
    want = sorted(map(repr, duck.sql(inputs.duck(inputs.SQL[name])).fetchall()))
    assert sorted(repr(tuple(r)) for r in inputs.frame(spark, SF_DIR, name).collect()) == want


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    want = duck.sql(ORACLES[name])
    columns = sorted(want.columns)
    assert sorted(df.columns) == columns
    assert {c: TYPES[t] for c, t in df.dtypes} == dict(zip(want.columns, map(str, want.types)))
    at = [want.columns.index(c) for c in columns]
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    assert got == sorted(repr(tuple(r[i] for i in at)) for r in want.fetchall())
    assert got


def test_lookup_left_runs_no_sketch_over_joined_rows(spark, monkeypatch):
    from checks import queries
    from ledgerline.operators import joins, skew

    looked_at = []
    real = skew.hot_keys

    def seen(df, *args, **kwargs):
        looked_at.append(df.columns)
        return real(df, *args, **kwargs)

    monkeypatch.setattr(skew, "hot_keys", seen)
    monkeypatch.setattr(queries, "hot_keys", seen, raising=False)
    # all lookup tables are beyond the limit
    monkeypatch.setitem(joins.lookup.__kwdefaults__, "limit", 0)
    monkeypatch.setattr(queries, "BROADCAST_BYTES", 0, raising=False)
    QUERIES["lookup_left"](spark, SF_DIR)
    assert len(looked_at) == 1 and "cod_cartera_gestion" not in looked_at[0]


def test_entry(spark):
    assert driver.entry(spark).count() > 0

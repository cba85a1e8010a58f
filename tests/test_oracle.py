"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import math

import duckdb
import pytest

import __spark_entry__ as ent
from cardlake.plans.fixtures import TABLE_NAMES
from cardlake.plans.oracle import ORACLE_SQL
from cardlake.plans.queries import QUERIES
from tests.conftest import SF_SMALL

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLE_NAMES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_every_key_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES) <= set(ent.queries())
    assert len(KEYS) == 46


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = ent.queries()[key](spark, SF_SMALL)
    res = con.execute(ent.oracle_sql()[key])
    o_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(o_cols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(o_cols, res.fetchall())


def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert df.columns == ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]
    assert df.count() == 22

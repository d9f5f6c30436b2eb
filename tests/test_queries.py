"""Registered queries against their DuckDB oracle on the smallest data."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF0001

CHECKED = ["rsk_raw", "rsk_output", "gap_pipeline", "gap_m10_scenario1", "per_status", "clm_pseudo_claims",
           "jn_lookback_exclusion", "agg_time_series", "snk_upsert", "src_fixed_width", "dq_reconcile", "win_winner",
           "per_close", "per_history_status", "gap_suppress_cross", "agg_percentiles", "win_latest_cycle"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("customer orders lineitem part supplier nation region events labels").split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


def test_registry_complete():
    from riskspark.registry import load_all  # the library's own, without the corpus operators
    q, o = load_all(), E.oracle_sql()
    assert set(q) <= set(E.queries()) and set(o) <= set(E.queries())
    o = {n: sql for n, sql in o.items() if n in q}
    assert len(q) >= 190
    assert set(o) <= set(q)
    assert set(q) - set(o) == {"dq_schema"}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "raw_score" in df.columns


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF0001)
    cols = df.columns
    got = sorted((tuple(_norm(v) for v in r) for r in df.collect()), key=repr)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    idx = [ocols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
    assert got == want

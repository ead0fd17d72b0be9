"""Every registered query against its DuckDB twin on sf0.001 (the driver's gate at small scale)."""

import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from casebook.plans import all_oracles, all_queries
from casebook.sources.tables import TABLES
from tests.conftest import SMALL

NO_ORACLE = set()          # queries documented as rows-only


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 6):.6f}"
    if isinstance(v, decimal.Decimal):
        return f"{round(float(v), 6):.6f}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, rs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rs), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(all_queries()) - set(all_oracles()) == NO_ORACLE
    assert set(all_queries()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SMALL)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(dcols, res.fetchall())


@pytest.mark.parametrize("tz", ["America/Los_Angeles", "America/Sao_Paulo"])
def test_results_do_not_depend_on_session_time_zone(spark, con, tz):
    names = ["D1b_clean_runner_orders", "D10_pickup_delay_per_runner", "D22_delivery_fact_sheet",
             "C11_visit_summary", "M1_clean_weekly_sales", "M3_week_days", "D8b_volume_by_weekday",
             "G1_clean_metrics", "B13_payment_schedule"]
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        for name in names:
            df = E.queries()[name](spark, SMALL)
            res = con.execute(E.oracle_sql()[name])
            dcols = [d[0] for d in res.description]
            assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(dcols, res.fetchall()), name
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)

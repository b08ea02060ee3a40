"""Every registered query against its DuckDB oracle (small fixture)."""

import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from busframes.plans.catalog import QUERIES
from busframes.plans.oracle import ORACLE_SQL

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else None
    if isinstance(v, decimal.Decimal):
        return int(v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("lineitem", "orders", "part", "supplier"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["botschaft", "signal_name", "n", "total"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    exp_cols, exp = [c[0] for c in cur.description], cur.fetchall()
    assert sorted(got_cols) == sorted(exp_cols)
    assert len(got) == len(exp)
    assert _rows(got_cols, got) == _rows(exp_cols, exp)


def test_queries_pin_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        row = entry.queries()["frame_time_strings"](spark, SF).orderBy("ts").first()
        assert row.ts_text.startswith("2020-09-28 00:")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")

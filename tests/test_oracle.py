"""Every registered query against its DuckDB twin (sf0.001: hours missing)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from flowtally.oracle import ORACLE
from flowtally.queries import QUERIES
from tests.conftest import SF_SMALL

TABLES = ["orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _rows(pdf):
    cols = sorted(pdf.columns)

    def norm(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        return v.item() if hasattr(v, "item") else v

    return cols, sorted(tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["alert_status", "record_count"]
    assert {r.alert_status for r in rows} <= {"HIGH_ALERT", "LOW_ALERT", "NORMAL"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr

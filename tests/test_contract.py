"""Driver contract: entry runs, every oracle has a query, and a sample of
queries equals its DuckDB oracle on the smallest fixtures."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events".split()
SAMPLE = ["composite_live", "perf_step_prev", "refill_master", "refill_portfolio", "dedup_summary", "merge_summary",
          "snapshot_okx", "snapshot_binance", "job_stats", "alert_cooldown", "iso_normalise", "stream_mart", "stream_alert"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "nav" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{Path(SF_SMALL) / (t + '.parquet')}')")
    return con


def _rows(pdf):
    pdf = pdf[sorted(pdf.columns)].astype(object)
    out = []
    for r in pdf.itertuples(index=False):
        out.append(tuple(None if (v is None or v != v) else (round(v, 6) if isinstance(v, float) else str(v)) for v in r))
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, duck, name):
    s = E.queries()[name](spark, SF_SMALL).toPandas()
    d = duck.execute(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    assert len(s) == len(d)
    assert _rows(s) == _rows(d)

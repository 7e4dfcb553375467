import duckdb
import pytest

import __spark_entry__ as entry
import verify
from candlewick import queries as Q


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("CREATE VIEW events AS SELECT * FROM '/root/testdata/sf0.01/events.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_sql_agrees(spark, con, name):
    said = verify.compare(spark, con, "/root/testdata/sf0.01", name, Q.QUERIES[name], Q.ORACLES[name])
    assert ": ok" in said, said


def test_registry():
    assert set(Q.ORACLES) <= set(Q.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["all_features", "p2_clusters", "analyze"])
def test_others_run(spark, sf_dir, name):
    assert Q.QUERIES[name](spark, sf_dir).count() > 0


def test_every_series(spark):
    """The queries over every series leave none out, and the ranking cut acts."""
    sf = "/root/testdata/sf0.01"
    series = {r.instrument for r in Q.candles(spark, sf).select("instrument").distinct().collect()}
    wide = {(r.instrument, r.a, r.b): r.corr for r in Q.QUERIES["p2_corr_all"](spark, sf).collect()}
    n = len(Q.WIDE_SPACE.names())
    assert {k[0] for k in wide} == series and len(wide) == len(series) * n * (n - 1) // 2
    picked = Q.QUERIES["analyze_all"](spark, sf).collect()
    assert {r.instrument for r in picked} == series
    assert any(sum(p.selected for p in picked if p.instrument == s) < max(p.clusters for p in picked if p.instrument == s) for s in series)

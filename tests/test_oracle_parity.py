"""Every registered query equals its DuckDB oracle (or runs, when rows-only)."""

import pytest

import __spark_entry__ as entry
from eventide.plans.registry import QUERIES
from tests.oracle_harness import canon, duck

KEYS = sorted(QUERIES)      # the optional subpackage is tested on its own
ORACLE = entry.oracle_sql()
ROWS_ONLY: set[str] = set()


def test_every_key_has_an_oracle_or_is_declared_rows_only():
    assert set(KEYS) - set(ORACLE) == ROWS_ONLY


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "total_events" in df.columns


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, sf_dir, con, key):
    got = entry.queries()[key](spark, sf_dir).toPandas()
    if key not in ORACLE:
        assert len(got) > 0
        return
    want = con.sql(ORACLE[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert canon(got) == canon(want)


@pytest.mark.parametrize("key", ["normalize_processed", "stream_freshness", "scalar_functions", "event_gaps",
                                 "volume_anomalies", "check_freshness"])
def test_results_do_not_depend_on_session_zone(spark, sf_dir, con, key):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        got = entry.queries()[key](spark, sf_dir).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert canon(got) == canon(con.sql(ORACLE[key]).df())

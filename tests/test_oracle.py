"""Every registered library query against its DuckDB oracle at sf0.001."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, duck_connection
from tests.conftest import SMOKE
from trialmart.sinks import run_nightly
from trialmart.sources import from_testdata

QUERIES = entry.library_queries()
ORACLE = entry.library_oracles()


@pytest.fixture(scope="module")
def con():
    return duck_connection(SMOKE)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    n, problems = compare(QUERIES[name](spark, SMOKE), con, ORACLE[name])
    assert not problems, problems
    assert n > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 71 and df.count() > 0


def test_marts_without_broadcasts(spark, con, tmp_path):
    """The nightly run with every join shuffled publishes what the oracle says (the other tests run with broadcasts)."""
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        paths = run_nightly(spark, from_testdata(spark, SMOKE), str(tmp_path), entry.RUN_TS, lab_code_mode="faithful")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    for query, mart in entry.MARTS.items():
        _, problems = compare(spark.read.parquet(paths[mart]), con, ORACLE[query])
        assert not problems, (query, problems)

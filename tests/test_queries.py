"""Every registered query against its SQL, and what its plan must not hold."""

import duckdb
import pytest

import __spark_entry__ as entry
from otelier.plans.registry import ORACLES, QUERIES
from run_queries import TABLES, canonical

WRITING = {"src_flat", "src_raw_json", "src_raw_json_rejected", "src_dispatch", "src_stream", "snk_flat", "snk_hourly",
           "snk_run_meta", "snk_signals", "snk_prepared", "stream_flat", "stream_dedup", "src_dispatch_stream", "stream_lineage",
           "stream_counters"}


@pytest.fixture(scope="module")
def db(sf):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf, db, name):
    df = entry.queries()[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    result = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(got, df.columns) == canonical(result.fetchall(), columns)
    assert got
    if name not in WRITING:
        plan = df._jdf.queryExecution().executedPlan().toString()
        for word in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in plan, word


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["emitter", "start_time_unix_nano", "time_unix_nano", "sum_int", "sum_delta"] and df.count() > 0

"""Every registered query against its DuckDB SQL on the driver's sf0.001 tables."""

import os
import sys

import pytest

from conftest import ROOT, SF001

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import canon, duck  # noqa: E402
from tickframe.plans import catalog  # noqa: E402

SQL = {n: sql for n, (_, sql) in catalog.QUERIES.items()}
FAST = [n for n in catalog.QUERIES if n not in ("sink_fanout", "stream_ticks", "table_roundtrip",
                                             "csv_roundtrip", "parquet_roundtrip", "schema_evolution",
                                                   "stream_ticks_multi_batch", "stream_late_polls", "sink_retry",
                                                   "stream_restated", "stream_dedup_exact", "sink_append_twice")]


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_sql(spark, con, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert canon(rows, df.columns) == canon(drows, dcols)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) <= set(E.queries()) and all(SQL.values())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["tick_ts", "bar_ts"] and df.count() > 0

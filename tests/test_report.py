"""Stored expectation reports: equal to the whole report after every kind of change, reading only what changed."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tickframe.operators.expectations import expectation_report, full_report
from tickframe.params import DEFAULT
from tickframe.plans import report
from tickframe.plans.ticks import fixture_ticks
from tickframe.session import fresh_dir, materialised
from tickframe.sinks.fanout import Sinks, fan_out, replace_sessions
from tickframe.sinks.tables import append_ticks, create_tick_table


@pytest.fixture(scope="module")
def ticks(spark):
    return materialised(fixture_ticks(spark, SF001, bar_minutes=360, keep=("session_date",)), "report-test")


def as_dict(df):
    return {r.rule: (r.checked, r.violations) for r in df.collect()}


def test_equal_to_the_whole_report_and_reads_changed_days_only(spark, ticks, monkeypatch):
    name, base = f"default.rep_{uuid.uuid4().hex[:8]}", fresh_dir(spark, "rep")
    rows = ticks.drop("session_date")
    days = sorted(tuple(r) for r in rows.select("year", "month", "date").distinct().collect())
    last = (F.col("year") == days[-1][0]) & (F.col("month") == days[-1][1]) & (F.col("date") == days[-1][2])
    read = []
    real = report.changed_rows

    def watched(*args):
        units, again = real(*args)
        read.append({tuple(int(x) for x in re.findall(r"year=(\d+)/month=(\d+)/date=(\d+)", f)[0]) for f in again.inputFiles() if "/year=" in f})
        return units, again
    monkeypatch.setattr(report, "changed_rows", watched)

    def check():
        got = as_dict(report.stored_report(spark, name, f"{base}/report"))
        assert got == as_dict(expectation_report(spark.table(name)))
        return got

    create_tick_table(spark, name, f"{base}/t")
    assert set(check().values()) == {(0, 0)}                                        # no rows yet
    append_ticks(spark, rows.where(~last), name, create=False)
    check()
    append_ticks(spark, rows.where(last).withColumn("week_of_month", F.lit(6)), name, create=False)
    assert check()["EXP-3"][1] > 0 and days[-1] in read[-1] and len(read[-1]) <= 2 < len(days)   # the day before may hold a bar of its session
    check()
    assert read[-1] == set()                                                        # nothing changed, nothing read
    # A row stored under the last day, collected in the first day's session and without any time: both units are met.
    odd = rows.where(last).limit(1)
    first_tick = rows.orderBy("tick_ts").first()["tick_ts"]
    append_ticks(spark, odd.withColumn("tick_ts", F.lit(first_tick).cast(rows.schema["tick_ts"].dataType)), name, create=False)
    append_ticks(spark, odd.withColumn("tick_ts", F.lit(None).cast(rows.schema["tick_ts"].dataType)), name, create=False)
    check()
    assert {days[0], days[-1]} <= read[-1] and len(read[-1]) < len(days)
    # Other parameters: from scratch.
    strict = DEFAULT.with_(spike_pct=0.001)
    calls = len(read)
    assert as_dict(report.stored_report(spark, name, f"{base}/report", strict)) == as_dict(expectation_report(spark.table(name), strict))
    assert len(read) == calls


def test_replaced_sessions_of_published_sinks(spark, ticks):
    base = fresh_dir(spark, "rep-sinks")
    sinks = Sinks(f"default.reps_{uuid.uuid4().hex[:8]}", f"{base}/csv", f"{base}/pq", f"{base}/t")
    fan_out(spark, ticks, sinks.table, sinks.csv_dir, sinks.parquet_dir, "session_date", sinks.table_location)

    def check():
        known = report.stored_report(spark, sinks, f"{base}/report")
        whole = as_dict(full_report(spark, sinks, data_rules=known))
        assert {k: v for k, v in whole.items() if k not in ("EXP-9", "EXP-10")} == as_dict(expectation_report(spark.table(sinks.table)))
        assert whole["EXP-9"][1] == whole["EXP-10"][1] == 0
        return whole
    before = check()
    one = ticks.select("session_date").orderBy("session_date").first()[0]
    day = ticks.where(F.col("session_date") == one)
    # The day anew with broken rows, then without any row.
    replace_sessions(spark, day.withColumn("hl_ratio", F.lit(0.5)), sinks, "session_date")
    assert check()["EXP-6"][1] == day.count()
    covers = day.select("symbol", F.date_format("session_date", "yyyy_MM_dd").alias("session")).distinct()
    replace_sessions(spark, day.limit(0), sinks, "session_date", covers=covers)
    after = check()
    assert after["EXP-6"] == (before["EXP-6"][0] - day.count(), 0)

"""Live mode: streamed state equals the batch windows (test d of SURVEY section 5)."""

import os
import time

import pytest
from pyspark.sql import functions as F

from test_outcomes import _random_sessions, make_log
from tickframe.params import AFTER_ABORT, DEFAULT, GOOD
from tickframe.plans.ticks import session_states, ticks
from tickframe.schema import TICK_COLUMNS
from tickframe.session import fresh_dir
from tickframe.sinks import files, tables
from tickframe.sinks.fanout import Sinks, batch_writer, fan_out
from tickframe.sinks.ledger import Ledger
from tickframe.sources.polls import poll_log_from_rows
from tickframe.streaming.live import LATE, end_markers, poll_event_rows, read_landing, states_to_ticks, stream_states
from tickframe.streaming.run import stream_dedup, stream_poll_states, stream_ticks

PATIENT = DEFAULT.with_(live_delay_s=10 ** 9)   # polls are folded when their session has ended


def _log(spark, seed, n_sessions):
    polls, snaps = make_log(_random_sessions(seed, n_sessions=n_sessions))
    return poll_log_from_rows(spark, polls, snaps)


def _same(got, exp):
    got, exp = got.cache(), exp.cache()
    assert got.count() == exp.count() > 0
    assert got.exceptAll(exp).count() == 0


def _by_place(bounds):
    n = F.col("poll_id") % 1000
    return [(n >= lo) & (n < hi) for lo, hi in bounds]


IN_ORDER = [(0, 8), (8, 20), (20, 1000)]


def test_stream_equals_batch_in_order(spark):
    p, b = _log(spark, 11, 3)
    _same(stream_ticks(spark, p, b, parts=_by_place(IN_ORDER), max_files=12), ticks(p, b).select(*TICK_COLUMNS))


def test_stream_equals_batch_for_any_split(spark):
    """Newest polls first, and the rows of every poll dealt over two landings."""
    p, b = _log(spark, 7, 3)
    deal = F.pmod(F.xxhash64("symbol", "poll_id", "seq"), F.lit(2))
    how = [place & (deal == k) for place in _by_place([(15, 1000), (0, 15)]) for k in range(2)]
    _same(stream_ticks(spark, p, b, PATIENT, parts=how, max_files=12), ticks(p, b).select(*TICK_COLUMNS))


def test_late_rows_are_reported_not_lost(spark):
    p, b = _log(spark, 3, 3)
    st = stream_poll_states(spark, p, b, DEFAULT.with_(live_delay_s=0), parts=_by_place([(20, 1000), (0, 20)]), max_files=4).cache()
    seen = {(r.symbol, r.session_date, r.poll_id) for r in st.collect()}
    assert seen == {(r.symbol, r.session_date, r.poll_id) for r in p.collect()}
    assert st.where(F.col("outcome") == LATE).count() > 0
    assert st.where(F.col("outcome") == LATE).agg(F.min("late_polls")).first()[0] > 0


def test_a_gap_does_not_restart_an_aborted_session(spark):
    """A session aborted early stays aborted however long the stream waits for its next poll."""
    polls, snaps = make_log(_random_sessions(5, n_sessions=6))
    p, b = poll_log_from_rows(spark, polls, snaps)
    want = {(r.symbol, r.session_date, r.poll_id): r.outcome for r in session_states(p, b).select("symbol", "session_date", "poll_id", "outcome").collect()}
    assert AFTER_ABORT in want.values() and GOOD in want.values()
    st = stream_poll_states(spark, p, b, parts=_by_place([(0, 12), (12, 1000)]), max_files=6)
    assert {(r.symbol, r.session_date, r.poll_id): r.outcome for r in st.collect()} == want


def _land(spark, p, b, landing, bounds, ended=True):
    rows = poll_event_rows(p, b).cache()
    for part in _by_place(bounds):
        rows.where(part).coalesce(1).write.mode("append").parquet(landing)
    if ended:
        end_markers(rows).coalesce(1).write.mode("append").parquet(landing)


def test_foreach_batch_fan_out_then_batch_run(spark):
    p, b = _log(spark, 5, 4)
    base = fresh_dir(spark, "fb")
    _land(spark, p, b, f"{base}/landing", [(0, 15), (15, 1000)])
    name = "default.fb_" + base.rsplit("-", 1)[-1]
    st = states_to_ticks(stream_states(read_landing(spark, f"{base}/landing", max_files=1)))
    q = (st.writeStream.foreachBatch(batch_writer(name, f"{base}/csv", f"{base}/pq", table_location=f"{base}/table"))
         .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    exp = ticks(p, b).cache()
    n = exp.count()
    assert spark.table(name).count() == n
    assert files.strip_keys(files.read_csv(spark, f"{base}/csv")).count() == n
    assert files.strip_keys(files.read_parquet(spark, f"{base}/pq")).exceptAll(exp).count() == 0
    # A batch run over the same sessions adds nothing to any sink.
    fan_out(spark, exp, name, f"{base}/csv", f"{base}/pq", table_location=f"{base}/table")
    assert files.read_parquet(spark, f"{base}/pq").count() == n == files.read_csv(spark, f"{base}/csv").count()
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == n


def test_failure_after_any_step_leaves_the_old_or_the_new_state(spark, monkeypatch):
    p, b = _log(spark, 21, 2)
    t = ticks(p, b).coalesce(1).cache()
    n, early = t.count(), t.where(F.pmod(F.xxhash64("symbol", "tick_ts"), F.lit(2)) == 0).cache()
    base = fresh_dir(spark, "retry")
    name = "default.retry_" + base.rsplit("-", 1)[-1]
    sinks = Sinks(name, f"{base}/csv", f"{base}/pq", f"{base}/table")
    write = batch_writer(name, sinks.csv_dir, sinks.parquet_dir, table_location=sinks.table_location)

    def seen():
        spark.catalog.refreshTable(name)
        return [df.count() for df in sinks.read(spark).values()]
    write(early, 2)
    assert seen() == [early.count()] * 3 and 0 < early.count() < n
    for where, step in ((files, "add_csv"), (files, "add_parquet"), (tables, "add_to_published"), (Ledger, "stage_sessions"), (Ledger, "commit")):
        whole = getattr(where, step)

        def breaks(*a, **kw):
            whole(*a, **kw)
            raise RuntimeError("lost after the step")
        monkeypatch.setattr(where, step, breaks)
        with pytest.raises(RuntimeError):
            write(t, 3)
        monkeypatch.setattr(where, step, whole)
        assert seen() == [n if step == "commit" else early.count()] * 3, step
    write(t, 3)
    assert seen() == [n] * 3


def _live(spark, base, name, **kw):
    from tickframe.streaming.run import start_live
    q = start_live(spark, f"{base}/landing", name, f"{base}/csv", f"{base}/pq", f"{base}/ckpt", table_location=f"{base}/table", drain=True, **kw)
    q.awaitTermination()
    return q


def test_late_polls_are_restated_and_state_goes(spark):
    p, b = _log(spark, 17, 3)
    base = fresh_dir(spark, "restate")
    name = "default.restate_" + base.rsplit("-", 1)[-1]
    _land(spark, p, b, f"{base}/landing", [(0, 3), (9, 1000)])      # polls 3 to 8 are missing
    q = _live(spark, base, name)
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] == 0  # every session has ended
    exp = ticks(p, b).select(*TICK_COLUMNS).cache()
    assert spark.table(name).count() < exp.count()
    _land(spark, p, b, f"{base}/landing", [(3, 9)], ended=False)
    _live(spark, base, name)
    spark.catalog.refreshTable(name)
    for df in Sinks(name, f"{base}/csv", f"{base}/pq").read(spark).values():
        assert df.count() == exp.count() and df.exceptAll(exp).isEmpty()
    late = spark.read.parquet(f"{base}/ckpt/late")
    assert {r.poll_id for r in late.collect()} <= {r.poll_id for r in p.collect()} and late.where(F.col("outcome") == LATE).count() == late.count() > 0


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv"])
def test_malformed_rows_go_to_quarantine(spark, fmt):
    from tickframe.streaming.run import land_poll_log, start_quarantine
    p, b = _log(spark, 19, 2)
    base = fresh_dir(spark, "bad")
    name = "default.bad_" + base.rsplit("-", 1)[-1]
    landing = land_poll_log(spark, p, b, f"{base}/landing", ended=False, fmt=fmt)
    bad = [("X", None, "2024-01-05"), (None, 5, "2024-01-05")]
    rows = spark.createDataFrame(bad, "symbol string, poll_id long, session_date string")
    rows.write.mode("append").option("header", True).partitionBy("session_date").format(fmt).save(landing)
    day = next(x for x in os.listdir(landing) if x.startswith("session_date="))
    with open(f"{landing}/{day}/broken.{fmt}", "wb") as f:
        f.write(b"PAR1 no parquet" if fmt == "parquet" else b'{"symbol": "X", "poll_id": [broken\n' if fmt == "json" else b"symbol,poll_id\nX,abc,not,a,date\n")
    land_poll_log(spark, p.limit(0), b, f"{base}/landing", fmt=fmt)
    end_markers(poll_event_rows(p, b)).write.mode("append").option("header", True).partitionBy("session_date").format(fmt).save(landing)
    _live(spark, base, name, landing_format=fmt, state_partitions=2)
    assert spark.table(name).count() == ticks(p, b).count() > 0
    start_quarantine(spark, landing, f"{base}/quarantine", f"{base}/ckpt-q", fmt, drain=True).awaitTermination()
    kept = spark.read.parquet(f"{base}/quarantine")
    assert kept.count() == (2 if fmt == "parquet" else 3) and kept.where(F.col("landing_file").contains("session_date=")).count() == kept.count()


def test_a_null_poll_does_not_end_a_session(spark):
    p, b = _log(spark, 23, 2)
    rows = poll_event_rows(p, b)
    base = fresh_dir(spark, "nullpoll")
    part = F.col("poll_id") % 1000 < 10
    rows.where(part).write.parquet(f"{base}/landing")
    rows.limit(1).withColumn("poll_id", F.lit(None).cast("long")).write.mode("append").parquet(f"{base}/landing")
    rows.where(~part).write.mode("append").parquet(f"{base}/landing")
    end_markers(rows).write.mode("append").parquet(f"{base}/landing")
    name = "default.nullpoll_" + base.rsplit("-", 1)[-1]
    _live(spark, base, name, max_files=1, state_partitions=2)
    assert spark.table(name).count() == ticks(p, b).count()
    assert spark.read.parquet(f"{base}/ckpt/late").isEmpty()


def test_exact_dedup_for_any_order(spark):
    from tickframe.streaming.run import bars_writer, stored_bars
    p, b = _log(spark, 9, 4)
    base = fresh_dir(spark, "bars")
    rows = poll_event_rows(p, b).cache()
    write = bars_writer(f"{base}/bars")
    deal = F.pmod(F.xxhash64("symbol", "poll_id", "seq"), F.lit(3))
    for k in (2, 0, 0, 1, 1):  # repeated batches too
        write(rows.where(deal == k), k)
    got = stored_bars(spark, f"{base}/bars").select("symbol", "bar_utc")
    exp = rows.where("bar_utc IS NOT NULL").select("symbol", "bar_utc").distinct()
    assert got.count() == exp.count() > 0 and exp.exceptAll(got).isEmpty()


def test_stream_dedup(spark):
    p, b = _log(spark, 9, 4)
    deal = F.pmod(F.xxhash64("symbol", "poll_id", "seq"), F.lit(3))
    got = stream_dedup(spark, p, b, parts=[deal == k for k in range(3)], max_files=2)
    exp = b.join(p.where("ok"), ["symbol", "poll_id"], "left_semi").select("symbol", "bar_utc").distinct()
    assert got.count() == got.distinct().count() == exp.count()


def test_start_live_processing_time(spark):
    from tickframe.streaming.run import start_live
    p, b = _log(spark, 17, 3)
    base = fresh_dir(spark, "live")
    _land(spark, p, b, f"{base}/landing", [(0, 1000)])
    name = "default.live_" + base.rsplit("-", 1)[-1]
    q = start_live(spark, f"{base}/landing", name, f"{base}/csv", f"{base}/pq", f"{base}/ckpt",
                   every="1 second", table_location=f"{base}/table", late_dir=f"{base}/late", state_partitions=2)
    n, until = ticks(p, b).count(), time.time() + 90
    try:
        # Not processAllAvailable: with time-outs a query runs batches without data and never counts as done.
        while time.time() < until and not (spark.catalog.tableExists(name) and spark.table(name).count() >= n):
            time.sleep(1)
    finally:
        q.stop()
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == n


def test_stream_from_another_working_directory(tmp_path):
    """Python workers import the package shipped by the session, not the driver's working directory."""
    import os
    import subprocess
    import sys
    from conftest import ROOT
    script = tmp_path / "run.py"
    script.write_text(f"""
import sys
sys.path.insert(0, {ROOT!r})
from tickframe.session import get_spark
from tickframe.sources.fixtures import fixture_poll_events
from tickframe.streaming.run import stream_ticks
spark = get_spark("local[2]", 2)
spark.sparkContext.setLogLevel("ERROR")
print("ROWS", stream_ticks(spark, fixture_poll_events(spark, "/root/testdata/sf0.001"), None).count())
""")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True,
                         timeout=600)
    rows = [line for line in out.stdout.splitlines() if line.startswith("ROWS")]
    assert rows and int(rows[0].split()[1]) > 0, out.stderr[-2000:]

"""Run the live pipeline: land a poll log, stream it to the tick sinks."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import DEFAULT, Params
from ..functions.calendar import session_string
from ..plans.ticks import event_ticks
from ..schema import POLL_EVENTS_SCHEMA, TICK_COLUMNS
from ..session import file_system, fresh_dir, materialised
from ..sinks import fanout
from .live import (CLOSED, LATE, OUT_SCHEMA, dedup_bars_stream, end_markers, malformed_events, poll_event_rows, read_landed, read_landing,
                   states_to_ticks, stream_states)

_KEYS = ["symbol", "session_date"]
_SESSIONS = "symbol STRING, session_date DATE, batch BIGINT"


@contextmanager
def _start_settings(spark: SparkSession, state_partitions: int | None = None, drain: bool = False):
    """Settings that are fixed when a new query starts.

    A started query runs on a clone of the session, so the caller's settings are restored right after ``start()``. State
    partitions: by default the cluster's parallelism (one per core), not the batch shuffle setting. A query that works off what has landed
    runs no batches without data (with time-outs they would never end).
    """
    want = {"spark.sql.shuffle.partitions": str(state_partitions or spark.sparkContext.defaultParallelism)}
    if drain:
        want["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    old = {k: spark.conf.get(k, None) for k in want}
    for k, v in want.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def land_poll_log(spark: SparkSession, polls: DataFrame, snaps: DataFrame | None, landing: str,
                  parts: list | None = None, ended: bool = True, fmt: str = "parquet") -> str:
    """Write a poll log to a landing folder in the streaming input layout, one folder per session date.

    ``snaps=None``: ``polls`` already is in the poll-event layout. ``parts``: row
    conditions, landed one after the other (rows of no part are left out); one part by
    default. ``ended``: land the sessions' end markers last.
    """
    rows = polls if snaps is None else poll_event_rows(polls, snaps)
    rows = rows.select(*POLL_EVENTS_SCHEMA.fieldNames(), F.lit(False).alias("ended"))

    def land(df):
        df.hint("rebalance", "session_date").write.mode("append").option("header", True).partitionBy("session_date").format(fmt).save(landing)

    for part in [F.lit(True)] if parts is None else parts:
        land(rows.where(part))
    if ended:
        land(end_markers(rows))
    return landing


def _drain(df: DataFrame, out_dir: str, checkpoint: str, state_partitions: int | None) -> DataFrame:
    """Stream what has landed to a Parquet sink, then stop; the sink's rows."""
    spark = df.sparkSession
    with _start_settings(spark, state_partitions):
        q = (df.writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(out_dir)


def stream_poll_states(spark: SparkSession, polls: DataFrame, snaps: DataFrame | None, p: Params = DEFAULT,
                       parts: list | None = None, max_files: int | None = None, state_partitions: int | None = None) -> DataFrame:
    """Land, stream, and read back the state rows, late ones included."""
    base = fresh_dir(spark, "live")
    landing = land_poll_log(spark, polls, snaps, f"{base}/landing", parts)
    return _drain(stream_states(read_landing(spark, landing, max_files), p), f"{base}/states", f"{base}/checkpoint", state_partitions)


def stream_ticks(spark: SparkSession, polls: DataFrame, snaps: DataFrame | None, p: Params = DEFAULT,
                 parts: list | None = None, max_files: int | None = None, state_partitions: int | None = None) -> DataFrame:
    """Land, stream, and read back the streamed tick table (32 columns)."""
    base = fresh_dir(spark, "live")
    landing = land_poll_log(spark, polls, snaps, f"{base}/landing", parts)
    ticks = states_to_ticks(stream_states(read_landing(spark, landing, max_files), p), p)
    return _drain(ticks, f"{base}/ticks", f"{base}/checkpoint", state_partitions).select(*TICK_COLUMNS)


def stream_dedup(spark: SparkSession, polls: DataFrame, snaps: DataFrame | None, parts: list | None = None,
                 max_files: int | None = None) -> DataFrame:
    """Stream the landing folder through the dedup; read the distinct bars back."""
    base = fresh_dir(spark, "dedup")
    landing = land_poll_log(spark, polls, snaps, f"{base}/landing", parts, ended=False)
    out = dedup_bars_stream(read_landing(spark, landing, max_files)).select("symbol", "bar_utc")
    return _drain(out, f"{base}/bars", f"{base}/checkpoint", None)


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return fs.exists(at)


def known_sessions(spark: SparkSession, path: str) -> DataFrame:
    """(symbol, session_date, batch) noted by micro-batches in a folder."""
    return spark.read.schema(_SESSIONS).parquet(path) if exists(spark, path) else spark.createDataFrame([], _SESSIONS)


def restate(spark: SparkSession, landing: str, sinks: fanout.Sinks, sessions: DataFrame, p: Params = DEFAULT, write_id: str | None = None,
            fmt: str = "parquet") -> bool:
    """Compute the given sessions (symbol, session_date) anew from all that has landed and replace their rows in the three sinks."""
    sessions = materialised(sessions.select(*_KEYS).distinct(), "restate-sessions")
    days = [r[0] for r in sessions.select("session_date").distinct().collect()]  # literals prune the landing's folders
    events = read_landed(spark, landing, fmt).where(F.col("session_date").isin(days)).join(sessions, _KEYS, "left_semi")
    covers = sessions.select("symbol", session_string("session_date").alias("session"))
    return fanout.replace_sessions(spark, event_ticks(events, p, keep=("session_date",)), sinks, "session_date", write_id, covers)


def live_writer(sinks: fanout.Sinks, landing: str, late_dir: str, closed_dir: str, p: Params = DEFAULT, fmt: str = "parquet"):
    """The ``foreachBatch`` function of live mode.

    Ticks of a micro-batch are added to the three sinks. Late rows, and rows of sessions that an earlier batch closed, are stored in
    ``late_dir`` and make their session one that is restated: from then on a micro-batch that touches the session replaces its rows with the batch
    result over all that has landed, so that the sinks end up as if nothing had been late. Every write is keyed by the micro-batch.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, write_id = batch.sparkSession, fanout.live_id(batch, batch_id)
        rows = materialised(batch, "live-batch")
        closed = known_sessions(spark, closed_dir).where(F.col("batch") < batch_id).select(*_KEYS).distinct()
        again = rows.join(closed, _KEYS, "left_semi").select(*_KEYS).distinct().withColumn("_closed", F.lit(True))
        outcome = F.when(F.col("_closed") & (F.col("outcome") != CLOSED), F.lit(LATE)).otherwise(F.col("outcome"))
        rows = rows.join(again, _KEYS, "left").withColumn("outcome", outcome).select(*OUT_SCHEMA.fieldNames())
        rows.where(F.col("outcome") == LATE).write.mode("overwrite").parquet(f"{late_dir}/batch={batch_id}")
        rows.where(F.col("outcome") == CLOSED).select(*_KEYS).write.mode("overwrite").parquet(f"{closed_dir}/batch={batch_id}")
        late = known_sessions(spark, late_dir).select(*_KEYS).distinct()
        touched = materialised(rows.select(*_KEYS).distinct().join(late, _KEYS, "left_semi"), "live-late")
        plain = rows.join(touched, _KEYS, "left_anti")
        fanout.fan_out(spark, states_to_ticks(plain, p, keep=("session_date",)), sinks.table, sinks.csv_dir, sinks.parquet_dir, "session_date",
                       sinks.table_location, sinks.fmt, write_id)
        if not touched.isEmpty():
            restate(spark, landing, sinks, touched, p, f"{write_id}-restated", fmt)
    return write


def start_live(spark: SparkSession, landing: str, table: str, csv_dir: str, parquet_dir: str,
               checkpoint: str, p: Params = DEFAULT, every: str | None = None, table_location: str | None = None,
               late_dir: str | None = None, idle_s: int | None = 600, poll_minutes: int = 1, fmt: str = "parquet",
               max_files: int | None = None, state_partitions: int | None = None, close_s: int = 6 * 3600, landing_format: str = "parquet",
               drain: bool = False):
    """Production live mode: fan each micro-batch out to the three sinks (once per batch id). Returns the query.

    A trigger is a flush: without ``every`` it comes each ``flush_every`` polls of
    ``poll_minutes`` minutes, so that a flush holds up to ``flush_every`` ticks of a
    session. Late rows are kept in ``late_dir`` (beside the checkpoint by default) and their sessions restated. A session's state goes with its
    end marker or after ``close_s`` without data. ``drain``: work off what has landed, then stop.
    """
    states = stream_states(read_landing(spark, landing, max_files, landing_format), p, idle_s, close_s)
    sinks = fanout.Sinks(table, csv_dir, parquet_dir, table_location, fmt)
    write = live_writer(sinks, landing, late_dir or f"{checkpoint}/late", f"{checkpoint}/closed", p, landing_format)
    trigger = {"availableNow": True} if drain else {"processingTime": every or f"{p.flush_every * poll_minutes} minutes"}
    with _start_settings(spark, state_partitions, drain):
        return states.writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoint}/stream").trigger(**trigger).start()


def start_quarantine(spark: SparkSession, landing: str, out_dir: str, checkpoint: str, landing_format: str = "parquet",
                     every: str = "10 minutes", drain: bool = False):
    """Keep the landing's malformed rows as Parquet, with the file each came from. Returns the query."""
    bad = malformed_events(read_landing(spark, landing, fmt=landing_format))
    trigger = {"availableNow": True} if drain else {"processingTime": every}
    return (bad.writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(**trigger).start())


def bars_writer(out_dir: str):
    """A ``foreachBatch`` function that stores every bar (symbol, time) once, whatever the order and distance of its repeats.

    No streaming state: a micro-batch's distinct bars are held against the stored bars of the same days, whose folders alone are read. A
    repeated micro-batch overwrites its own folders.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bars = batch.where(F.col("bar_utc").isNotNull()).select("symbol", "bar_utc").distinct()
        bars = materialised(bars.withColumn("day", F.date_format("bar_utc", "yyyy-MM-dd")), "bars-batch")
        if exists(spark, out_dir):
            days = [r[0] for r in bars.select("day").distinct().collect()]
            held = stored_bars(spark, out_dir).where(F.col("day").isin(days) & (F.col("batch") != batch_id))
            bars = bars.join(held, [bars[c].eqNullSafe(held[c]) for c in ("symbol", "bar_utc")], "left_anti").select("symbol", "bar_utc", "day")
        (bars.withColumn("batch", F.lit(batch_id)).hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day", "batch").parquet(out_dir))
    return write


def stored_bars(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.schema("symbol STRING, bar_utc TIMESTAMP, day STRING, batch BIGINT").parquet(out_dir)


def start_dedup(spark: SparkSession, landing: str, out_dir: str, checkpoint: str, every: str = "1 minute", max_files: int | None = None,
                landing_format: str = "parquet", drain: bool = False):
    """Exact distinct bars of a landing folder with bounded state. Returns the query."""
    trigger = {"availableNow": True} if drain else {"processingTime": every}
    return (read_landing(spark, landing, max_files, landing_format).writeStream.foreachBatch(bars_writer(out_dir))
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())

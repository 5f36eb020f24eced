"""Live mode: the poll log as a stream, the session state in Spark state.

``readStream`` over a landing folder of poll events (one row per returned bar;
a failed poll is one row with NULL ``bar_utc`` and ``ok = false``) ->
``groupBy(symbol, session_date).applyInPandasWithState`` carrying the
collector's session state -> the same JVM-side tick projection as batch mode
-> ``foreachBatch`` fan-out.

Window functions over rows are not available on streams, so the sequential
step runs in the state function. A poll's rows wait in the state until the
poll is complete: until the session has a poll that is newer by
``Params.live_delay_s``, the session's end marker (a row with ``ended``)
has come, or no data came for ``idle_s``. Complete polls are folded in order of
``poll_id`` with array operations. However the input is split into files and
triggers, the result is the batch result as long as no row comes later than
that; rows of polls already folded are not lost either: they are emitted with
outcome ``LATE``.

A session's scalars stay in the state, so nothing restarts it, or, with ``close_s``, go when the session is over: its end marker has come, or
no data came for ``close_s``. Then a row with outcome ``CLOSED`` is emitted, by which the caller knows closed sessions and their later rows
(``streaming/run.live_writer``).

Rows that can't be polls are malformed (``valid_event``): files or lines that can't be read, missing keys, rows without a poll that
are no end marker. They neither stop the stream nor end a session; ``malformed_events`` gives them for quarantine.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.calendar import to_market_time
from ..functions.rounding import WHOLE
from ..operators.features import tick_rows
from ..params import (BAD_PRICE, COLLAPSED, DEFAULT, FETCH_FAILED, GOOD, STALE, VWAP_ALL_POLLS,
                      Params)
from ..schema import LANDING_SCHEMA, POLL_EVENTS_SCHEMA

# Outcome of rows that came after their poll was folded, and of the row that tells that a session's state is gone.
LATE, CLOSED = "LATE", "CLOSED"
# Column of landing lines that could not be parsed.
CORRUPT = "_corrupt"

STATE_SCHEMA = T.StructType([
    T.StructField("last_bar", T.LongType()),        # epoch micros of the last bar seen
    T.StructField("prev_close", T.DoubleType()),
    T.StructField("vwap_num", T.DoubleType()),
    T.StructField("vwap_den", T.DoubleType()),
    T.StructField("streak", T.IntegerType()),
    T.StructField("tick_no", T.IntegerType()),
    T.StructField("aborted", T.BooleanType()),
    T.StructField("last_poll", T.LongType()),
    T.StructField("late", T.LongType()),
    T.StructField("pending", T.BinaryType()),       # rows of incomplete polls, as an Arrow stream
])

OUT_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("session_date", T.DateType()),
    T.StructField("poll_id", T.LongType()),
    T.StructField("fetch_start_us", T.LongType()),
    T.StructField("fetch_end_us", T.LongType()),
    T.StructField("bar_us", T.LongType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("base_outcome", T.StringType()),
    T.StructField("outcome", T.StringType()),
    T.StructField("fail_streak", T.IntegerType()),
    T.StructField("tick_no", T.IntegerType()),
    T.StructField("prev_close", T.DoubleType()),
    T.StructField("vwap_num", T.DoubleType()),
    T.StructField("vwap_den", T.DoubleType()),
    T.StructField("late_polls", T.LongType()),      # late rows of this session so far
])


def _round2(x: float) -> float:
    # HALF_UP at 2 decimals on the value at 6 decimals, as the batch path rounds.
    from decimal import ROUND_HALF_UP, Decimal
    if abs(x) >= WHOLE:
        return x
    d = Decimal(repr(x)).quantize(Decimal("0.000001"), rounding=ROUND_HALF_UP)
    return float(d.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def _nan0(v) -> float:
    return 0.0 if v is None or pd.isna(v) else float(v)


def _picked_per_poll(frame: pd.DataFrame) -> pd.DataFrame:
    """One row per poll (sorted by ``poll_id``) with its last closed bar, vectorised.

    Bars are de-duplicated by time keeping the highest ``seq``; the pick is the
    second newest distinct bar, or the only one. Polls without a bar (failed or
    empty) keep NULL bar fields.
    """
    polls = (frame.sort_values("poll_id", kind="stable")
             .drop_duplicates("poll_id", keep="first")[["poll_id", "ok", "fetch_start_us", "fetch_end_us"]])
    bars = frame[frame["bar_us"].notna()].sort_values(["poll_id", "bar_us", "seq"], kind="stable")
    bars = bars.drop_duplicates(["poll_id", "bar_us"], keep="last")
    newest_rank = bars.groupby("poll_id").cumcount(ascending=False)          # 0 = newest
    n_bars = bars.groupby("poll_id")["bar_us"].transform("size")
    picked = bars[newest_rank.to_numpy() == (n_bars.clip(upper=2) - 1).to_numpy()]
    cols = ["poll_id", "bar_us", "open", "high", "low", "close", "volume"]
    return polls.merge(picked[cols], on="poll_id", how="left").sort_values("poll_id", kind="stable")


_PENDING = ["poll_id", "ok", "seq", "fetch_start_us", "fetch_end_us", "bar_us", "open", "high", "low", "close", "volume"]
_KINDS = {"poll_id": "int64", "ok": "bool", "seq": "float64", "fetch_start_us": "int64", "fetch_end_us": "int64", "bar_us": "float64"}


def _pack(rows: pd.DataFrame) -> bytes | None:
    if rows.empty:
        return None
    import pyarrow as pa
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(data: bytes) -> pd.DataFrame:
    import pyarrow as pa
    return pa.ipc.open_stream(data).read_pandas()


def _ffill(values: np.ndarray, known: np.ndarray, first):
    """Last known value up to and with each place; ``first`` before any."""
    at = np.maximum.accumulate(np.where(known, np.arange(1, len(values) + 1), 0))
    return np.concatenate([[first], values])[at]


def fold(polls: pd.DataFrame, s: dict, p: Params) -> pd.DataFrame:
    """State rows of ordered complete polls (one row each, with the picked bar); updates the scalars ``s``."""
    n = len(polls)
    out = pd.DataFrame({c: polls[c].to_numpy() for c in ("poll_id", "fetch_start_us", "fetch_end_us")})
    has = polls["ok"].to_numpy(bool) & polls["bar_us"].notna().to_numpy()
    bar = np.where(has, polls["bar_us"].fillna(0).to_numpy(), 0).astype(np.int64)
    o, h, l, c, v = (np.where(has, polls[x].fillna(0.0).to_numpy(float), np.nan) for x in ("open", "high", "low", "close", "volume"))
    collapsed = has & (h == l) & (l == o) & (o == c) & (c > 0)
    bad = has & ~collapsed & (c <= 0)
    seen = has & ~((collapsed | bad) if p.stale_against_good_only else np.zeros(n, bool))
    none = np.iinfo(np.int64).min
    upto = _ffill(bar, seen, none if s["last_bar"] is None else s["last_bar"])
    before = np.concatenate([[none if s["last_bar"] is None else s["last_bar"]], upto[:-1]])
    stale = has & ~collapsed & ~bad & (bar == before)
    good = has & ~collapsed & ~bad & ~stale
    base = np.select([~has, collapsed, bad, stale], [FETCH_FAILED, COLLAPSED, BAD_PRICE, STALE], GOOD).astype(object)
    fails = np.cumsum(~has) + s["streak"]
    streak = fails - _ffill(fails, good, 0)
    hit = np.flatnonzero(streak >= p.max_bad_ticks)
    # Polls after the one that reaches the limit are not part of the session.
    live = 0 if s["aborted"] else int(hit[0]) + 1 if len(hit) else n
    weighted = (good | stale) if p.vwap_mode == VWAP_ALL_POLLS else good
    w = np.where(weighted, np.maximum(v, 1.0), 0.0)
    num = np.cumsum(np.concatenate([[s["vwap_num"]], np.where(weighted, (h + l + c) / 3.0 * w, 0.0)]))[1:]
    den = np.cumsum(np.concatenate([[s["vwap_den"]], w]))[1:]
    closes = np.array([_round2(float(x)) if g else np.nan for x, g in zip(c, good)])
    first_close = np.nan if s["prev_close"] is None else s["prev_close"]
    close_upto = _ffill(closes, good, first_close)
    ticks = np.cumsum(good) + s["tick_no"]
    on = np.arange(n) < live
    stored = good & on
    out["bar_us"] = pd.array(np.where(has & on, bar, 0), dtype="Int64")
    out.loc[~(has & on), "bar_us"] = pd.NA
    for name, x in (("open", o), ("high", h), ("low", l), ("close", c), ("volume", v)):
        out[name] = np.where(has & on, x, np.nan)
    out["base_outcome"] = np.where(on, base, None)
    out["outcome"] = np.where(on, base, "AFTER_ABORT")
    out["fail_streak"] = pd.array(np.where(on, streak, 0), dtype="Int32")
    out.loc[~on, "fail_streak"] = pd.NA
    out["tick_no"] = pd.array(np.where(stored, ticks, 0), dtype="Int32")
    out.loc[~stored, "tick_no"] = pd.NA
    out["prev_close"] = np.where(stored, np.concatenate([[first_close], close_upto[:-1]]), np.nan)
    out["vwap_num"] = np.where(stored, num, np.nan)
    out["vwap_den"] = np.where(stored, den, np.nan)
    if live:
        k = live - 1
        s["last_bar"] = None if upto[k] == none else int(upto[k])
        s["prev_close"] = None if np.isnan(close_upto[k]) else float(close_upto[k])
        s.update(vwap_num=float(num[k]), vwap_den=float(den[k]), streak=int(streak[k]), tick_no=int(ticks[k]),
                 aborted=bool(streak[k] >= p.max_bad_ticks))
    s["last_poll"] = int(polls["poll_id"].iloc[-1])
    return out


def make_state_fn(p: Params = DEFAULT, idle_s: int | None = None, close_s: int | None = None):
    names = [f.name for f in STATE_SCHEMA.fields]

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        symbol, session_date = key
        s = dict(zip(names, state.get)) if state.exists else dict(
            last_bar=None, prev_close=None, vwap_num=0.0, vwap_den=0.0, streak=0, tick_no=0, aborted=False, last_poll=None, late=0, pending=None)
        parts = [_unpack(s["pending"])] if s["pending"] else []
        # The first time-out of a session with waiting polls folds them, the next one closes it.
        ended = state.hasTimedOut and close_s is not None and not parts
        fold_all = state.hasTimedOut
        if not state.hasTimedOut:
            for pdf in pdfs:
                ended |= bool(pdf["ended"].fillna(False).astype(bool).any())
                parts.append(pdf.loc[pdf["poll_id"].notna(), _PENDING].astype(_KINDS))
        fold_all |= ended
        rows = pd.concat([x for x in parts if len(x)], ignore_index=True) if any(len(x) for x in parts) else pd.DataFrame(columns=_PENDING)
        outs = []
        if len(rows):
            behind = rows["poll_id"] <= (s["last_poll"] if s["last_poll"] is not None else -2 ** 63)
            if behind.any():
                late = rows[behind]
                s["late"] += len(late)
                late = late[["poll_id", "fetch_start_us", "fetch_end_us", "bar_us", "open", "high", "low", "close", "volume"]].copy()
                late["bar_us"] = late["bar_us"].astype("Int64")
                late["outcome"] = LATE
                outs.append(late)
                rows = rows[~behind]
        if len(rows):
            old = rows["fetch_start_us"] <= rows["fetch_start_us"].max() - p.live_delay_s * 1_000_000
            upto = rows["poll_id"].max() if fold_all else rows.loc[old, "poll_id"].max() if old.any() else None
            if upto is not None:
                ready = rows["poll_id"] <= upto
                outs.append(fold(_picked_per_poll(rows[ready]), s, p))
                rows = rows[~ready]
        s["pending"] = _pack(rows)
        if ended and close_s is not None:
            outs.append(pd.DataFrame({"outcome": [CLOSED]}))
            if state.exists:
                state.remove()
        else:
            state.update(tuple(s[n] for n in names))
            wait = idle_s if s["pending"] and idle_s is not None else close_s
            if wait is not None:
                state.setTimeoutDuration(wait * 1000)
        for out in outs:
            out["symbol"], out["session_date"], out["late_polls"] = symbol, session_date, s["late"]
            yield out.reindex(columns=[f.name for f in OUT_SCHEMA.fields])

    return fn


def _micros(col: str):
    return F.unix_micros(F.col(col))


def poll_event_rows(polls: DataFrame, snaps: DataFrame) -> DataFrame:
    """Batch helper: the landing layout (one row per bar; one NULL-bar row per failed/empty poll)."""
    bar_cols = [c for c in snaps.columns if c not in ("symbol", "poll_id")]
    joined = polls.join(snaps, ["symbol", "poll_id"], "left")
    return joined.select(*[f.name for f in POLL_EVENTS_SCHEMA.fields if f.name in joined.columns
                           or f.name in bar_cols])


def end_markers(events: DataFrame) -> DataFrame:
    """One row per session of a (batch) poll log that tells the stream that the session is over."""
    ends = events.groupBy("symbol", "session_date").agg(F.max("fetch_start").alias("fetch_start"), F.max("fetch_end").alias("fetch_end"))
    return ends.select(*[(F.lit(True) if f.name == "ended" else F.col(f.name) if f.name in ("symbol", "session_date", "fetch_start", "fetch_end")
                          else F.lit(None).cast(f.dataType)).alias(f.name) for f in LANDING_SCHEMA.fields])


def valid_event(events: DataFrame) -> Column:
    """Rows that are a poll's bar, a poll without one, or an end marker."""
    poll = F.col("poll_id").isNotNull() & F.col("ok").isNotNull() & F.col("fetch_start").isNotNull() & F.col("fetch_end").isNotNull()
    fine = F.col("symbol").isNotNull() & F.col("session_date").isNotNull() & (F.coalesce("ended", F.lit(False)) | poll)
    return fine & F.col(CORRUPT).isNull() if CORRUPT in events.columns else fine


def malformed_events(events: DataFrame) -> DataFrame:
    """What ``valid_event`` refuses, with the file it came from."""
    return events.where(~valid_event(events)).withColumn("landing_file", F.input_file_name())


def stream_states(events: DataFrame, p: Params = DEFAULT, idle_s: int | None = None, close_s: int | None = None) -> DataFrame:
    """Streaming poll events -> one state row per complete poll, one per late row and, with ``close_s``, one per session that is over.

    ``idle_s``: fold what waits when a session got no data for so long (wall clock);
    None waits for newer polls or the end marker. ``close_s``: drop a session's state after so long without data, or at its end marker.
    """
    from ..session import ship_package
    ship_package(events.sparkSession)
    if "ended" not in events.columns:
        events = events.withColumn("ended", F.lit(False))
    events = events.where(valid_event(events))
    if p.market_hours_only:
        from ..functions.calendar import is_market_open
        events = events.where(F.col("poll_id").isNull() | is_market_open(to_market_time(F.col("fetch_start"), p), p))
    src = events.select(
        "symbol", "session_date", "poll_id", "ok", "seq", "ended",
        _micros("fetch_start").alias("fetch_start_us"), _micros("fetch_end").alias("fetch_end_us"),
        _micros("bar_utc").alias("bar_us"), "open", "high", "low", "close", "volume")
    timeout = GroupStateTimeout.NoTimeout if idle_s is None and close_s is None else GroupStateTimeout.ProcessingTimeTimeout
    return src.groupBy("symbol", "session_date").applyInPandasWithState(make_state_fn(p, idle_s, close_s), OUT_SCHEMA, STATE_SCHEMA, "append", timeout)


def states_to_ticks(states: DataFrame, p: Params = DEFAULT, keep: tuple = ()) -> DataFrame:
    """The batch tick projection over streamed states (stateless, JVM-side)."""
    s = states.select(
        "symbol", "session_date", "poll_id", "outcome", "tick_no", "prev_close", "vwap_num", "vwap_den",
        F.timestamp_micros("fetch_start_us").alias("fetch_start"),
        F.timestamp_micros("fetch_end_us").alias("fetch_end"),
        to_market_time(F.timestamp_micros("bar_us"), p).alias("bar_ts"),
        "open", "high", "low", "close", "volume")
    return tick_rows(s, p, keep)


def _landing_options(reader, fmt: str):
    if fmt not in ("parquet", "json", "csv"):
        raise ValueError(f"landing format {fmt!r}: parquet, json or csv")
    schema = LANDING_SCHEMA if fmt == "parquet" else T.StructType([*LANDING_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    reader = reader.schema(schema).option("ignoreCorruptFiles", True)
    if fmt != "parquet":
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.option("header", True) if fmt == "csv" else reader


def read_landing(spark: SparkSession, landing: str, max_files: int | None = None, fmt: str = "parquet") -> DataFrame:
    """The landing folder as a stream of poll events (Parquet, JSON lines or CSV with a header). Lines that can't be parsed come with
    ``CORRUPT`` set, unreadable Parquet files are passed over."""
    r = _landing_options(spark.readStream, fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.format(fmt).load(landing)


def read_landed(spark: SparkSession, landing: str, fmt: str = "parquet") -> DataFrame:
    """The polls that have landed, as a batch: valid rows without end markers."""
    rows = _landing_options(spark.read, fmt).format(fmt).load(landing)
    return rows.where(valid_event(rows) & F.col("poll_id").isNotNull()).select(*POLL_EVENTS_SCHEMA.fieldNames())


def dedup_bars_stream(events: DataFrame, delay: str | None = None) -> DataFrame:
    """Drop repeated bars of a bar feed: one row per (symbol, bar time).

    Without ``delay`` every bar time is remembered and the result is DISTINCT for any
    arrival order. With it, state is bounded: repeats further apart than ``delay`` pass
    and older bars are dropped by the watermark. Failed polls carry no bar time and bypass
    the operator (they are not bars).
    """
    bars = events.where(F.col("bar_utc").isNotNull())
    if delay is None:
        return bars.dropDuplicates(["symbol", "bar_utc"])
    return bars.withWatermark("bar_utc", delay).dropDuplicatesWithinWatermark(["symbol", "bar_utc"])

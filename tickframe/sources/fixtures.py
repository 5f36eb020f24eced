"""Poll log derived from the driver's ``events`` table.

The test data holds no market bars, so bars are built from events
(``symbol = event_type``): open / close are the first / last value of the bar
by ``ts``, high / low the extremes, volume the event count. A poll
happens 2 s after bar ``p`` closes and returns bars ``p-1``, ``p`` (the last
closed bar) and ``p+1`` (the live partial bar) when they exist. Failures,
empty responses, duplicate bar times and NaN volumes are injected by fixed
rules on ``(symbol, poll_id)``, so that every poll-log case occurs; no rule
drops a bar or a poll: every event reaches a bar and every bar a poll.

Everything is a DataFrame built from the events scan: a partially aggregated
group-by to bars (map-side combine, so a hot event type costs nothing extra),
then an ``explode`` into snapshots. The same rules are written as SQL text in
:mod:`tickframe.plans.oracle`.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import DEFAULT, Params

# --- fixed values: fixture rules -------------------------------------------
DEFAULT_BAR_MINUTES = 60
POLL_DELAY_SECONDS = 2            # poll starts 2 s after the bar closes
LATENCY_BASE_US = 150_000         # fetch latency = 150 ms + jitter
LATENCY_SPAN_US = 450_000
LATENCY_MUL_POLL, LATENCY_MUL_SYMBOL = 7919, 104729
ERROR_EVERY = 13                  # provider error when (poll_id + len(symbol)) % 13 == 0
OUTAGE_FROM_HOUR = 18             # outage from 18:00 market time ...
OUTAGE_EVERY = 4                  # ... on days with (day_of_month + len(symbol)) % 4 == 0
EMPTY_EVERY = 17                  # empty response when (poll_id + 2*len(symbol)) % 17 == 0
DUP_EVERY = 5                     # a collapsed partial copy precedes bar p when p % 5 == 0
NAN_SYMBOL, NAN_EVERY, NAN_REM = "error", 7, 3   # NaN volume for this symbol when slot % 7 == 3
NO_VOLUME_SYMBOL = "signup"       # volume forced to 0
# ---------------------------------------------------------------------------

# Columns of the driver's ``events`` table the adapter reads (naive UTC timestamps).
EVENTS_READ_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, event_type STRING, value DOUBLE"


def load(spark: SparkSession, sf_dir: str, name: str, schema: str | None = None) -> DataFrame:
    """Read a driver table; with ``schema`` no inference job runs and only those columns are read."""
    r = spark.read.schema(schema) if schema else spark.read
    return r.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events", EVENTS_READ_SCHEMA)


def _epoch_micros_ntz(ts) -> "F.Column":
    """Microseconds since 1970-01-01 00:00 of a naive UTC wall clock, from its fields.

    Built from date and time-of-day fields, so no session time zone (and no
    daylight-saving shift) enters the arithmetic.
    """
    day_us = F.unix_date(F.to_date(ts)).cast("long") * 86_400_000_000
    tod_us = (F.hour(ts) * 3600 + F.minute(ts) * 60).cast("long") * 1_000_000
    sec_us = (F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("long")
    return day_us + tod_us + sec_us


def bars_from_events(events: DataFrame, bar_minutes: int = DEFAULT_BAR_MINUTES) -> DataFrame:
    """OHLCV bars per (event_type, slot); ``slot`` counts bar widths since the epoch (UTC).

    Open / close are ordered by ``(ts, event_id)``, written as one decimal: a
    fixed-width key keeps the aggregation hash-based with a map-side partial
    step (a struct key would force a sort of the whole scan).
    """
    width_us = bar_minutes * 60 * 1_000_000
    micros = _epoch_micros_ntz(F.col("ts")).cast("decimal(18,0)")
    order_key = (micros * F.lit(Decimal(10 ** 19)).cast("decimal(20,0)") + F.col("event_id").cast("decimal(19,0)")).cast("decimal(38,0)")
    bars = (events
            .select(F.col("event_type").alias("symbol"), "ts", "event_id", "value",
                    F.floor(_epoch_micros_ntz(F.col("ts")) / F.lit(width_us)).cast("long").alias("slot"))
            .groupBy("symbol", "slot")
            .agg(F.min_by("value", order_key).alias("open"),
                 F.max("value").alias("high"),
                 F.min("value").alias("low"),
                 F.max_by("value", order_key).alias("close"),
                 F.count(F.lit(1)).alias("n_events")))
    volume = (F.when(F.col("symbol") == NO_VOLUME_SYMBOL, F.lit(0.0))
              .when((F.col("symbol") == NAN_SYMBOL) & (F.col("slot") % NAN_EVERY == NAN_REM),
                    F.lit(float("nan")))
              .otherwise(F.col("n_events").cast("double")))
    return bars.select("symbol", "slot",
                       F.timestamp_seconds(F.col("slot") * (bar_minutes * 60)).alias("bar_utc"),
                       "open", "high", "low", "close", volume.alias("volume"), "n_events")


def _poll_rules(symbol, poll_id, fetch_start_mkt, session_date):
    n = F.length(symbol)
    error = ((poll_id + n) % ERROR_EVERY == 0) | (
        (F.hour(fetch_start_mkt) >= OUTAGE_FROM_HOUR)
        & ((F.dayofmonth(session_date) + n) % OUTAGE_EVERY == 0))
    empty = (poll_id + 2 * n) % EMPTY_EVERY == 0
    return error, empty


def _exploded(bars: DataFrame, bar_minutes: int, p: Params) -> DataFrame:
    """Snapshot rows with their poll's attributes (pure functions of (symbol, poll_id))."""
    width_s = bar_minutes * 60
    # Each bar k is seen by polls k+1 (as the older bar), k (as the last closed
    # bar) and k-1 (as the live bar); e = k - poll_id, seq = 2 * (e + 1).
    # Offset 2 marks the collapsed partial copy that precedes bar k in poll k.
    offs = F.explode(F.when(F.col("slot") % DUP_EVERY == 0, F.array(*[F.lit(i) for i in (-1, 0, 1, 2)]))
                     .otherwise(F.array(*[F.lit(i) for i in (-1, 0, 1)])))
    snaps = bars.select("*", offs.alias("e"))
    dup = F.col("e") == 2
    e = F.when(dup, F.lit(0)).otherwise(F.col("e"))
    snaps = snaps.select(
        "symbol",
        (F.col("slot") - e).alias("poll_id"),
        F.when(dup, F.lit(1)).otherwise(2 * (e + 1)).cast("int").alias("seq"),
        "bar_utc",
        "open",
        *[F.when(dup, F.col("open")).otherwise(F.col(c)).alias(c) for c in ("high", "low", "close")],
        "volume")
    start_s = (F.col("poll_id") + 1) * width_s + POLL_DELAY_SECONDS
    latency_us = LATENCY_BASE_US + (F.col("poll_id") * LATENCY_MUL_POLL
                                    + F.length("symbol") * LATENCY_MUL_SYMBOL) % LATENCY_SPAN_US
    fetch_start_mkt = F.convert_timezone(None, F.lit(p.market_tz), F.timestamp_seconds(start_s))
    session_date = F.to_date(fetch_start_mkt)
    error, empty = _poll_rules(F.col("symbol"), F.col("poll_id"), fetch_start_mkt, session_date)
    return snaps.select("*", session_date.alias("session_date"),
                        F.timestamp_seconds(start_s).alias("fetch_start"),
                        F.timestamp_micros(start_s * 1_000_000 + latency_us).alias("fetch_end"),
                        (~error).alias("ok"), empty.alias("_empty"))


def poll_log(bars: DataFrame, bar_minutes: int = DEFAULT_BAR_MINUTES,
             p: Params = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """``(polls, bar_snapshots)`` in the two-table input schemas of :mod:`tickframe.schema`."""
    x = _exploded(bars, bar_minutes, p)
    polls = (x.groupBy("symbol", "poll_id")
             .agg(*[F.first(c).alias(c) for c in ("session_date", "fetch_start", "fetch_end", "ok")]))
    # A failed fetch or an empty response returns no bars.
    snaps = x.where(F.col("ok") & ~F.col("_empty")).select(
        "symbol", "poll_id", "seq", "bar_utc", "open", "high", "low", "close", "volume")
    return polls, snaps


def poll_events(bars: DataFrame, bar_minutes: int = DEFAULT_BAR_MINUTES,
                p: Params = DEFAULT) -> DataFrame:
    """The single-table layout (as landed for streaming): bar fields NULL for failed / empty polls."""
    x = _exploded(bars, bar_minutes, p)
    returned = F.col("ok") & ~F.col("_empty")
    return x.select("symbol", "poll_id", "session_date", "fetch_start", "fetch_end", "ok",
                    *[F.when(returned, F.col(c)).alias(c)
                      for c in ("seq", "bar_utc", "open", "high", "low", "close", "volume")])


def fixture_poll_log(spark: SparkSession, sf_dir: str, bar_minutes: int = DEFAULT_BAR_MINUTES,
                     p: Params = DEFAULT) -> tuple[DataFrame, DataFrame]:
    events = load_events(spark, sf_dir)
    return poll_log(bars_from_events(events, bar_minutes), bar_minutes, p)


def fixture_poll_events(spark: SparkSession, sf_dir: str, bar_minutes: int = DEFAULT_BAR_MINUTES,
                        p: Params = DEFAULT) -> DataFrame:
    events = load_events(spark, sf_dir)
    return poll_events(bars_from_events(events, bar_minutes), bar_minutes, p)

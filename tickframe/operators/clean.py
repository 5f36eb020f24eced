"""Snapshot cleaning: column names, de-duplication, closed-bar pick, NaN safety.

Both window steps partition by ``(symbol, poll_id)``: one hash exchange of the
snapshots serves the de-duplication, the pick and the following join with the
poll log (the join's sort order is a prefix of the window order, so no extra
sort either). A snapshot holds at most one day of bars, so every window
partition is small whatever the size of the log.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.candle import nan_safe
from ..params import DEFAULT, Params

OHLCV = ("open", "high", "low", "close", "volume")


def normalise_name(name) -> str:
    """First level of a two-level name, lower-cased: ``('Close', '^X')`` or ``"('Close', '^X')"`` -> ``close``."""
    if isinstance(name, tuple):
        name = name[0]
    s = str(name)
    m = re.match(r"^\(\s*'([^']*)'\s*,.*\)$", s)
    return (m.group(1) if m else s).lower()


def normalise_columns(df: DataFrame) -> DataFrame:
    """Flatten two-level provider column names and lower-case them."""
    return df.toDF(*[normalise_name(c) for c in df.columns])


def dedup_keep_last(snaps: DataFrame) -> DataFrame:
    """One row per (symbol, poll_id, bar_utc): the one latest in the response (highest ``seq``)."""
    w = Window.partitionBy("symbol", "poll_id").orderBy(F.desc("bar_utc"), F.desc("seq"))
    prev = F.lag("bar_utc").over(w)
    return (snaps.withColumn("_prev_bar", prev)
            .where(F.col("_prev_bar").isNull() | (F.col("_prev_bar") != F.col("bar_utc")))
            .drop("_prev_bar"))


def last_closed_bar(snaps: DataFrame, dedup: bool = True) -> DataFrame:
    """The last closed bar of each poll: the second newest, or the only one.

    Adds ``bars_in_response`` (distinct bar times in the response).
    """
    d = dedup_keep_last(snaps) if dedup else snaps
    w = Window.partitionBy("symbol", "poll_id").orderBy(F.desc("bar_utc"))
    whole = Window.partitionBy("symbol", "poll_id")
    return (d.withColumn("_rn", F.row_number().over(w))
            .withColumn("bars_in_response", F.count(F.lit(1)).over(whole))
            .where(F.col("_rn") == F.least(F.col("bars_in_response"), F.lit(2)))
            .drop("_rn", "seq"))


def nan_safe_ohlcv(df: DataFrame, cols=OHLCV) -> DataFrame:
    """NaN / NULL / absent OHLCV fields -> 0.0."""
    present = set(df.columns)
    out = [F.col(c) for c in df.columns if c not in cols]
    out += [(nan_safe(c) if c in present else F.lit(0.0)).alias(c) for c in cols]
    return df.select(*out)


def join_polls(polls: DataFrame, picked: DataFrame) -> DataFrame:
    """Every poll with its selected bar (NULL bar for failed / empty polls)."""
    bar_cols = [c for c in picked.columns if c not in ("symbol", "poll_id")]
    return polls.join(picked.select("symbol", "poll_id", *bar_cols), ["symbol", "poll_id"], "left")


def selected_bars(polls: DataFrame, snaps: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Poll log with its cleaned, market-time bar: the input of the session windows."""
    from ..functions.calendar import is_market_open, to_market_time
    if p.market_hours_only:
        polls = polls.where(is_market_open(to_market_time(F.col("fetch_start"), p), p))
    j = join_polls(polls, last_closed_bar(snaps))
    has_bar = F.col("bar_utc").isNotNull() & F.coalesce(F.col("ok"), F.lit(False))
    j = nan_safe_ohlcv(j)
    return j.select(
        "symbol", "poll_id", "session_date", "fetch_start", "fetch_end", "ok",
        has_bar.alias("has_bar"),
        F.when(has_bar, to_market_time(F.col("bar_utc"), p)).alias("bar_ts"),
        *[F.when(has_bar, F.col(c)).alias(c) for c in OHLCV])


def selected_from_poll_events(events: DataFrame, p: Params = DEFAULT, clustered: bool = False) -> DataFrame:
    """Same output as :func:`selected_bars`, from the single-table poll-event layout.

    ``events`` holds one row per returned bar, poll attributes repeated, and a
    NULL ``bar_utc`` for a poll that returned nothing. A poll repeats its day so
    far, so its rows are first cut to the two newest bar times, mostly before
    any shuffle. The few rows left are hash partitioned by ``(symbol,
    session_date)``: the de-duplication and closed-bar windows (by poll) and
    every later session window (by session) are clustered on that partitioning
    and sorted on a prefix of one order; there is no join. ``clustered=True``:
    the input is already hash partitioned by ``(symbol, session_date)`` (a
    bucketed table), so no exchange is planned.
    """
    from ..functions.calendar import to_market_time
    poll = ("symbol", "session_date", "poll_id")
    if p.market_hours_only:
        from ..functions.calendar import is_market_open
        events = events.where(is_market_open(to_market_time(F.col("fetch_start"), p), p))
    # Only the two newest bar times of a poll matter; the rank limit runs before the rows are shuffled.
    newest = Window.partitionBy(*poll).orderBy(F.col("bar_utc").desc_nulls_last())
    two = events.select("*", F.dense_rank().over(newest).alias("_bar_rank")).where(F.col("_bar_rank") <= 2).drop("_bar_rank")
    w = (Window.partitionBy(*poll)
         .orderBy(F.col("bar_utc").desc_nulls_last(), F.col("seq").desc_nulls_last()))
    ev = two if clustered else two.repartition("symbol", "session_date")
    rn = F.row_number().over(w)
    prev = F.lag("bar_utc").over(w)
    d = (ev.select("*", rn.alias("_rn"), prev.alias("_prev"))
         .where((F.col("_rn") == 1) | (F.col("bar_utc").isNotNull() & (F.col("_prev") != F.col("bar_utc")))))
    w2 = Window.partitionBy(*poll).orderBy(F.col("bar_utc").desc_nulls_last())
    whole = Window.partitionBy(*poll)
    picked = (d.select("*", F.row_number().over(w2).alias("_rn2"),
                       F.count("bar_utc").over(whole).alias("_nb"))
              .where(((F.col("_nb") == 0) & (F.col("_rn2") == 1))
                     | (F.col("_rn2") == F.least(F.col("_nb"), F.lit(2)))))
    has_bar = F.col("bar_utc").isNotNull() & F.coalesce(F.col("ok"), F.lit(False))
    j = nan_safe_ohlcv(picked)
    return j.select(
        "symbol", "poll_id", "session_date", "fetch_start", "fetch_end", "ok",
        has_bar.alias("has_bar"),
        F.when(has_bar, to_market_time(F.col("bar_utc"), p)).alias("bar_ts"),
        *[F.when(has_bar, F.col(c)).alias(c) for c in OHLCV])

"""End-to-end batch plans: poll log -> session state -> tick table.

Two input layouts. The single-table poll-event layout (the streaming landing
layout) needs no join: one exchange on ``(symbol, session_date)`` serves the
de-duplication, the closed-bar pick and every session window. The two-table
layout (``polls`` LEFT JOIN ``pick(dedup(bar_snapshots))``) has one exchange
for the snapshots (dedup, pick and join share it) and one for the per-poll
rows. Either way it is one logical plan; Catalyst prunes columns into the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.clean import selected_bars, selected_from_poll_events
from ..operators.features import tick_rows
from ..operators.sessions import poll_outcomes
from ..params import DEFAULT, Params
from ..sources.fixtures import DEFAULT_BAR_MINUTES, fixture_poll_events


def session_states(polls: DataFrame, snaps: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """One row per poll with outcome, streak, tick number, previous close and VWAP sums."""
    return poll_outcomes(selected_bars(polls, snaps, p), p)


def ticks(polls: DataFrame, snaps: DataFrame, p: Params = DEFAULT, keep: tuple = ()) -> DataFrame:
    """The tick table (stored rows only) from a poll log."""
    return tick_rows(session_states(polls, snaps, p), p, keep)


def event_states(events: DataFrame, p: Params = DEFAULT, clustered: bool = False) -> DataFrame:
    """Session states from the single-table poll-event layout (one exchange in all;
    none when ``clustered``, e.g. a table bucketed by ``(symbol, session_date)``)."""
    return poll_outcomes(selected_from_poll_events(events, p, clustered), p)


def event_ticks(events: DataFrame, p: Params = DEFAULT, keep: tuple = (), clustered: bool = False) -> DataFrame:
    return tick_rows(event_states(events, p, clustered), p, keep)


def fixture_states(spark: SparkSession, sf_dir: str, bar_minutes: int = DEFAULT_BAR_MINUTES,
                   p: Params = DEFAULT) -> DataFrame:
    return event_states(fixture_poll_events(spark, sf_dir, bar_minutes, p), p)


def fixture_ticks(spark: SparkSession, sf_dir: str, bar_minutes: int = DEFAULT_BAR_MINUTES,
                  p: Params = DEFAULT, keep: tuple = ()) -> DataFrame:
    return event_ticks(fixture_poll_events(spark, sf_dir, bar_minutes, p), p, keep)

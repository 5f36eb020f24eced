"""Pipeline parameters.

The defaults below are fixed values that must equal the collector we
reproduce for identical results; change them only on purpose.
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace

# --- fixed values (collector defaults) ---------------------------------------
# Market time zone of the stored wall-clock timestamps.
MARKET_TZ = "Asia/Kolkata"
# Weekly expiry weekday, Monday = 0 (1 = Tuesday).
EXPIRY_WEEKDAY = 1
# Rows per periodic flush.
FLUSH_EVERY = 10
# Consecutive failed fetches that end a session.
MAX_BAD_TICKS = 5
# Close-to-close move (fraction of previous close) above which a bar is SPIKE.
SPIKE_PCT = 0.05
# Trading window, minutes since midnight, both ends inclusive: 09:15 and 15:33.
OPEN_MINUTE = 9 * 60 + 15
CLOSE_MINUTE = 15 * 60 + 33
# Session bucket by hour of the bar: 9->1, 10->2, 11->3, 12->4, 13->5, 14->6, 15->6, else 0.
SESSION_BUCKETS = {9: 1, 10: 2, 11: 3, 12: 4, 13: 5, 14: 6, 15: 6}
# Data-quality labels, in the order they are tested.
DQ_BAD_PRICE, DQ_SPIKE, DQ_OK_NO_VOL, DQ_OK = "BAD_PRICE", "SPIKE", "OK_NO_VOL", "OK"
DQ_LABELS = (DQ_BAD_PRICE, DQ_SPIKE, DQ_OK_NO_VOL, DQ_OK)
# -----------------------------------------------------------------------------

# Poll outcomes (ours): one label per poll of the poll log.
FETCH_FAILED, COLLAPSED, BAD_PRICE, STALE, GOOD, AFTER_ABORT = (
    "FETCH_FAILED", "COLLAPSED", "BAD_PRICE", "STALE", "GOOD", "AFTER_ABORT")
OUTCOMES = (FETCH_FAILED, COLLAPSED, BAD_PRICE, STALE, GOOD, AFTER_ABORT)

# VWAP accumulation modes: only stored ticks, or every poll whose bar passed
# the collapsed / bad-price guards (stale repeats included, as the collector does).
VWAP_GOOD_ONLY = "good_only"
VWAP_ALL_POLLS = "all_polls"


def _broken_rule(value, rule) -> str | None:
    """What is wrong with a value, or None."""
    if value is None:
        return None if rule["optional"] else "missing"
    if value == "":
        return "empty"
    if rule["choices"] and value not in rule["choices"]:
        return "choose from " + ", ".join(rule["choices"])
    if rule["low"] is not None and value < rule["low"]:
        return f"smallest is {rule['low']}"
    if rule["high"] is not None and value > rule["high"]:
        return f"largest is {rule['high']}"
    return None


def _setting(default, low=None, high=None, choices=None, optional=False):
    """A parameter with its rule: inclusive bounds, a set of choices, and whether None is allowed."""
    return field(default=default, metadata={"low": low, "high": high, "choices": choices, "optional": optional})


@dataclass(frozen=True)
class Params:
    """Immutable parameter set; every field is checked against its own rule when an instance is made."""

    market_tz: str = _setting(MARKET_TZ)
    # Fixed ranges of the collector: weekday 0..4, counts from 1, spike 0.001..0.5.
    expiry_weekday: int = _setting(EXPIRY_WEEKDAY, 0, 4)
    flush_every: int = _setting(FLUSH_EVERY, 1)
    max_bad_ticks: int = _setting(MAX_BAD_TICKS, 1)
    spike_pct: float = _setting(SPIKE_PCT, 0.001, 0.5)
    open_minute: int = _setting(OPEN_MINUTE, 0, 24 * 60 - 1)
    close_minute: int = _setting(CLOSE_MINUTE, 0, 24 * 60 - 1)
    vwap_mode: str = _setting(VWAP_ALL_POLLS, choices=(VWAP_GOOD_ONLY, VWAP_ALL_POLLS))
    # Stale test against the last bar of any poll that returned one (collector
    # behaviour) or only against the last stored tick.
    stale_against_good_only: bool = _setting(False)
    # Keep only polls started inside market hours (the collector never polls
    # outside them); off by default: a poll log holds what was polled.
    market_hours_only: bool = _setting(False)
    # Split each session's sequential scan into chunks of this many poll ids
    # (parallel prefix scan); None = one window partition per session.
    session_chunk_polls: int | None = _setting(None, 1, optional=True)
    # Live mode: a poll is folded once a poll of its session is newer by this many seconds (or the
    # session's end marker has come); rows of polls already folded go to the late output.
    live_delay_s: int = _setting(120, 0)

    def __post_init__(self) -> None:
        wrong = [f"{f.name}={getattr(self, f.name)!r} ({why})" for f in fields(self)
                 if (why := _broken_rule(getattr(self, f.name), f.metadata))]
        if not wrong and self.open_minute > self.close_minute:
            wrong.append(f"open_minute={self.open_minute} is after close_minute={self.close_minute}")
        if wrong:
            raise ValueError("cannot use " + ", ".join(wrong))

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


DEFAULT = Params()

"""Calendar, expiry and market-hours expressions on wall-clock timestamps.

All inputs are market wall-clock values (``TIMESTAMP_NTZ`` or ``DATE``), so
none of these depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import DEFAULT, SESSION_BUCKETS, Params

WEEKEND, PAST_CLOSE, OPEN, WAIT = "WEEKEND", "PAST_CLOSE", "OPEN", "WAIT"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_market_time(ts, p: Params = DEFAULT) -> Column:
    """Instant -> market wall clock (``TIMESTAMP_NTZ``).

    ``TIMESTAMP`` input is an instant; ``TIMESTAMP_NTZ`` input is read as UTC
    wall clock (a naive provider index is UTC). Both paths are independent of
    the session time zone.
    """
    return F.convert_timezone(None, F.lit(p.market_tz), _c(ts))


def utc_wall_to_market_time(ts_ntz, p: Params = DEFAULT) -> Column:
    """Naive UTC wall clock (``TIMESTAMP_NTZ``) -> market wall clock."""
    return F.convert_timezone(F.lit("UTC"), F.lit(p.market_tz), _c(ts_ntz))


def weekday(d) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(d))


def week_of_month(d) -> Column:
    """Which block of seven days of its month a date lies in, counted from one."""
    return ((F.dayofmonth(_c(d)) - 1) / 7).cast("int") + 1


def session_number(hour) -> Column:
    """Intraday session bucket 0-6 from the hour."""
    h = _c(hour)
    expr = None
    for k, v in sorted(SESSION_BUCKETS.items()):
        expr = (F.when(h == k, F.lit(v)) if expr is None else expr.when(h == k, F.lit(v)))
    return expr.otherwise(F.lit(0)).cast("int")


def is_expiry(d, p: Params = DEFAULT) -> Column:
    return (weekday(d) == p.expiry_weekday).cast("int")


def days_to_expiry(d, p: Params = DEFAULT) -> Column:
    """How many days ahead the configured expiry weekday lies; an expiry day itself gives zero."""
    return F.pmod(F.lit(p.expiry_weekday) - weekday(d), F.lit(7)).cast("int")


def last_expiry_of_month(d, p: Params = DEFAULT) -> Column:
    """Date of the last expiry weekday in the month of ``d``."""
    last = F.last_day(F.to_date(_c(d)))
    return F.date_sub(last, F.pmod(F.weekday(last) - F.lit(p.expiry_weekday), F.lit(7)))


def is_monthly_expiry(d, p: Params = DEFAULT) -> Column:
    day = F.to_date(_c(d))
    return ((weekday(day) == p.expiry_weekday) & (day == last_expiry_of_month(day, p))).cast("int")


def hhmm(ts) -> Column:
    """``HH:mm`` of a wall-clock timestamp, from its fields (no time-zone round trip)."""
    t = _c(ts)
    return F.format_string("%02d:%02d", F.hour(t), F.minute(t))


def session_string(d) -> Column:
    """``yyyy_MM_dd`` label of a session date, from its fields."""
    x = _c(d)
    return F.format_string("%04d_%02d_%02d", F.year(x), F.month(x), F.dayofmonth(x))


def minute_of_day(ts) -> Column:
    t = _c(ts)
    return F.hour(t) * 60 + F.minute(t)


def is_market_open(ts, p: Params = DEFAULT) -> Column:
    """Mon-Fri and open <= minute-of-day <= close (both inclusive), on wall clock."""
    t = _c(ts)
    return (weekday(t) < 5) & minute_of_day(t).between(p.open_minute, p.close_minute)


def _at_minute(ts, minute_of_day_value: int) -> Column:
    t = _c(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t),
                                F.lit(minute_of_day_value // 60), F.lit(minute_of_day_value % 60),
                                F.lit(0))


def session_open(ts, p: Params = DEFAULT) -> Column:
    """The day's opening instant (wall clock) of the day of ``ts``."""
    return _at_minute(ts, p.open_minute)


def session_close(ts, p: Params = DEFAULT) -> Column:
    return _at_minute(ts, p.close_minute)


def market_state(ts, p: Params = DEFAULT) -> Column:
    """WEEKEND / PAST_CLOSE / OPEN / WAIT, tested in that order (the wait loop's view)."""
    t = _c(ts)
    return (F.when(weekday(t) >= 5, F.lit(WEEKEND))
            .when(t >= session_close(t, p), F.lit(PAST_CLOSE))
            .when(t >= session_open(t, p), F.lit(OPEN))
            .otherwise(F.lit(WAIT)))


def seconds_between(start, end) -> Column:
    """``end - start`` in seconds (DOUBLE), microsecond exact."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(1e6)


def seconds_to_open(ts, p: Params = DEFAULT) -> Column:
    t = _c(ts)
    return F.greatest(F.lit(0.0), seconds_between(t, session_open(t, p)))

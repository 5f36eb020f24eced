"""The 32-column tick table: calendar, candle, session and quality features.

One projection over the stored (GOOD) polls; every expression is a built-in,
so the whole step stays in one whole-stage-codegen stage after the session
window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import candle as cd
from ..functions.quality import data_quality
from ..functions.rounding import round_half_up
from ..params import DEFAULT, GOOD, Params
from ..schema import TICK_COLUMNS, TICK_SCHEMA
from .sessions import running_vwap


def fetch_latency_ms(start="fetch_start", end="fetch_end"):
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return round_half_up(F.timestamp_diff("MICROSECOND", s, e) / F.lit(1000.0), 1)



def candle_columns(o="open", h="high", l="low", c="close") -> dict:
    rng = cd.price_range(h, l)
    return {"price_range": rng,
            "return_pct": cd.return_pct(o, c),
            "body_pct": cd.body_pct(o, c, rng),
            "upper_shadow": cd.upper_shadow(o, h, c),
            "lower_shadow": cd.lower_shadow(o, l, c),
            "hl_ratio": cd.hl_ratio(h, l)}


def tick_rows(state: DataFrame, p: Params = DEFAULT, keep: tuple = ()) -> DataFrame:
    """Stored ticks (outcome GOOD) projected to the tick schema, plus ``keep`` columns.

    Two projections: the first computes shared intermediates once (market-time
    tick timestamp, bar date, rounded range), the second the output columns;
    the optimizer collapses them into one codegen stage.
    """
    g = state.where(F.col("outcome") == GOOD).select(
        "*", cal.to_market_time(F.col("fetch_end"), p).alias("tick_ts"),
        F.to_date("bar_ts").alias("_d"), cd.price_range("high", "low").alias("_rng"))
    d, rng = F.col("_d"), F.col("_rng")
    o, h, l, c = "open", "high", "low", "close"
    cols = {
        "tick_ts": F.col("tick_ts"),
        "bar_ts": F.col("bar_ts"),
        "tick_time_str": cal.hhmm("tick_ts"),
        "bar_time_str": cal.hhmm("bar_ts"),
        "symbol": F.col("symbol"),
        "year": F.year("bar_ts"), "month": F.month("bar_ts"), "date": F.dayofmonth("bar_ts"),
        "day": cal.weekday(d), "hour": F.hour("bar_ts"), "minute": F.minute("bar_ts"),
        "week_of_month": cal.week_of_month(d),
    }
    for name, scale in {"open": 2, "high": 2, "low": 2, "close": 2, "volume": 0}.items():
        cols[name] = round_half_up(F.col(name), scale)
    cols.update({
        "typical_price": round_half_up(cd.typical_price(h, l, c), 2),
        "vwap": round_half_up(running_vwap(), 2),
        "price_range": rng,
        "return_pct": cd.return_pct(o, c),
        "log_return": cd.log_return(c, "prev_close"),
        "body_pct": cd.body_pct(o, c, rng),
        "upper_shadow": cd.upper_shadow(o, h, c),
        "lower_shadow": cd.lower_shadow(o, l, c),
        "hl_ratio": cd.hl_ratio(h, l),
        "session_number": cal.session_number(F.hour("bar_ts")),
        "expiry": cal.is_expiry(d, p),
        "is_monthly_expiry": cal.is_monthly_expiry(d, p),
        "days_to_expiry": cal.days_to_expiry(d, p),
        "data_quality": data_quality(c, "volume", "prev_close", p),
        "fetch_latency_ms": fetch_latency_ms(),
    })
    types = {f.name: f.dataType for f in TICK_SCHEMA.fields}
    out = [cols[n].cast(types[n]).alias(n) for n in TICK_COLUMNS]
    return g.select(*out, *keep)

"""Candle (price-derived) features. Inputs are the unrounded NaN-safe OHLCV values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rounding import round_half_up


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_safe(c) -> Column:
    """NULL or NaN -> 0.0 (a missing field in a bar reads as 0)."""
    return F.coalesce(F.nanvl(_c(c).cast("double"), F.lit(0.0)), F.lit(0.0))


def typical_price(h, l, c) -> Column:
    return (_c(h) + _c(l) + _c(c)) / F.lit(3.0)


def price_range(h, l) -> Column:
    return round_half_up(_c(h) - _c(l), 2)


def return_pct(o, c) -> Column:
    o, c = _c(o), _c(c)
    return F.when(o > 0, round_half_up((c - o) / o * 100, 4)).otherwise(F.lit(0.0))


def body_pct(o, c, rounded_range) -> Column:
    """|close - open| over the *rounded* range, in percent; 0 when the range is 0."""
    o, c, r = _c(o), _c(c), _c(rounded_range)
    return F.when(r > 0, round_half_up(F.abs(c - o) / r * 100, 2)).otherwise(F.lit(0.0))


def upper_shadow(o, h, c) -> Column:
    return round_half_up(_c(h) - F.greatest(_c(o), _c(c)), 2)


def lower_shadow(o, l, c) -> Column:
    return round_half_up(F.least(_c(o), _c(c)) - _c(l), 2)


def hl_ratio(h, l) -> Column:
    h, l = _c(h), _c(l)
    return F.when(l > 0, round_half_up(h / l, 6)).otherwise(F.lit(1.0))


def log_return(c, prev_close) -> Column:
    """ln(close / previous stored close); 0 without a positive previous close."""
    c, p = _c(c), _c(prev_close)
    return (F.when(p.isNotNull() & (p > 0) & (c > 0), round_half_up(F.log(c / p), 6))
            .otherwise(F.lit(0.0)))


def vwap_weight(v) -> Column:
    """max(volume, 1): an index with zero volume still advances the VWAP."""
    return F.greatest(_c(v), F.lit(1.0))


def is_collapsed(o, h, l, c) -> Column:
    """high == low == open == close with a positive close."""
    o, h, l, c = _c(o), _c(h), _c(l), _c(c)
    return (h == l) & (l == o) & (o == c) & (c > 0)


def is_bad_price(c) -> Column:
    return _c(c) <= 0

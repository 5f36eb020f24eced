"""Data-quality label of a stored bar, and small string helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import DEFAULT, DQ_BAD_PRICE, DQ_OK, DQ_OK_NO_VOL, DQ_SPIKE, Params


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def data_quality(close, volume, prev_close, p: Params = DEFAULT) -> Column:
    """BAD_PRICE, SPIKE, OK_NO_VOL, OK: the first rule that holds.

    SPIKE needs a positive previous close, so the first bar of a session never is.
    The move is strict: exactly ``spike_pct`` is not a spike.
    """
    c, v, pc = _c(close), _c(volume), _c(prev_close)
    spike = pc.isNotNull() & (pc > 0) & (F.abs(c - pc) / pc > F.lit(p.spike_pct))
    return (F.when(c <= 0, F.lit(DQ_BAD_PRICE))
            .when(F.coalesce(spike, F.lit(False)), F.lit(DQ_SPIKE))
            .when(v == 0, F.lit(DQ_OK_NO_VOL))
            .otherwise(F.lit(DQ_OK)))


def quality_ok(label) -> Column:
    return _c(label).isin(DQ_OK, DQ_OK_NO_VOL)


def symbol_safe(symbol) -> Column:
    """File-safe symbol: drop '^', replace '.' with '_'."""
    return F.replace(F.replace(_c(symbol), F.lit("^"), F.lit("")), F.lit("."), F.lit("_"))

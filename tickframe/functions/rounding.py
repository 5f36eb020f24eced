"""Deterministic decimal rounding shared by the library and its SQL oracles.

``F.round`` on a DOUBLE rounds the shortest decimal text HALF_UP, DuckDB
rounds the binary value, Python rounds the exact binary value: near-ties then
differ between engines. Casting to a DECIMAL with four guard digits first,
then rounding HALF_UP, gives one answer on every engine. From 2**52 on a DOUBLE
holds whole numbers only, so there it is its own rounding; below, 38 digits hold
every value at any scale used here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

GUARD_DIGITS = 4
PRECISION = 38
# Doubles of this magnitude and above have no fraction.
WHOLE = 4503599627370496.0


def guard_type(scale: int) -> DecimalType:
    return DecimalType(PRECISION, scale + GUARD_DIGITS)


def round_half_up(c: Column, scale: int) -> Column:
    """Round to ``scale`` decimals HALF_UP via a guarded decimal; DOUBLE result, NaN and NULL as they are."""
    whole = F.isnan(c) | (F.abs(c) >= WHOLE)
    return F.when(whole, c.cast("double")).otherwise(
        F.round(F.when(~whole, c).cast(guard_type(scale)), scale).cast("double"))


def sql_round(expr: str, scale: int) -> str:
    """The same rounding as SQL text (Spark SQL and DuckDB accept it)."""
    whole = f"(isnan(CAST(({expr}) AS DOUBLE)) OR abs(CAST(({expr}) AS DOUBLE)) >= {WHOLE:.1f})"
    return (f"CASE WHEN {whole} THEN CAST(({expr}) AS DOUBLE) ELSE CAST(ROUND(CAST((CASE WHEN NOT {whole} THEN ({expr}) END)"
            f" AS DECIMAL({PRECISION},{scale + GUARD_DIGITS})), {scale}) AS DOUBLE) END")

"""Explicit schemas: the poll log we read and the tick table we write."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: tick table layout (column order and types) -----------------
TICK_FIELDS = [
    ("tick_ts", T.TimestampNTZType()),
    ("bar_ts", T.TimestampNTZType()),
    ("tick_time_str", T.StringType()),
    ("bar_time_str", T.StringType()),
    ("symbol", T.StringType()),
    ("year", T.IntegerType()),
    ("month", T.IntegerType()),
    ("date", T.IntegerType()),
    ("day", T.IntegerType()),
    ("hour", T.IntegerType()),
    ("minute", T.IntegerType()),
    ("week_of_month", T.IntegerType()),
    ("open", T.DoubleType()),
    ("high", T.DoubleType()),
    ("low", T.DoubleType()),
    ("close", T.DoubleType()),
    ("volume", T.DoubleType()),
    ("typical_price", T.DoubleType()),
    ("vwap", T.DoubleType()),
    ("price_range", T.DoubleType()),
    ("return_pct", T.DoubleType()),
    ("log_return", T.DoubleType()),
    ("body_pct", T.DoubleType()),
    ("upper_shadow", T.DoubleType()),
    ("lower_shadow", T.DoubleType()),
    ("hl_ratio", T.DoubleType()),
    ("session_number", T.IntegerType()),
    ("expiry", T.IntegerType()),
    ("is_monthly_expiry", T.IntegerType()),
    ("days_to_expiry", T.IntegerType()),
    ("data_quality", T.StringType()),
    ("fetch_latency_ms", T.DoubleType()),
]
# Integer columns of the tick table.
INT_COLUMNS = ["year", "month", "date", "day", "hour", "minute", "week_of_month",
               "session_number", "expiry", "is_monthly_expiry", "days_to_expiry"]
# Columns the older table layout lacks.
LEGACY_MISSING = ["bar_ts", "bar_time_str"]
# Columns and order of the post-session day check.
DAY_CHECK_COLUMNS = ["tick_ts", "bar_ts", "tick_time_str", "bar_time_str", "open", "high", "low",
                     "close", "vwap", "log_return", "price_range", "session_number", "expiry",
                     "days_to_expiry", "data_quality", "fetch_latency_ms"]
# Table partition columns.
PARTITION_COLUMNS = ["year", "month", "date"]
# -----------------------------------------------------------------------------

TICK_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in TICK_FIELDS])
TICK_COLUMNS = [n for n, _ in TICK_FIELDS]
LEGACY_TICK_SCHEMA = T.StructType([f for f in TICK_SCHEMA.fields if f.name not in LEGACY_MISSING])

POLLS_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("poll_id", T.LongType(), False),
    T.StructField("session_date", T.DateType(), True),
    T.StructField("fetch_start", T.TimestampType(), True),
    T.StructField("fetch_end", T.TimestampType(), True),
    T.StructField("ok", T.BooleanType(), True),
])

BAR_SNAPSHOTS_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("poll_id", T.LongType(), False),
    T.StructField("seq", T.IntegerType(), True),
    T.StructField("bar_utc", T.TimestampType(), True),
    T.StructField("open", T.DoubleType(), True),
    T.StructField("high", T.DoubleType(), True),
    T.StructField("low", T.DoubleType(), True),
    T.StructField("close", T.DoubleType(), True),
    T.StructField("volume", T.DoubleType(), True),
])

# Streaming input: one row per (poll, bar); failed polls carry one row with
# NULL bar_utc and ok = false. A row with ``ended`` tells that its session is over.
POLL_EVENTS_SCHEMA = T.StructType(
    [f for f in POLLS_SCHEMA.fields]
    + [f for f in BAR_SNAPSHOTS_SCHEMA.fields if f.name not in ("symbol", "poll_id")])
LANDING_SCHEMA = T.StructType([*POLL_EVENTS_SCHEMA.fields, T.StructField("ended", T.BooleanType(), True)])


def conform(df, schema: T.StructType = TICK_SCHEMA):
    """Project ``df`` onto ``schema`` by name: cast present columns, NULL for absent ones."""
    from pyspark.sql import functions as F
    cols = set(df.columns)
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in cols else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])

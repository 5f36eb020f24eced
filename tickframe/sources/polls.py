"""Poll-log sources: landing folders read with explicit schemas, or rows.

The collector's input was a provider response; ours is a stored poll log
(``polls`` and ``bar_snapshots``, see :mod:`tickframe.schema`). Reading
always uses the declared schema: no inference pass over the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import BAR_SNAPSHOTS_SCHEMA, POLLS_SCHEMA, TICK_SCHEMA


def with_symbol(df: DataFrame, symbol: str) -> DataFrame:
    """Single-symbol logs: add the constant ``symbol`` column when the data has none."""
    if "symbol" in df.columns:
        return df
    return df.select(F.lit(symbol).alias("symbol"), "*")


def read_poll_log(spark: SparkSession, polls_path: str, snaps_path: str,
                  fmt: str = "parquet", symbol: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(polls, bar_snapshots)`` from a landing folder (parquet, json or csv).

    ``symbol``: the log is of one symbol and its files carry no ``symbol`` column.
    """
    def rd(schema, path):
        if symbol is not None:
            schema = T.StructType([f for f in schema.fields if f.name != "symbol"])
        r = spark.read.schema(schema)
        if fmt == "csv":
            r = r.option("header", True)
        df = r.format(fmt).load(path)
        return with_symbol(df, symbol) if symbol is not None else df
    return rd(POLLS_SCHEMA, polls_path), rd(BAR_SNAPSHOTS_SCHEMA, snaps_path)


def poll_log_from_rows(spark: SparkSession, polls: list, snaps: list) -> tuple[DataFrame, DataFrame]:
    """Small in-memory poll logs (tests, examples)."""
    return (spark.createDataFrame(polls, POLLS_SCHEMA),
            spark.createDataFrame(snaps, BAR_SNAPSHOTS_SCHEMA))


def ticks_from_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Tick rows (dicts; timestamps as datetimes or ISO strings) -> the tick schema."""
    names = TICK_SCHEMA.fieldNames()
    df = spark.createDataFrame([[r.get(n) for n in names] for r in rows],
                               ", ".join(f"`{n}` string" for n in names))
    out = []
    for f in TICK_SCHEMA.fields:
        c = F.col(f.name)
        if f.dataType.typeName() == "timestamp_ntz":
            out.append(F.to_timestamp_ntz(c).alias(f.name))
        else:
            out.append(c.cast(f.dataType).alias(f.name))
    return df.select(*out)


BUCKET_KEYS = ("symbol", "session_date")


def save_poll_events_bucketed(df: DataFrame, table: str, buckets: int, location: str | None = None) -> None:
    """Persist a poll-event log bucketed by ``(symbol, session_date)``, sorted by poll.

    A scan of this table is already hash partitioned the way the tick plan needs,
    so :func:`tickframe.plans.ticks.event_ticks` with ``clustered=True`` runs
    without any exchange after the scan. Choose ``buckets`` so one bucket is
    about one task's worth of data (~128 MB).
    """
    w = (df.write.mode("overwrite").format("parquet")
         .bucketBy(buckets, *BUCKET_KEYS).sortBy(*BUCKET_KEYS, "poll_id"))
    if location:
        w = w.option("path", location)
    w.saveAsTable(table)

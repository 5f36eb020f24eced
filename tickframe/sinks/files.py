"""File sinks and sources of the tick table: CSV and Parquet datasets.

The collector kept one CSV and one Parquet file per (symbol, session) and rewrote the Parquet file whole at every flush. Here both are
datasets with one folder a session day, ``session=<yyyy_MM_dd>/attempt=<a>/``, all symbols inside (``symbol`` and the file-safe
``symbol_safe`` are columns, so symbols that look alike in a file name never meet). A write adds part files; a ledger (``sinks/ledger.py``)
says which of them readers see. Writing the same id again changes nothing, a different id adds rows to the session.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import session_string
from ..functions.quality import symbol_safe
from ..schema import TICK_SCHEMA, conform
from .ledger import Ledger, published

FILE_PARTITIONS = ["session", "attempt"]
_CSV_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def with_file_keys(df: DataFrame, session_col: str | None = None) -> DataFrame:
    """Add the file-safe symbol and the session label.

    Without a session column the session is the collection day (``tick_ts``),
    as the collector named its daily files; older rows lack ``bar_ts`` anyway.
    """
    sess = F.col(session_col) if session_col else F.to_date(F.col("tick_ts"))
    keyed = df.withColumn("symbol_safe", symbol_safe("symbol")).withColumn("session", session_string(sess))
    return keyed.drop(session_col) if session_col and session_col not in TICK_SCHEMA.fieldNames() else keyed


def _writer(keyed: DataFrame, attempt: str):
    # Sorted by symbol: a reader of few symbols skips most row groups.
    rows = keyed.withColumn("attempt", F.lit(attempt)).hint("rebalance", "session").sortWithinPartitions("session", "symbol", "tick_ts")
    return rows.write.mode("append").partitionBy(*FILE_PARTITIONS)


def add_csv(keyed: DataFrame, path: str, attempt: str) -> None:
    """An attempt's rows as CSV with a header line in every part file (the reader drops it); columns that older rows lack are empty."""
    keyed = conform(keyed, T.StructType([*TICK_SCHEMA.fields, *(T.StructField(c, T.StringType()) for c in ("symbol_safe", "session"))]))
    _writer(keyed, attempt).option("header", True).option("timestampNTZFormat", _CSV_TIME).csv(path)


def add_parquet(keyed: DataFrame, path: str, attempt: str) -> None:
    """An attempt's rows as snappy Parquet."""
    _writer(keyed, attempt).option("compression", "snappy").parquet(path)


def _write(df: DataFrame, path: str, session_col: str | None, write_id: str | None, replace: bool, add) -> bool:
    """One dataset with a ledger of its own: stage, then publish. False if the id was published before."""
    spark = df.sparkSession
    ledger = Ledger.start(spark, path)
    write_id = write_id or uuid.uuid4().hex
    keyed = with_file_keys(df, session_col)
    while not ledger.committed(write_id):
        as_of, attempt = ledger.last(), ledger.new_attempt(write_id)
        add(keyed, path, attempt)
        ledger.stage_sessions(attempt, keyed)
        if ledger.commit(as_of + 1, write_id, attempt, as_of if replace else -1):
            return True
    return False


def write_csv(df: DataFrame, path: str, session_col: str | None = None, write_id: str | None = None, replace: bool = False) -> bool:
    """Append rows to the CSV dataset (or replace their sessions); a ``write_id`` given again changes nothing."""
    return _write(df, path, session_col, write_id, replace, add_csv)


def write_parquet(df: DataFrame, path: str, session_col: str | None = None, write_id: str | None = None, replace: bool = False) -> bool:
    """Append rows to the Parquet dataset (or replace their sessions); a ``write_id`` given again changes nothing."""
    return _write(df, path, session_col, write_id, replace, add_parquet)


def _with_keys(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(c, T.StringType()) for c in ("symbol_safe", *FILE_PARTITIONS)])


def _read(spark: SparkSession, path: str, upto: int | None, load) -> DataFrame:
    ledger = Ledger.of(spark, path)
    rows = load(path)
    return rows if ledger is None else published(rows, ledger, upto)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = TICK_SCHEMA, upto: int | None = None) -> DataFrame:
    """Published rows of the CSV dataset, or all rows of plain CSV files, with an explicit schema (no inference)."""
    keyed = Ledger.of(spark, path) is not None
    reader = spark.read.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
    return _read(spark, path, upto, reader.schema(_with_keys(schema) if keyed else schema).csv)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType = TICK_SCHEMA, upto: int | None = None) -> DataFrame:
    """Published rows of the Parquet dataset with an explicit schema: columns that older files lack are NULL, no footers are merged."""
    return _read(spark, path, upto, spark.read.schema(_with_keys(schema)).parquet)


def strip_keys(df: DataFrame, schema: T.StructType = TICK_SCHEMA) -> DataFrame:
    """Back to the tick layout (folder keys dropped, types as in ``schema``)."""
    cols = set(df.columns)
    return df.select(*[(F.col(f.name).cast(f.dataType) if f.name in cols
                        else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])

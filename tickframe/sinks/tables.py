"""Catalog table management: create, inspect, evolve, conform, append.

The tick table is a Parquet table partitioned by ``(year, month, date)``;
Delta is used when its jars are on the classpath (``fmt="delta"``). Appends
resolve columns by name, after the table has been evolved to hold every
column of the frame, so older layouts keep working (old rows read NULL in new
columns).
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import PARTITION_COLUMNS, TICK_SCHEMA, conform
from .ledger import Ledger, visible_sql

# Days of a batch that become literals one by one.
MOST_DAYS = 400


def database_of(table: str) -> str:
    return table.rsplit(".", 1)[0] if "." in table else "default"


def ensure_database(spark: SparkSession, table: str, location: str | None = None) -> str:
    """``CREATE DATABASE IF NOT EXISTS`` for the table's database (``default`` if unqualified)."""
    db = database_of(table)
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{loc}")
    return db


def ddl_columns(schema: T.StructType) -> str:
    return ",\n  ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)


def create_tick_table(spark: SparkSession, table: str, location: str | None = None,
                      schema: T.StructType = TICK_SCHEMA, fmt: str = "parquet", partitions=PARTITION_COLUMNS) -> None:
    """``CREATE TABLE IF NOT EXISTS`` partitioned by ``(year, month, date)``."""
    ensure_database(spark, table)
    loc = f"\nLOCATION '{location}'" if location else ""
    spark.sql(f"""CREATE TABLE IF NOT EXISTS {table} (
  {ddl_columns(schema)}
)
USING {fmt}
PARTITIONED BY ({", ".join(partitions)}){loc}""")


def live_columns(spark: SparkSession, table: str) -> list[str]:
    """Columns of the table, each once (``DESCRIBE`` repeats partition columns)."""
    return spark.table(table).columns


def schema_diff(table_schema: T.StructType, frame_schema: T.StructType) -> list[tuple]:
    """``(column, in_table, in_frame, type_table, type_frame)`` for every column of either side."""
    t = {f.name: f.dataType.simpleString() for f in table_schema.fields}
    f = {x.name: x.dataType.simpleString() for x in frame_schema.fields}
    names = list(t) + [n for n in f if n not in t]
    return [(n, n in t, n in f, t.get(n), f.get(n)) for n in names]


SCHEMA_DIFF_SCHEMA = T.StructType([
    T.StructField("column", T.StringType()), T.StructField("in_table", T.BooleanType()),
    T.StructField("in_frame", T.BooleanType()), T.StructField("type_table", T.StringType()),
    T.StructField("type_frame", T.StringType())])


def schema_diff_df(spark: SparkSession, table_schema: T.StructType, frame_schema: T.StructType) -> DataFrame:
    return spark.createDataFrame(schema_diff(table_schema, frame_schema), SCHEMA_DIFF_SCHEMA)


def evolve(spark: SparkSession, table: str, frame_schema: T.StructType) -> list[str]:
    """Add the frame's columns the table lacks (``ALTER TABLE ... ADD COLUMNS``); never drop."""
    have = set(live_columns(spark, table))
    missing = [f for f in frame_schema.fields if f.name not in have]
    if missing:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in missing)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({cols})")
    return [f.name for f in missing]


def for_write(df: DataFrame, by=PARTITION_COLUMNS) -> DataFrame:
    """Group rows by output partition without a skewed task per day.

    ``REBALANCE`` lets adaptive execution split an oversized day into several
    tasks and merge small ones, so files stay near the advisory size.
    """
    return df.hint("rebalance", *by)


def days_of(df: DataFrame) -> Column:
    """A literal condition on the partition columns that holds for the days of ``df`` (whole months beyond ``MOST_DAYS`` days).

    Literals prune the table scan when it is planned, which a join on the days would not do.
    """
    days = df.select(*PARTITION_COLUMNS).distinct().collect()
    if len(days) > MOST_DAYS:
        days = {r[:2] for r in days}
    out = F.lit(False)
    for r in sorted(days, key=str):
        out |= reduce(and_, [F.col(c).isNull() if v is None else F.col(c) == F.lit(v) for c, v in zip(PARTITION_COLUMNS, r)])
    return out


def new_rows(rows: DataFrame, held: DataFrame) -> DataFrame:
    """The rows whose tick (symbol and collection time) ``held`` does not hold."""
    return rows.join(held.select("symbol", "tick_ts"), [rows[c].eqNullSafe(held[c]) for c in ("symbol", "tick_ts")], "left_anti").select(*rows.columns)


def append_ticks(spark: SparkSession, df: DataFrame, table: str, create: bool = True,
                 location: str | None = None, fmt: str = "parquet", new_only: bool = False) -> None:
    """Append rows to the tick table: create if absent, evolve, conform types, write by name.

    ``fmt`` is the table format (``parquet``; ``delta`` when its jars are present).
    ``new_only`` leaves out ticks (symbol and collection time) that the table already
    holds; only the day folders of ``df`` are read for that.
    """
    if create:
        create_tick_table(spark, table, location, schema=_schema_with_frame_order(df), fmt=fmt)
    evolve(spark, table, df.schema)
    target = spark.table(table).schema
    out = conform(df, T.StructType([f for f in target.fields if f.name in df.columns]))
    if new_only:
        spark.catalog.refreshTable(table)
        out = new_rows(out, spark.table(table).where(days_of(out)))
    (for_write(out).write.mode("append").format(fmt)
     .partitionBy(*PARTITION_COLUMNS).saveAsTable(table))


def rows_table(table: str) -> str:
    """The table behind a published table: all attempts' rows."""
    return table + "_rows"


def add_to_published(spark: SparkSession, keyed: DataFrame, table: str, ledger: Ledger, attempt: str,
                     location: str | None = None, fmt: str = "parquet") -> None:
    """Write an attempt's rows (with ``session``) behind the published table ``table``, a view of the rows the ledger publishes."""
    behind = rows_table(table)
    rows = keyed.drop("symbol_safe").withColumn("attempt", F.lit(attempt))
    schema = _schema_with_frame_order(rows)
    fresh = not spark.catalog.tableExists(table)
    if fresh or not spark.catalog.tableExists(behind):
        create_tick_table(spark, behind, location, schema, fmt, [*PARTITION_COLUMNS, "attempt"])
    elif spark.catalog.getTable(table).tableType != "VIEW":
        raise ValueError(f"{table} is a plain table; a published table needs a name of its own")
    if evolve(spark, behind, rows.schema) or fresh:
        names = ", ".join(f"`{c}`" for c in live_columns(spark, behind) if c not in ("session", "attempt"))
        same = " AND ".join(f"r.{c} <=> v.{c}" for c in ("attempt", "session", "symbol"))
        spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT {names} FROM {behind} r LEFT SEMI JOIN ({visible_sql(ledger.root)}) v ON {same}")
    out = conform(rows, T.StructType([f for f in spark.table(behind).schema.fields if f.name in rows.columns]))
    for_write(out).write.mode("append").format(fmt).partitionBy(*PARTITION_COLUMNS, "attempt").saveAsTable(behind)


def _schema_with_frame_order(df: DataFrame) -> T.StructType:
    wanted = {f.name: f for f in TICK_SCHEMA.fields}
    return T.StructType([wanted.get(f.name, f) for f in df.schema.fields])

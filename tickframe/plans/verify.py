"""Post-session verification: a day's ticks and their summaries.

The collector pulled the day's rows to the driver and summarised them there;
here the filter on the partition columns prunes the scan to one day's
folders and the summaries are aggregated in Spark, so only summary rows (or
the day's projected rows, when asked) reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..schema import DAY_CHECK_COLUMNS, LEGACY_MISSING


def adaptive_select(df: DataFrame, want: list[str] = DAY_CHECK_COLUMNS) -> DataFrame:
    """Select the wanted columns that exist; order by ``bar_ts`` or, in older tables, ``tick_ts``.

    Ties (several symbols per bar time) break by symbol, then collection time.
    """
    cols = [c for c in want if c in df.columns]
    order = ["bar_ts"] if "bar_ts" in df.columns else ["tick_ts"]
    order += [c for c in ("symbol", "tick_ts") if c in df.columns and c not in order]
    return df.select(*cols, *[c for c in order if c not in cols]).orderBy(*order).select(*cols)


def day_filter(df: DataFrame, year: int, month: int, day: int) -> DataFrame:
    """Literal predicates on the partition columns: pruned to the day's folders."""
    return df.where((F.col("year") == year) & (F.col("month") == month) & (F.col("date") == day))


def day_check(spark: SparkSession, table: str, year: int, month: int, day: int) -> dict:
    """The day's rows (adaptive projection) and their summaries, as DataFrames."""
    t = spark.table(table)
    d = day_filter(t, year, month, day)
    return {
        "rows": adaptive_select(d),
        "count": d.agg(F.count(F.lit(1)).alias("n_ticks")),
        "quality": agg.quality_counts(d),
        "latency": agg.latency_summary(d, by=()),
        "missing_columns": [c for c in LEGACY_MISSING if c not in t.columns],
    }

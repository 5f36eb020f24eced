"""Day-level and session-level summaries of the tick table.

Every aggregate is computed inside Spark; only the summary rows leave the
cluster. Exact percentiles are taken per (symbol, day) group, whose size is
bounded by the polls of one session, never over the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import to_market_time
from ..functions.rounding import round_half_up
from ..session import materialised
from .quantiles import exact_quantiles
from ..params import (AFTER_ABORT, BAD_PRICE, COLLAPSED, DEFAULT, FETCH_FAILED, GOOD, STALE,
                      Params)

DAY_KEYS = ("year", "month", "date")


def day_counts(ticks: DataFrame) -> DataFrame:
    """Rows per day (the verification row count, for every day)."""
    return ticks.groupBy(*DAY_KEYS).agg(F.count(F.lit(1)).alias("n_ticks"))


def quality_counts(ticks: DataFrame, by: tuple = ()) -> DataFrame:
    """Count per quality label, NULL labels dropped, largest first."""
    return (ticks.where(F.col("data_quality").isNotNull())
            .groupBy(*by, "data_quality").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(*by, F.desc("n"), "data_quality"))


def latency_summary(ticks: DataFrame, by: tuple = ("symbol",) + DAY_KEYS,
                    col: str = "fetch_latency_ms") -> DataFrame:
    """count, mean, sample std, min, quartiles (linear interpolation), max; 1 decimal.

    Without ``by`` the quartiles of all rows are found by counting passes (``quantiles.exact_quantiles``), run at once; with
    it, by ``percentile`` in every group (a symbol's day).
    """
    x = F.col(col)
    quarters = [0.25, 0.5, 0.75]
    if by:
        quartiles = [F.percentile(x, q) for q in quarters]
    else:
        ticks = materialised(ticks.select(col), "latency")
        quartiles = [F.lit(v).cast("double") for v in exact_quantiles(ticks, col, quarters)]
    stats = {"mean": F.avg(x), "std": F.stddev_samp(x), "min": F.min(x), **dict(zip(("p25", "p50", "p75"), quartiles)), "max": F.max(x)}
    aggs = [F.count(x).alias("count")] + [e.alias(f"_{k}") for k, e in stats.items()]
    return (ticks.groupBy(*by).agg(*aggs)
            .select(*by, "count", *[round_half_up(F.col(f"_{k}"), 1).alias(f"latency_{k}")
                                    for k in stats]))


def session_totals(states: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Per (symbol, session_date): polls by outcome, good ticks, worst streak, end time, abort.

    ``ended_at`` is the market time the last poll before any abort finished.
    """
    o = F.col("outcome")

    def n(label):
        return F.sum((o == label).cast("int")).cast("int").alias(f"n_{label.lower()}")

    return (states.groupBy("symbol", "session_date")
            .agg(F.count(F.lit(1)).cast("int").alias("n_polls"),
                 n(GOOD), n(STALE), n(COLLAPSED), n(BAD_PRICE), n(FETCH_FAILED), n(AFTER_ABORT),
                 F.max("fail_streak").alias("max_fail_streak"),
                 F.max(F.when(o != AFTER_ABORT, F.col("poll_id"))).alias("last_poll_id"),
                 F.max(F.when(o != AFTER_ABORT, to_market_time(F.col("fetch_end"), p))).alias("ended_at"),
                 F.max(F.when(o == GOOD, F.col("tick_no"))).alias("ticks_total"),
                 F.max((F.col("fail_streak") >= p.max_bad_ticks).cast("int")).alias("aborted")))


def flush_batches(ticks_with_no: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Flush groups per session: N ticks each, the last one partial (final flush)."""
    from ..operators.sessions import flush_batch
    g = ticks_with_no.withColumn("flush_batch", flush_batch(F.col("tick_no"), p))
    return (g.groupBy("symbol", "session_date", "flush_batch")
            .agg(F.count(F.lit(1)).cast("int").alias("rows"),
                 F.min("tick_no").alias("first_tick"), F.max("tick_no").alias("last_tick"))
            .withColumn("final_partial", F.col("rows") < p.flush_every))

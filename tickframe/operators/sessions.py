"""Per-session sequential state, restated as window functions.

The collector walks a session poll by poll, carrying the last bar time, the
previous close, the VWAP sums, the failure streak and the tick count. Here a
session is a window partition ``(symbol, session_date)`` ordered by
``poll_id``; every step below uses that one spec, so the whole chain costs one
hash exchange and one sort (the Window operators are stacked on the sorted
partition). A session holds at most one day of polls, so partitions stay
small; a hot symbol spreads over its many session dates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.candle import is_bad_price, is_collapsed, typical_price, vwap_weight
from ..functions.rounding import round_half_up
from ..session import materialised
from ..params import (AFTER_ABORT, BAD_PRICE, COLLAPSED, DEFAULT, FETCH_FAILED, GOOD, STALE,
                      VWAP_ALL_POLLS, Params)

SESSION_KEYS = ("symbol", "session_date")


def session_window():
    return Window.partitionBy(*SESSION_KEYS).orderBy("poll_id")


def _before():
    return session_window().rowsBetween(Window.unboundedPreceding, -1)


def _upto():
    return session_window().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def label_outcomes(bars: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Add ``base_outcome``: FETCH_FAILED, COLLAPSED, BAD_PRICE, STALE or GOOD.

    STALE: the bar time equals the last bar time of an earlier poll of the
    session; by default any poll that returned a bar counts (a collapsed or
    bad-price bar too), as in the collector.
    """
    o, h, l, c = (F.col(x) for x in ("open", "high", "low", "close"))
    collapsed = is_collapsed(o, h, l, c)
    bad = is_bad_price(c)
    if p.stale_against_good_only:
        # With non-decreasing bar times "equals the last stored bar" is the same as
        # "equals the last bar that passed the guards" (stale repeats equal it).
        seen = F.when(F.col("has_bar") & ~collapsed & ~bad, F.col("bar_ts"))
    else:
        seen = F.col("bar_ts")
    last_seen = F.last(seen, ignorenulls=True).over(_before())
    base = (F.when(~F.col("has_bar"), F.lit(FETCH_FAILED))
            .when(collapsed, F.lit(COLLAPSED))
            .when(bad, F.lit(BAD_PRICE))
            .when(F.col("bar_ts").eqNullSafe(last_seen), F.lit(STALE))
            .otherwise(F.lit(GOOD)))
    return bars.select("*", last_seen.alias("last_bar_ts")).select("*", base.alias("base_outcome"))


def session_state(labelled: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Streak, abort, final outcome, tick number, previous close and VWAP sums.

    * ``fail_streak``: FETCH_FAILED polls since the last GOOD one (stale and
      skipped polls neither add nor reset).
    * ``outcome``: ``AFTER_ABORT`` once an earlier poll reached ``max_bad_ticks``.
    * ``prev_close``: rounded close of the previous GOOD poll.
    * ``vwap_num`` / ``vwap_den``: running sums of typical price x weight and
      weight, over GOOD polls (``good_only``) or GOOD and STALE polls
      (``all_polls``, the collector's accumulation).
    """
    base = F.col("base_outcome")
    good0 = base == GOOD
    fail = (base == FETCH_FAILED).cast("int")
    if p.vwap_mode == VWAP_ALL_POLLS:
        in_vwap = base.isin(GOOD, STALE)
    else:
        in_vwap = good0
    w = vwap_weight(F.col("volume"))
    tp = typical_price("high", "low", "close")
    # One projection per window layer: every window column of a layer is
    # evaluated by one Window operator over the same sorted partition.
    df = labelled.select(
        "*",
        F.sum(fail).over(_upto()).alias("_cf"),
        F.sum(good0.cast("int")).over(_upto()).alias("_tick_no"),
        F.last(F.when(good0, round_half_up(F.col("close"), 2)), ignorenulls=True)
        .over(_before()).alias("prev_close"),
        F.sum(F.when(in_vwap, tp * w)).over(_upto()).alias("vwap_num"),
        F.sum(F.when(in_vwap, w)).over(_upto()).alias("vwap_den"))
    last_good_cf = F.max(F.when(good0, F.col("_cf"))).over(_upto())
    df = df.select("*", (F.col("_cf") - F.coalesce(last_good_cf, F.lit(0))).cast("int").alias("fail_streak"))
    aborted = F.coalesce(F.max(F.col("fail_streak") >= p.max_bad_ticks).over(_before()), F.lit(False))
    df = df.select("*", aborted.alias("aborted_before"))
    outcome = F.when(F.col("aborted_before"), F.lit(AFTER_ABORT)).otherwise(base)
    keep = [c for c in df.columns if c not in ("_cf", "_tick_no")]
    return df.select(*keep, outcome.alias("outcome"),
                     F.when(~F.col("aborted_before") & good0, F.col("_tick_no")).cast("int").alias("tick_no"))


def poll_outcomes(bars: DataFrame, p: Params = DEFAULT) -> DataFrame:
    if p.session_chunk_polls:
        return split_session_states(bars, p, p.session_chunk_polls)
    return session_state(label_outcomes(bars, p), p)


def _nullable_add(a: Column, b: Column) -> Column:
    """a + b treating NULL as 0, NULL only when both are NULL (as a running SUM)."""
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(
        F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))


def split_session_states(bars: DataFrame, p: Params, chunk_polls: int) -> DataFrame:
    """:func:`session_state` computed as a chunked prefix scan, for very long sessions.

    A session is cut into chunks of ``chunk_polls`` poll ids. Each quantity of
    the sequential scan is an associative fold (last non-NULL, sum, max), so it
    is computed in three passes:

    * local windows inside each chunk (partitions ``(symbol, session_date,
      chunk)``, in parallel);
    * one summary row per chunk (aggregated where the rows already are);
    * a window over the chunk summaries of the session that carries each
      value into the next chunk, joined back by chunk.

    Pass A carries the last bar seen (for the stale test), pass B the failure
    count, tick count, previous close, VWAP sums and the failure count at the
    last good poll, and pass C the abort flag. Only the poll rows are shuffled
    once; the summaries hold one row per chunk.
    """
    K = [*SESSION_KEYS, "_chunk"]
    # Every pass reads one copy in the shared folder instead of the log again.
    x = materialised(bars.withColumn("_chunk", F.floor(F.col("poll_id") / F.lit(chunk_polls)).cast("long")), "chunks").repartition(*K)
    wl = Window.partitionBy(*K).orderBy("poll_id")
    before = wl.rowsBetween(Window.unboundedPreceding, -1)
    upto = wl.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carry = Window.partitionBy(*SESSION_KEYS).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    o, h, l, c = (F.col(n) for n in ("open", "high", "low", "close"))
    collapsed, bad = is_collapsed(o, h, l, c), is_bad_price(c)
    if p.stale_against_good_only:
        seen = F.when(F.col("has_bar") & ~collapsed & ~bad, F.col("bar_ts"))
    else:
        seen = F.col("bar_ts")

    # Pass A: last bar seen before each poll.
    sa = x.groupBy(*K).agg(F.max_by(seen, F.when(seen.isNotNull(), F.col("poll_id"))).alias("_ls_k"))
    ca = sa.select(*K, F.last("_ls_k", ignorenulls=True).over(carry).alias("_ls_c"))
    xa = x.select("*", F.last(seen, ignorenulls=True).over(before).alias("_ls_l")).join(ca, K, "left")
    last_seen = F.coalesce(F.col("_ls_l"), F.col("_ls_c"))
    base = (F.when(~F.col("has_bar"), F.lit(FETCH_FAILED))
            .when(collapsed, F.lit(COLLAPSED))
            .when(bad, F.lit(BAD_PRICE))
            .when(F.col("bar_ts").eqNullSafe(F.col("last_bar_ts")), F.lit(STALE))
            .otherwise(F.lit(GOOD)))
    xa = xa.select(*[n for n in xa.columns if n not in ("_ls_l", "_ls_c")], last_seen.alias("last_bar_ts"))
    xa = xa.select("*", base.alias("base_outcome"))

    # Pass B: running counts, previous close, VWAP sums, failures at the last good poll.
    b = F.col("base_outcome")
    good0, fail = b == GOOD, (b == FETCH_FAILED).cast("int")
    in_vwap = b.isin(GOOD, STALE) if p.vwap_mode == VWAP_ALL_POLLS else good0
    w = vwap_weight(F.col("volume"))
    tp = typical_price("high", "low", "close")
    close_r = F.when(good0, round_half_up(F.col("close"), 2))
    xb = xa.select("*",
                   F.sum(fail).over(upto).alias("_cf_l"),
                   F.sum(good0.cast("int")).over(upto).alias("_tick_l"),
                   F.last(close_r, ignorenulls=True).over(before).alias("_pc_l"),
                   F.sum(F.when(in_vwap, tp * w)).over(upto).alias("_num_l"),
                   F.sum(F.when(in_vwap, w)).over(upto).alias("_den_l"))
    xb = xb.select("*", F.max(F.when(good0, F.col("_cf_l"))).over(upto).alias("_lgcf_l"))
    sb = xb.groupBy(*K).agg(
        F.sum(fail).alias("_f_k"), F.sum(good0.cast("int")).alias("_g_k"),
        F.max_by(close_r, F.when(good0, F.col("poll_id"))).alias("_pc_k"),
        F.sum(F.when(in_vwap, tp * w)).alias("_num_k"), F.sum(F.when(in_vwap, w)).alias("_den_k"),
        F.max(F.when(good0, F.col("_cf_l"))).alias("_lgcf_k"))
    cb = sb.select(*K, "_lgcf_k",
                   F.sum("_f_k").over(carry).alias("_cf_c"), F.sum("_g_k").over(carry).alias("_tick_c"),
                   F.last("_pc_k", ignorenulls=True).over(carry).alias("_pc_c"),
                   F.sum("_num_k").over(carry).alias("_num_c"), F.sum("_den_k").over(carry).alias("_den_c"))
    # Failure count (session-wide) at the last good poll of each earlier chunk.
    glob_lgcf = F.when(F.col("_lgcf_k").isNotNull(), F.coalesce(F.col("_cf_c"), F.lit(0)) + F.col("_lgcf_k"))
    cb = cb.select("*", F.last(glob_lgcf, ignorenulls=True).over(carry).alias("_lgcf_c")).drop("_lgcf_k")
    xb = xb.join(cb, K, "left")
    cf0 = F.coalesce(F.col("_cf_c"), F.lit(0))
    last_good_cf = F.coalesce(F.when(F.col("_lgcf_l").isNotNull(), cf0 + F.col("_lgcf_l")), F.col("_lgcf_c"))
    streak = (cf0 + F.col("_cf_l") - F.coalesce(last_good_cf, F.lit(0))).cast("int")
    keep = [n for n in xa.columns]
    xb = xb.select(*keep,
                   (F.coalesce(F.col("_tick_c"), F.lit(0)) + F.col("_tick_l")).alias("_tick_no"),
                   F.coalesce(F.col("_pc_l"), F.col("_pc_c")).alias("prev_close"),
                   _nullable_add(F.col("_num_l"), F.col("_num_c")).alias("vwap_num"),
                   _nullable_add(F.col("_den_l"), F.col("_den_c")).alias("vwap_den"),
                   streak.alias("fail_streak"))

    # Pass C: has any earlier poll of the session reached the failure limit?
    hit = F.col("fail_streak") >= p.max_bad_ticks
    sc = xb.groupBy(*K).agg(F.max(hit).alias("_ab_k"))
    cc = sc.select(*K, F.max("_ab_k").over(carry).alias("_ab_c"))
    xc = xb.select("*", F.max(hit).over(before).alias("_ab_l")).join(cc, K, "left")
    aborted = F.coalesce(F.col("_ab_l"), F.lit(False)) | F.coalesce(F.col("_ab_c"), F.lit(False))
    xc = xc.select("*", aborted.alias("aborted_before"))
    outcome = F.when(F.col("aborted_before"), F.lit(AFTER_ABORT)).otherwise(b)
    out = [n for n in xb.columns if n not in ("_chunk", "_tick_no")] + ["aborted_before"]
    return xc.select(*out, outcome.alias("outcome"),
                     F.when(~F.col("aborted_before") & good0, F.col("_tick_no")).cast("int").alias("tick_no"))


def running_vwap(num: Column | None = None, den: Column | None = None) -> Column:
    num = F.col("vwap_num") if num is None else num
    den = F.col("vwap_den") if den is None else den
    return F.when(den > 0, num / den)


def flush_batch(tick_no: Column, p: Params = DEFAULT) -> Column:
    """Flush group of a stored tick: ticks 1..N -> 0, N+1..2N -> 1, ..."""
    return ((tick_no - 1) / F.lit(p.flush_every)).cast("int")

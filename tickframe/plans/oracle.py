"""Reference SQL (DuckDB dialect) for every scored query.

The text restates the fixture rules and the pipeline semantics in plain
window-function SQL over the driver's tables, so an independent engine can
check the Spark plans. Shared CTEs are assembled by :func:`with_ctes`.
"""

from __future__ import annotations

from ..functions.rounding import sql_round
from ..params import DEFAULT, SESSION_BUCKETS, VWAP_ALL_POLLS, Params
from ..sources import fixtures as fx


def with_ctes(ctes: list[tuple[str, str]], final: str) -> str:
    body = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes)
    return f"WITH {body}\n{final}"


def mkt_from_micros(expr: str, p: Params = DEFAULT) -> str:
    """UTC epoch microseconds -> market wall clock (naive TIMESTAMP)."""
    return f"timezone('{p.market_tz}', timezone('UTC', make_timestamp({expr})))"


def weekday(ts: str) -> str:
    return f"(isodow({ts}) - 1)"


def pmod7(expr: str) -> str:
    return f"((({expr}) % 7 + 7) % 7)"


def session_number_sql(hour: str) -> str:
    whens = " ".join(f"WHEN {h} THEN {v}" for h, v in sorted(SESSION_BUCKETS.items()))
    return f"CAST(CASE {hour} {whens} ELSE 0 END AS INTEGER)"


def last_expiry_sql(ts: str, p: Params = DEFAULT) -> str:
    last = f"last_day(CAST({ts} AS DATE))"
    return f"CAST({last} - CAST({pmod7(f'{weekday(last)} - {p.expiry_weekday}')} AS INTEGER) AS DATE)"


def fixture_ctes(bar_minutes: int = fx.DEFAULT_BAR_MINUTES, p: Params = DEFAULT) -> list:
    w_s = bar_minutes * 60
    w_us = w_s * 1_000_000
    cols = "open, high, low, close, volume"
    return [
        ("ev", f"""  SELECT event_type AS symbol, ts, event_id, value,
         CAST(floor(epoch_us(ts) / {w_us}) AS BIGINT) AS slot
  FROM events"""),
        ("bars0", """  SELECT symbol, slot, arg_min(value, (ts, event_id)) AS open, max(value) AS high,
         min(value) AS low, arg_max(value, (ts, event_id)) AS close, count(*) AS n_events
  FROM ev GROUP BY symbol, slot"""),
        ("bars", f"""  SELECT symbol, slot, open, high, low, close, n_events,
         CASE WHEN symbol = '{fx.NO_VOLUME_SYMBOL}' THEN 0.0
              WHEN symbol = '{fx.NAN_SYMBOL}' AND slot % {fx.NAN_EVERY} = {fx.NAN_REM} THEN CAST('NaN' AS DOUBLE)
              ELSE CAST(n_events AS DOUBLE) END AS volume
  FROM bars0"""),
        ("snap0", f"""  SELECT symbol, slot + 1 AS poll_id, 0 AS seq, slot, {cols} FROM bars
  UNION ALL SELECT symbol, slot, 2, slot, {cols} FROM bars
  UNION ALL SELECT symbol, slot - 1, 4, slot, {cols} FROM bars
  UNION ALL SELECT symbol, slot, 1, slot, open, open, open, open, volume FROM bars
            WHERE slot % {fx.DUP_EVERY} = 0"""),
        ("polls0", f"""  SELECT symbol, poll_id, (poll_id + 1) * {w_s} + {fx.POLL_DELAY_SECONDS} AS start_s,
         {fx.LATENCY_BASE_US} + (poll_id * {fx.LATENCY_MUL_POLL} + length(symbol) * {fx.LATENCY_MUL_SYMBOL})
             % {fx.LATENCY_SPAN_US} AS latency_us
  FROM (SELECT DISTINCT symbol, poll_id FROM snap0)"""),
        ("polls1", f"""  SELECT *, {mkt_from_micros('start_s * 1000000', p)} AS start_mkt,
         {mkt_from_micros('start_s * 1000000 + latency_us', p)} AS end_mkt
  FROM polls0"""),
        ("polls", f"""  SELECT symbol, poll_id, start_s, latency_us, start_mkt, end_mkt,
         CAST(start_mkt AS DATE) AS session_date,
         ((poll_id + length(symbol)) % {fx.ERROR_EVERY} = 0)
           OR (hour(start_mkt) >= {fx.OUTAGE_FROM_HOUR}
               AND (dayofmonth(start_mkt) + length(symbol)) % {fx.OUTAGE_EVERY} = 0) AS error,
         (poll_id + 2 * length(symbol)) % {fx.EMPTY_EVERY} = 0 AS empty
  FROM polls1"""),
        ("snaps", """  SELECT s.* FROM snap0 s JOIN polls q ON s.symbol = q.symbol AND s.poll_id = q.poll_id
  WHERE NOT (q.error OR q.empty)"""),
    ]


def nan0(x: str) -> str:
    return f"coalesce(CASE WHEN isnan({x}) THEN 0.0 ELSE {x} END, 0.0)"


W_UPTO = ("(PARTITION BY symbol, session_date ORDER BY poll_id "
          "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
W_BEFORE = ("(PARTITION BY symbol, session_date ORDER BY poll_id "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")


def pipeline_ctes(bar_minutes: int = fx.DEFAULT_BAR_MINUTES, p: Params = DEFAULT) -> list:
    w_us = bar_minutes * 60 * 1_000_000
    in_vwap = ("base_outcome IN ('GOOD', 'STALE')" if p.vwap_mode == VWAP_ALL_POLLS
               else "base_outcome = 'GOOD'")
    collapsed = "(high = low AND low = open AND open = close AND close > 0)"
    if p.stale_against_good_only:
        seen = f"CASE WHEN has_bar AND NOT {collapsed} AND NOT close <= 0 THEN bar_ts END"
    else:
        seen = "bar_ts"
    return fixture_ctes(bar_minutes, p) + [
        ("dedup", """  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY symbol, poll_id, slot ORDER BY seq DESC) AS rn_dup
    FROM snaps) WHERE rn_dup = 1"""),
        ("picked", """  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY symbol, poll_id ORDER BY slot DESC) AS rn,
           count(*) OVER (PARTITION BY symbol, poll_id) AS bars_in_response
    FROM dedup) WHERE rn = least(bars_in_response, 2)"""),
        ("sel", f"""  SELECT q.symbol, q.poll_id, q.session_date, q.start_s, q.latency_us, q.start_mkt, q.end_mkt,
         NOT q.error AS ok, (b.slot IS NOT NULL AND NOT q.error) AS has_bar,
         CASE WHEN b.slot IS NOT NULL AND NOT q.error THEN {mkt_from_micros(f'b.slot * {w_us}', p)} END AS bar_ts,
         {', '.join(f'CASE WHEN b.slot IS NOT NULL AND NOT q.error THEN {nan0("b." + c)} END AS {c}'
                    for c in ('open', 'high', 'low', 'close', 'volume'))}
  FROM polls q LEFT JOIN picked b ON q.symbol = b.symbol AND q.poll_id = b.poll_id"""),
        ("lab", f"""  SELECT *, last_value({seen} IGNORE NULLS) OVER {W_BEFORE} AS last_bar_ts FROM sel"""),
        ("lab2", f"""  SELECT *, CASE WHEN NOT has_bar THEN 'FETCH_FAILED'
                     WHEN {collapsed} THEN 'COLLAPSED'
                     WHEN close <= 0 THEN 'BAD_PRICE'
                     WHEN bar_ts IS NOT DISTINCT FROM last_bar_ts THEN 'STALE'
                     ELSE 'GOOD' END AS base_outcome
  FROM lab"""),
        ("st1", f"""  SELECT *,
         sum(CASE WHEN base_outcome = 'FETCH_FAILED' THEN 1 ELSE 0 END) OVER {W_UPTO} AS cf,
         sum(CASE WHEN base_outcome = 'GOOD' THEN 1 ELSE 0 END) OVER {W_UPTO} AS tick_no0,
         last_value(CASE WHEN base_outcome = 'GOOD' THEN {sql_round('close', 2)} END IGNORE NULLS)
             OVER {W_BEFORE} AS prev_close,
         sum(CASE WHEN {in_vwap} THEN (high + low + close) / 3.0 * greatest(volume, 1.0) END)
             OVER {W_UPTO} AS vwap_num,
         sum(CASE WHEN {in_vwap} THEN greatest(volume, 1.0) END) OVER {W_UPTO} AS vwap_den
  FROM lab2"""),
        ("st2", f"""  SELECT *, CAST(cf - coalesce(max(CASE WHEN base_outcome = 'GOOD' THEN cf END) OVER {W_UPTO}, 0)
                     AS INTEGER) AS fail_streak
  FROM st1"""),
        ("st3", f"""  SELECT *, coalesce(max(CASE WHEN fail_streak >= {p.max_bad_ticks} THEN 1 ELSE 0 END)
                     OVER {W_BEFORE}, 0) = 1 AS aborted_before
  FROM st2"""),
        ("states", """  SELECT *, CASE WHEN aborted_before THEN 'AFTER_ABORT' ELSE base_outcome END AS outcome,
         CAST(CASE WHEN NOT aborted_before AND base_outcome = 'GOOD' THEN tick_no0 END AS INTEGER) AS tick_no
  FROM st3"""),
    ]


def tick_select(p: Params = DEFAULT, src: str = "states", extra: str = "") -> str:
    """SELECT of the 32 tick columns over GOOD rows of ``src``."""
    r = sql_round
    wd = weekday("bar_ts")
    rng = r("high - low", 2)
    cols = [
        "end_mkt AS tick_ts",
        "bar_ts",
        "strftime(end_mkt, '%H:%M') AS tick_time_str",
        "strftime(bar_ts, '%H:%M') AS bar_time_str",
        "symbol",
        "CAST(year(bar_ts) AS INTEGER) AS year",
        "CAST(month(bar_ts) AS INTEGER) AS month",
        "CAST(dayofmonth(bar_ts) AS INTEGER) AS date",
        f"CAST({wd} AS INTEGER) AS day",
        "CAST(hour(bar_ts) AS INTEGER) AS hour",
        "CAST(minute(bar_ts) AS INTEGER) AS minute",
        "CAST((dayofmonth(bar_ts) - 1) // 7 + 1 AS INTEGER) AS week_of_month",
        f"{r('open', 2)} AS open", f"{r('high', 2)} AS high", f"{r('low', 2)} AS low",
        f"{r('close', 2)} AS close", f"{r('volume', 0)} AS volume",
        f"{r('(high + low + close) / 3.0', 2)} AS typical_price",
        f"{r('CASE WHEN vwap_den > 0 THEN vwap_num / vwap_den END', 2)} AS vwap",
        f"{rng} AS price_range",
        f"CASE WHEN open > 0 THEN {r('(close - open) / open * 100', 4)} ELSE 0.0 END AS return_pct",
        f"CASE WHEN {rng} > 0 THEN {r(f'abs(close - open) / {rng} * 100', 2)} ELSE 0.0 END AS body_pct",
        f"{r('high - greatest(open, close)', 2)} AS upper_shadow",
        f"{r('least(open, close) - low', 2)} AS lower_shadow",
        f"CASE WHEN low > 0 THEN {r('high / low', 6)} ELSE 1.0 END AS hl_ratio",
        f"CASE WHEN prev_close IS NOT NULL AND prev_close > 0 AND close > 0 "
        f"THEN {r('ln(close / prev_close)', 6)} ELSE 0.0 END AS log_return",
        f"{session_number_sql('hour(bar_ts)')} AS session_number",
        f"CAST({wd} = {p.expiry_weekday} AS INTEGER) AS expiry",
        f"CAST({wd} = {p.expiry_weekday} AND CAST(bar_ts AS DATE) = {last_expiry_sql('bar_ts', p)}"
        f" AS INTEGER) AS is_monthly_expiry",
        f"CAST({pmod7(f'{p.expiry_weekday} - {wd}')} AS INTEGER) AS days_to_expiry",
        f"CASE WHEN close <= 0 THEN 'BAD_PRICE' "
        f"WHEN prev_close IS NOT NULL AND prev_close > 0 AND abs(close - prev_close) / prev_close > {p.spike_pct} "
        f"THEN 'SPIKE' WHEN volume = 0 THEN 'OK_NO_VOL' ELSE 'OK' END AS data_quality",
        f"{r('latency_us / 1000.0', 1)} AS fetch_latency_ms",
    ]
    extra_cols = f", {extra}" if extra else ""
    return f"SELECT {', '.join(cols)}{extra_cols} FROM {src} WHERE outcome = 'GOOD'"


def ticks_ctes(bar_minutes: int = fx.DEFAULT_BAR_MINUTES, p: Params = DEFAULT,
               extra: str = "") -> list:
    return pipeline_ctes(bar_minutes, p) + [("ticks", tick_select(p, extra=extra))]

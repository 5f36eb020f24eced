"""Registered queries: a Spark plan and the matching reference SQL for each.

Every query reads the driver's tables (``events`` through the fixture
adapter) in full. ``QUERIES[name] = (build(spark, sf_dir) -> DataFrame, sql)``;
``sql`` is ``None`` where no SQL statement can express the operator (writes,
streaming), in which case the result is checked in the tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import candle as cd
from ..functions.quality import quality_ok, symbol_safe
from ..functions.rounding import round_half_up, sql_round
from ..operators import aggregates as agg
from ..operators.clean import dedup_keep_last, last_closed_bar, nan_safe_ohlcv
from ..operators.expectations import expectation_report
from ..operators.features import candle_columns, fetch_latency_ms
from ..operators.sessions import flush_batch, running_vwap
from ..params import DEFAULT, FLUSH_EVERY, VWAP_GOOD_ONLY, Params
from ..schema import INT_COLUMNS, LEGACY_MISSING, TICK_COLUMNS
from ..sources import fixtures as fx
from . import oracle as O
from .ticks import fixture_states, fixture_ticks

GOOD_ONLY = DEFAULT.with_(vwap_mode=VWAP_GOOD_ONLY)


# ---------------------------------------------------------------- helpers
def _bars(spark, sf) -> DataFrame:
    return fx.bars_from_events(fx.load_events(spark, sf))


def _poll_log(spark, sf):
    return fx.fixture_poll_log(spark, sf)


def _mkt(col="bar_utc"):
    return cal.to_market_time(F.col(col))


def _sql(final: str, ctes: list | None = None) -> str:
    return O.with_ctes(ctes if ctes is not None else O.pipeline_ctes(), final)


W_US_SQL = str(fx.DEFAULT_BAR_MINUTES * 60 * 1_000_000)
NAN_SAFE_BAR_SQL = ", ".join(f"{O.nan0(c)} AS {c}" for c in ("open", "high", "low", "close", "volume"))


# ---------------------------------------------------------------- bars and calendar
def q_bars_ist(spark, sf):
    b = _bars(spark, sf)
    return b.select("symbol", "slot", _mkt().alias("bar_ts"), "open", "high", "low", "close",
                    cd.nan_safe("volume").alias("volume"), "n_events")


SQL_BARS_IST = _sql(f"""SELECT symbol, slot, {O.mkt_from_micros('slot * ' + W_US_SQL)} AS bar_ts,
  open, high, low, close, {O.nan0('volume')} AS volume, n_events FROM bars""", O.fixture_ctes())


def q_calendar_dims(spark, sf):
    b = q_bars_ist(spark, sf)
    t, d = F.col("bar_ts"), F.to_date("bar_ts")
    return b.select("symbol", "bar_ts", F.year(t).alias("year"), F.month(t).alias("month"),
                    F.dayofmonth(t).alias("date"), cal.weekday(d).alias("day"),
                    F.hour(t).alias("hour"), F.minute(t).alias("minute"),
                    cal.week_of_month(d).alias("week_of_month"),
                    cal.hhmm(t).alias("bar_time_str"), cal.session_string(d).alias("session_str"))


def _bar_ts_sql():
    return f"{O.mkt_from_micros('slot * ' + W_US_SQL)}"


SQL_CALENDAR_DIMS = _sql(f"""SELECT symbol, bar_ts, CAST(year(bar_ts) AS INTEGER) AS year,
  CAST(month(bar_ts) AS INTEGER) AS month, CAST(dayofmonth(bar_ts) AS INTEGER) AS date,
  CAST({O.weekday('bar_ts')} AS INTEGER) AS day, CAST(hour(bar_ts) AS INTEGER) AS hour,
  CAST(minute(bar_ts) AS INTEGER) AS minute,
  CAST((dayofmonth(bar_ts) - 1) // 7 + 1 AS INTEGER) AS week_of_month,
  strftime(bar_ts, '%H:%M') AS bar_time_str, strftime(bar_ts, '%Y_%m_%d') AS session_str
FROM (SELECT symbol, {_bar_ts_sql()} AS bar_ts FROM bars)""", O.fixture_ctes())


def q_expiry_features(spark, sf):
    b = q_bars_ist(spark, sf)
    d = F.to_date("bar_ts")
    return b.select("symbol", "bar_ts", cal.is_expiry(d).alias("expiry"),
                    cal.is_monthly_expiry(d).alias("is_monthly_expiry"),
                    cal.days_to_expiry(d).alias("days_to_expiry"),
                    cal.last_expiry_of_month(d).alias("last_expiry"))


SQL_EXPIRY_FEATURES = _sql(f"""SELECT symbol, bar_ts,
  CAST({O.weekday('bar_ts')} = 1 AS INTEGER) AS expiry,
  CAST({O.weekday('bar_ts')} = 1 AND CAST(bar_ts AS DATE) = {O.last_expiry_sql('bar_ts')} AS INTEGER)
    AS is_monthly_expiry,
  CAST({O.pmod7(f"1 - {O.weekday('bar_ts')}")} AS INTEGER) AS days_to_expiry,
  {O.last_expiry_sql('bar_ts')} AS last_expiry
FROM (SELECT symbol, {_bar_ts_sql()} AS bar_ts FROM bars)""", O.fixture_ctes())


def q_session_bucket(spark, sf):
    b = q_bars_ist(spark, sf)
    return b.select("symbol", "bar_ts", F.hour("bar_ts").alias("hour"),
                    cal.session_number(F.hour("bar_ts")).alias("session_number"))


SQL_SESSION_BUCKET = _sql(f"""SELECT symbol, bar_ts, CAST(hour(bar_ts) AS INTEGER) AS hour,
  {O.session_number_sql('hour(bar_ts)')} AS session_number
FROM (SELECT symbol, {_bar_ts_sql()} AS bar_ts FROM bars)""", O.fixture_ctes())


# ---------------------------------------------------------------- polls and market clock
def _polls_mkt(spark, sf):
    polls, _ = _poll_log(spark, sf)
    return polls.select("symbol", "poll_id", "session_date",
                        _mkt("fetch_start").alias("fetch_start_mkt"))


def q_market_state(spark, sf):
    t = F.col("fetch_start_mkt")
    return _polls_mkt(spark, sf).select(
        "symbol", "poll_id", "fetch_start_mkt", cal.market_state(t).alias("market_state"),
        cal.seconds_to_open(t).alias("secs_to_open"),
        cal.session_open(t).alias("open_dt"), cal.session_close(t).alias("close_dt"))


def _at(ts, minute):
    return (f"(date_trunc('day', {ts}) + INTERVAL {minute // 60} HOUR"
            f" + INTERVAL {minute % 60} MINUTE)")


SQL_MARKET_STATE = _sql(f"""SELECT symbol, poll_id, start_mkt AS fetch_start_mkt,
  CASE WHEN {O.weekday('start_mkt')} >= 5 THEN 'WEEKEND'
       WHEN start_mkt >= {_at('start_mkt', DEFAULT.close_minute)} THEN 'PAST_CLOSE'
       WHEN start_mkt >= {_at('start_mkt', DEFAULT.open_minute)} THEN 'OPEN'
       ELSE 'WAIT' END AS market_state,
  greatest(0.0, epoch_us({_at('start_mkt', DEFAULT.open_minute)}) / 1e6 - epoch_us(start_mkt) / 1e6)
    AS secs_to_open,
  {_at('start_mkt', DEFAULT.open_minute)} AS open_dt, {_at('start_mkt', DEFAULT.close_minute)} AS close_dt
FROM polls""", O.fixture_ctes())


def q_market_hours(spark, sf):
    t = F.col("fetch_start_mkt")
    return (_polls_mkt(spark, sf).where(cal.is_market_open(t))
            .select("symbol", "poll_id", "fetch_start_mkt",
                    cal.minute_of_day(t).alias("minute_of_day")))


SQL_MARKET_HOURS = _sql(f"""SELECT symbol, poll_id, start_mkt AS fetch_start_mkt,
  CAST(hour(start_mkt) * 60 + minute(start_mkt) AS INTEGER) AS minute_of_day
FROM polls WHERE {O.weekday('start_mkt')} < 5
  AND hour(start_mkt) * 60 + minute(start_mkt) BETWEEN {DEFAULT.open_minute} AND {DEFAULT.close_minute}""",
                        O.fixture_ctes())


# ---------------------------------------------------------------- candle features
def q_candle_features(spark, sf):
    b = q_bars_ist(spark, sf)
    cols = candle_columns()
    return b.select("symbol", "slot",
                    round_half_up(cd.typical_price("high", "low", "close"), 2).alias("typical_price"),
                    *[c.alias(n) for n, c in cols.items()])


def _candle_sql():
    r = sql_round
    rng = r("high - low", 2)
    return f"""{r('(high + low + close) / 3.0', 2)} AS typical_price, {rng} AS price_range,
  CASE WHEN open > 0 THEN {r('(close - open) / open * 100', 4)} ELSE 0.0 END AS return_pct,
  CASE WHEN {rng} > 0 THEN {r(f'abs(close - open) / {rng} * 100', 2)} ELSE 0.0 END AS body_pct,
  {r('high - greatest(open, close)', 2)} AS upper_shadow, {r('least(open, close) - low', 2)} AS lower_shadow,
  CASE WHEN low > 0 THEN {r('high / low', 6)} ELSE 1.0 END AS hl_ratio"""


SQL_CANDLE_FEATURES = _sql(f"SELECT symbol, slot, {_candle_sql()} FROM bars", O.fixture_ctes())


def q_typical_price(spark, sf):
    b = q_bars_ist(spark, sf)
    return b.select("symbol", "slot",
                    round_half_up(cd.typical_price("high", "low", "close"), 2).alias("typical_price"),
                    cd.vwap_weight(F.col("volume")).alias("vwap_weight"))


SQL_TYPICAL_PRICE = _sql(f"""SELECT symbol, slot, {sql_round('(high + low + close) / 3.0', 2)} AS typical_price,
  greatest({O.nan0('volume')}, 1.0) AS vwap_weight FROM bars""", O.fixture_ctes())


# ---------------------------------------------------------------- snapshot cleaning
def _snap_out(df):
    return df.select("symbol", "poll_id", _mkt().alias("bar_ts"), *[
        cd.nan_safe(c).alias(c) for c in ("open", "high", "low", "close", "volume")],
        *[c for c in ("seq", "bars_in_response") if c in df.columns])


def q_nan_safe_ohlcv(spark, sf):
    _, snaps = _poll_log(spark, sf)
    s = nan_safe_ohlcv(snaps)
    return s.select("symbol", "poll_id", "seq", _mkt().alias("bar_ts"),
                    "open", "high", "low", "close", "volume")


SQL_NAN_SAFE = _sql(f"""SELECT symbol, poll_id, CAST(seq AS INTEGER) AS seq,
  {O.mkt_from_micros('slot * ' + W_US_SQL)} AS bar_ts, {NAN_SAFE_BAR_SQL} FROM snaps""", O.fixture_ctes())


def q_dedup_keep_last(spark, sf):
    _, snaps = _poll_log(spark, sf)
    return _snap_out(dedup_keep_last(snaps))


SQL_DEDUP = _sql(f"""SELECT symbol, poll_id, {O.mkt_from_micros('slot * ' + W_US_SQL)} AS bar_ts,
  {NAN_SAFE_BAR_SQL}, CAST(seq AS INTEGER) AS seq FROM dedup""")


def q_last_closed_bar(spark, sf):
    _, snaps = _poll_log(spark, sf)
    return _snap_out(last_closed_bar(snaps))


SQL_LAST_CLOSED = _sql(f"""SELECT symbol, poll_id, {O.mkt_from_micros('slot * ' + W_US_SQL)} AS bar_ts,
  {NAN_SAFE_BAR_SQL}, bars_in_response FROM picked""")


# ---------------------------------------------------------------- outcomes and session state
def q_poll_outcomes(spark, sf):
    s = fixture_states(spark, sf)
    return s.select("symbol", "poll_id", "session_date", "bar_ts", "last_bar_ts",
                    "base_outcome", "outcome")


SQL_POLL_OUTCOMES = _sql("""SELECT symbol, poll_id, session_date, bar_ts, last_bar_ts, base_outcome, outcome
FROM states""")


def q_fail_streak_abort(spark, sf):
    s = fixture_states(spark, sf)
    return s.select("symbol", "poll_id", "session_date", "fail_streak", "aborted_before", "outcome")


SQL_FAIL_STREAK = _sql("""SELECT symbol, poll_id, session_date, fail_streak, aborted_before, outcome
FROM states""")


def q_tick_numbers(spark, sf):
    s = fixture_states(spark, sf).where(F.col("outcome") == "GOOD")
    return s.select("symbol", "session_date", "poll_id", "tick_no",
                    flush_batch(F.col("tick_no")).alias("flush_batch"))


SQL_TICK_NUMBERS = _sql(f"""SELECT symbol, session_date, poll_id, tick_no,
  CAST((tick_no - 1) // {FLUSH_EVERY} AS INTEGER) AS flush_batch FROM states WHERE outcome = 'GOOD'""")


def q_log_returns(spark, sf):
    s = fixture_states(spark, sf).where(F.col("outcome") == "GOOD")
    return s.select("symbol", "poll_id", round_half_up(F.col("close"), 2).alias("close"),
                    "prev_close", cd.log_return("close", "prev_close").alias("log_return"))


SQL_LOG_RETURNS = _sql(f"""SELECT symbol, poll_id, {sql_round('close', 2)} AS close, prev_close,
  CASE WHEN prev_close IS NOT NULL AND prev_close > 0 AND close > 0
       THEN {sql_round('ln(close / prev_close)', 6)} ELSE 0.0 END AS log_return
FROM states WHERE outcome = 'GOOD'""")


def _vwap_query(p: Params):
    def build(spark, sf):
        s = fixture_states(spark, sf, p=p).where(F.col("outcome") == "GOOD")
        return s.select("symbol", "poll_id", round_half_up(running_vwap(), 2).alias("vwap"),
                        F.col("vwap_den").alias("weight_sum"))
    return build


def _vwap_sql(p: Params):
    return O.with_ctes(O.pipeline_ctes(p=p), f"""SELECT symbol, poll_id,
  {sql_round('CASE WHEN vwap_den > 0 THEN vwap_num / vwap_den END', 2)} AS vwap, vwap_den AS weight_sum
FROM states WHERE outcome = 'GOOD'""")


# ---------------------------------------------------------------- tick table and summaries
def q_tick_table(spark, sf):
    return fixture_ticks(spark, sf)


SQL_TICK_TABLE = O.with_ctes(O.ticks_ctes(), "SELECT * FROM ticks")

# Sessions cut into chunks of 6 poll ids (4-5 chunks per fixture session): the
# chunked prefix scan must give the same tick table as one window per session.
SPLIT = DEFAULT.with_(session_chunk_polls=6)


def q_tick_table_split_sessions(spark, sf):
    return fixture_ticks(spark, sf, p=SPLIT)


def q_data_quality(spark, sf):
    t = fixture_ticks(spark, sf, keep=("poll_id",))
    return t.select("symbol", "poll_id", "data_quality",
                    quality_ok(F.col("data_quality")).alias("quality_ok"))


SQL_DATA_QUALITY = O.with_ctes(O.ticks_ctes(extra="poll_id"), """SELECT symbol, poll_id, data_quality,
  data_quality IN ('OK', 'OK_NO_VOL') AS quality_ok FROM ticks""")


def q_quality_counts(spark, sf):
    return agg.quality_counts(fixture_ticks(spark, sf), by=("symbol",))


SQL_QUALITY_COUNTS = O.with_ctes(O.ticks_ctes(), """SELECT symbol, data_quality, count(*) AS n FROM ticks
WHERE data_quality IS NOT NULL GROUP BY symbol, data_quality ORDER BY symbol, n DESC, data_quality""")


def q_latency_summary(spark, sf):
    return agg.latency_summary(fixture_ticks(spark, sf))


SQL_LATENCY_SUMMARY = O.with_ctes(O.ticks_ctes(), f"""SELECT symbol, year, month, date,
  count(fetch_latency_ms) AS count,
  {sql_round('avg(fetch_latency_ms)', 1)} AS latency_mean,
  {sql_round('stddev_samp(fetch_latency_ms)', 1)} AS latency_std,
  {sql_round('min(fetch_latency_ms)', 1)} AS latency_min,
  {sql_round('quantile_cont(fetch_latency_ms, 0.25)', 1)} AS latency_p25,
  {sql_round('quantile_cont(fetch_latency_ms, 0.5)', 1)} AS latency_p50,
  {sql_round('quantile_cont(fetch_latency_ms, 0.75)', 1)} AS latency_p75,
  {sql_round('max(fetch_latency_ms)', 1)} AS latency_max
FROM ticks GROUP BY symbol, year, month, date""")


def q_latency_overall(spark, sf):
    """The latency description of all ticks, its quartiles found by counting passes."""
    return agg.latency_summary(fixture_ticks(spark, sf), by=())


SQL_LATENCY_OVERALL = SQL_LATENCY_SUMMARY.replace("SELECT symbol, year, month, date,", "SELECT").replace("FROM ticks GROUP BY symbol, year, month, date", "FROM ticks")


# Bars whose prices are planted at or below zero.
_BAD_EVERY = 7


def q_bad_price_outcomes(spark, sf):
    """Outcomes over a log in which every seventh bar closes at a negative or zero price."""
    from .ticks import event_states
    ev = fx.fixture_poll_events(spark, sf)
    slot = F.floor(F.unix_micros("bar_utc") / int(W_US_SQL))
    planted = [F.when((slot % _BAD_EVERY == 0) & (F.col("high") != F.col("low")), F.when(slot % 2 == 0, -F.col(c)).otherwise(F.lit(0.0) * F.col(c)) if c == "close" else F.col(c))
               .otherwise(F.col(c)).alias(c) for c in ("open", "high", "low", "close")]
    ev = ev.select(*[c for c in ev.columns if c not in ("open", "high", "low", "close")], *planted)
    return event_states(ev).select("symbol", "poll_id", "session_date", "base_outcome", "outcome", "fail_streak", "tick_no")


def _bad_price_ctes() -> list:
    out = []
    for name, sql in O.pipeline_ctes():
        out.append((name, sql))
        if name == "snaps":
            out[-1] = ("snaps_fine", sql)
            out.append(("snaps", f"""  SELECT * REPLACE (CASE WHEN slot % {_BAD_EVERY} = 0 AND high <> low THEN CASE WHEN slot % 2 = 0 THEN -close ELSE 0.0 END
    ELSE close END AS close) FROM snaps_fine"""))
    return out


SQL_BAD_PRICE = O.with_ctes(_bad_price_ctes(), "SELECT symbol, poll_id, session_date, base_outcome, outcome, fail_streak, tick_no FROM states")


def q_provider_rows(spark, sf):
    """One symbol's bars as the provider names them (two-level, mixed case), flattened, with the constant symbol put back."""
    from ..operators.clean import normalise_columns
    from ..sources.polls import with_symbol
    bars = _bars(spark, sf).where("symbol = 'click'").select("slot", "open", "high", "low", "close", "volume")
    named = bars.toDF("Slot", *[f"('{c.capitalize()}', 'click')" for c in bars.columns[1:]])
    return with_symbol(normalise_columns(named), "^IDX")


SQL_PROVIDER_ROWS = O.with_ctes(O.fixture_ctes(), "SELECT '^IDX' AS symbol, slot, open, high, low, close, volume FROM bars WHERE symbol = 'click'")


def q_schema_checks(spark, sf):
    """The schema rule (EXP-9) on an older-layout table before and after newer rows were appended, and the difference found between."""
    from ..operators.expectations import schema_rows
    from ..session import fresh_dir, materialised
    from ..sinks.tables import append_ticks, schema_diff_df
    t = materialised(fixture_ticks(spark, sf), "schema-rows")
    name = _table_name("ticks_schema")
    append_ticks(spark, t.drop(*LEGACY_MISSING), name, location=fresh_dir(spark, "schema"))
    old = spark.table(name).schema
    before, diff = schema_rows(spark, old), schema_diff_df(spark, old, t.schema)
    append_ticks(spark, t, name, create=False)
    parts = [before.select(F.lit("before").alias("stage"), "check", "ok"),
             diff.select(F.lit("difference"), "column", F.col("in_table") & F.col("in_frame") & (F.col("type_table") == F.col("type_frame"))),
             schema_rows(spark, spark.table(name).schema).select(F.lit("after"), "check", "ok")]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).select("stage", "check", F.coalesce("ok", F.lit(False)).alias("ok"))


def _schema_checks_sql() -> str:
    checks = [(f"int:{c}", True) for c in INT_COLUMNS]
    rows = [("before", c, ok) for c, ok in [*checks, *((f"present:{c}", False) for c in LEGACY_MISSING)]]
    rows += [("difference", c, c not in LEGACY_MISSING) for c in TICK_COLUMNS]
    rows += [("after", c, True) for c, _ in [*checks, *((f"present:{c}", True) for c in LEGACY_MISSING)]]
    return "SELECT * FROM (VALUES " + ", ".join(f"('{s}', '{c}', {ok})" for s, c, ok in rows) + ") v(stage, \"check\", ok)"


def q_session_totals(spark, sf):
    return agg.session_totals(fixture_states(spark, sf))


def _n(label):
    return f"CAST(sum(CASE WHEN outcome = '{label}' THEN 1 ELSE 0 END) AS INTEGER) AS n_{label.lower()}"


SQL_SESSION_TOTALS = _sql(f"""SELECT symbol, session_date, CAST(count(*) AS INTEGER) AS n_polls,
  {', '.join(_n(x) for x in ('GOOD', 'STALE', 'COLLAPSED', 'BAD_PRICE', 'FETCH_FAILED', 'AFTER_ABORT'))},
  max(fail_streak) AS max_fail_streak,
  max(CASE WHEN outcome <> 'AFTER_ABORT' THEN poll_id END) AS last_poll_id,
  max(CASE WHEN outcome <> 'AFTER_ABORT' THEN end_mkt END) AS ended_at,
  max(CASE WHEN outcome = 'GOOD' THEN tick_no END) AS ticks_total,
  max(CASE WHEN fail_streak >= {DEFAULT.max_bad_ticks} THEN 1 ELSE 0 END) AS aborted
FROM states GROUP BY symbol, session_date""")


def q_day_counts(spark, sf):
    return agg.day_counts(fixture_ticks(spark, sf))


SQL_DAY_COUNTS = O.with_ctes(O.ticks_ctes(), """SELECT year, month, date, count(*) AS n_ticks
FROM ticks GROUP BY year, month, date""")


def q_day_check(spark, sf):
    from ..plans.verify import adaptive_select
    return adaptive_select(fixture_ticks(spark, sf))


SQL_DAY_CHECK = O.with_ctes(O.ticks_ctes(), """SELECT tick_ts, bar_ts, tick_time_str, bar_time_str, open, high,
  low, close, vwap, log_return, price_range, session_number, expiry, days_to_expiry, data_quality,
  fetch_latency_ms FROM ticks ORDER BY bar_ts""")


def q_flush_batches(spark, sf):
    t = fixture_ticks(spark, sf, keep=("session_date", "tick_no"))
    return agg.flush_batches(t)


SQL_FLUSH_BATCHES = O.with_ctes(O.ticks_ctes(extra="session_date, tick_no"), f"""SELECT symbol, session_date,
  CAST((tick_no - 1) // {FLUSH_EVERY} AS INTEGER) AS flush_batch, CAST(count(*) AS INTEGER) AS rows,
  min(tick_no) AS first_tick, max(tick_no) AS last_tick, count(*) < {FLUSH_EVERY} AS final_partial
FROM ticks GROUP BY symbol, session_date, (tick_no - 1) // {FLUSH_EVERY}""")


def q_union_append(spark, sf):
    """Older-layout rows (each session's first flush) unioned by name with newer rows."""
    from ..session import materialised
    # Both sides of the union read one materialised copy of the tick rows.
    t = materialised(fixture_ticks(spark, sf, keep=("tick_no",)), "union-rows")
    first = F.col("tick_no") <= FLUSH_EVERY
    old = t.where(first).drop(*LEGACY_MISSING)
    new = t.where(~first)
    return old.unionByName(new, allowMissingColumns=True).drop("tick_no")


_LEGACY_SELECT = ", ".join(
    (f"CASE WHEN tick_no <= {FLUSH_EVERY} THEN NULL ELSE {c} END AS {c}" if c in LEGACY_MISSING else c)
    for c in TICK_COLUMNS)
SQL_UNION_APPEND = O.with_ctes(O.ticks_ctes(extra="tick_no"), f"SELECT {_LEGACY_SELECT} FROM ticks")


def q_symbol_safe(spark, sf):
    t = fixture_ticks(spark, sf, keep=("session_date",))
    return (t.groupBy("symbol", "session_date").agg(F.count(F.lit(1)).alias("rows"))
            .select("symbol", "session_date", symbol_safe("symbol").alias("symbol_safe"),
                    F.concat(symbol_safe("symbol"), F.lit("_"), cal.session_string("session_date"),
                             F.lit(".csv")).alias("csv_file"), "rows"))


SQL_SYMBOL_SAFE = O.with_ctes(O.ticks_ctes(extra="session_date"), """SELECT symbol, session_date,
  replace(replace(symbol, '^', ''), '.', '_') AS symbol_safe,
  replace(replace(symbol, '^', ''), '.', '_') || '_' || strftime(session_date, '%Y_%m_%d') || '.csv'
    AS csv_file, count(*) AS rows
FROM ticks GROUP BY symbol, session_date""")


def q_bar_lag(spark, sf):
    s = fixture_states(spark, sf).where(F.col("outcome") == "GOOD")
    return s.select("symbol", "poll_id",
                    round_half_up(cal.seconds_between(F.col("bar_ts"), _mkt("fetch_start")), 1)
                    .alias("bar_lag_s"),
                    fetch_latency_ms().alias("fetch_latency_ms"))


SQL_BAR_LAG = _sql(f"""SELECT symbol, poll_id,
  {sql_round('(epoch_us(start_mkt) - epoch_us(bar_ts)) / 1e6', 1)} AS bar_lag_s,
  {sql_round('latency_us / 1000.0', 1)} AS fetch_latency_ms
FROM states WHERE outcome = 'GOOD'""")


def q_expectations(spark, sf):
    t = fixture_ticks(spark, sf, keep=("session_date",))
    return expectation_report(t, session_col="session_date")


def _expectations_sql(planted: list | None = None, session: str = "session_date") -> str:
    part = f"PARTITION BY symbol, {session} ORDER BY coalesce(bar_ts, tick_ts), tick_ts"
    day = "coalesce(CAST(bar_ts AS DATE), make_date(year, month, date))"
    rules = {
        "EXP-1": "NOT (days_to_expiry BETWEEN 0 AND 6) OR ((expiry = 1) <> (days_to_expiry = 0))",
        "EXP-2": f"is_monthly_expiry = 1 AND (expiry <> 1 OR {day} <> {O.last_expiry_sql(day)})",
        "EXP-3": f"week_of_month <> CAST((dayofmonth({day}) - 1) // 7 + 1 AS INTEGER) OR NOT (week_of_month BETWEEN 1 AND 5)",
        "EXP-4": f"session_number <> {O.session_number_sql('coalesce(hour(bar_ts), hour)')}",
        "EXP-5": "data_quality NOT IN ('BAD_PRICE', 'SPIKE', 'OK_NO_VOL', 'OK') OR data_quality <> "
                 "(CASE WHEN close <= 0 THEN 'BAD_PRICE' WHEN prev_close_rt IS NOT NULL AND prev_close_rt > 0"
                 f" AND abs(close - prev_close_rt) / prev_close_rt > {DEFAULT.spike_pct} THEN 'SPIKE'"
                 " WHEN volume = 0 THEN 'OK_NO_VOL' ELSE 'OK' END)",
        "EXP-6": "upper_shadow < 0 OR lower_shadow < 0 OR NOT (body_pct BETWEEN 0 AND 100) OR hl_ratio < 1",
        "EXP-7": "vwap < round(run_low, 2) OR vwap > round(run_high, 2)",
        "EXP-8": "high = low AND low = open AND open = close AND close > 0",
        "EXP-11": f"NOT ({O.weekday('tick_ts')} < 5 AND hour(tick_ts) * 60 + minute(tick_ts)"
                  f" BETWEEN {DEFAULT.open_minute} AND {DEFAULT.close_minute})",
        "EXP-12": f"{day} <> {session}",
    }
    v = ", ".join(f"({e}) AS v{i}" for i, e in enumerate(rules.values()))
    sums = " UNION ALL ".join(f"SELECT '{k}' AS rule, count(v{i}) AS checked, count(*) FILTER (v{i}) AS violations FROM viol" for i, k in enumerate(rules))
    ctes = O.ticks_ctes(extra="session_date, tick_no") + [
        ("planted", f"  SELECT * REPLACE ({', '.join(f'{e} AS {c}' for c, e in planted)}) FROM ticks" if planted else "  SELECT * FROM ticks"),
        ("win", f"""  SELECT *, lag(close) OVER ({part}) AS prev_close_rt,
         min(low) OVER ({part} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_low,
         max(high) OVER ({part} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_high
  FROM planted"""),
        ("viol", f"  SELECT {v} FROM win"),
    ]
    return O.with_ctes(ctes, sums)


# One rule broken in every thirteenth tick each, and the older layout in another thirteenth (both engines read this text).
PLANTED = [
    ("bar_ts", "CASE WHEN tick_no % 13 = 0 THEN NULL WHEN tick_no % 13 = 10 THEN bar_ts - INTERVAL 3 DAY ELSE bar_ts END"),
    ("bar_time_str", "CASE WHEN tick_no % 13 = 0 THEN NULL ELSE bar_time_str END"),
    ("days_to_expiry", "CASE WHEN tick_no % 13 = 1 THEN 9 ELSE days_to_expiry END"),
    ("is_monthly_expiry", "CASE WHEN tick_no % 13 = 2 THEN 1 ELSE is_monthly_expiry END"),
    ("expiry", "CASE WHEN tick_no % 13 = 2 THEN 0 ELSE expiry END"),
    ("week_of_month", "CASE WHEN tick_no % 13 = 3 THEN 6 ELSE week_of_month END"),
    ("session_number", "CASE WHEN tick_no % 13 = 4 THEN 9 ELSE session_number END"),
    ("data_quality", "CASE WHEN tick_no % 13 = 5 THEN 'BROKEN' ELSE data_quality END"),
    ("hl_ratio", "CASE WHEN tick_no % 13 = 6 THEN CAST(0.5 AS DOUBLE) ELSE hl_ratio END"),
    ("vwap", "CASE WHEN tick_no % 13 = 7 THEN CAST(-1 AS DOUBLE) ELSE vwap END"),
    *[(c, f"CASE WHEN tick_no % 13 = 8 THEN CAST(5 AS DOUBLE) ELSE {c} END") for c in ("open", "high", "low", "close")],
    ("tick_ts", "CASE WHEN tick_no % 13 = 9 THEN tick_ts - INTERVAL 12 HOUR ELSE tick_ts END"),
]


def q_expectations_planted(spark, sf):
    """Every rule broken somewhere, older rows among newer ones, no session column: the report's violated branches."""
    t = fixture_ticks(spark, sf, keep=("session_date", "tick_no"))
    t = t.select(*[F.expr(dict(PLANTED)[c]).alias(c) if c in dict(PLANTED) else F.col(c) for c in t.columns])
    return expectation_report(t.drop("session_date"))


def q_expectations_stored(spark, sf):
    """A stored report, continued after an append to some of the days: equal to the report of the whole table."""
    from ..session import fresh_dir, materialised
    from ..sinks.tables import append_ticks
    from .report import stored_report
    base, name = fresh_dir(spark, "report"), _table_name("ticks_report")
    t = fixture_ticks(spark, sf, keep=("tick_no",))
    t = materialised(t.select(*[F.expr(dict(PLANTED)[c]).alias(c) if c in dict(PLANTED) else F.col(c) for c in t.columns]), "report-rows")
    early = (F.col("date") <= 15) | (F.col("tick_no") <= FLUSH_EVERY)
    append_ticks(spark, t.where(early).drop("tick_no"), name, location=f"{base}/table")
    stored_report(spark, name, f"{base}/report")
    append_ticks(spark, t.where(~early).drop("tick_no"), name, create=False)
    return stored_report(spark, name, f"{base}/report")


# ---------------------------------------------------------------- sinks, tables, streams
def _ticks_keyed(spark, sf):
    return fixture_ticks(spark, sf, keep=("session_date",))


def _table_name(prefix: str) -> str:
    import uuid
    return f"default.{prefix}_{uuid.uuid4().hex[:10]}"


def q_table_roundtrip(spark, sf):
    """DDL + partitioned append + table scan."""
    from ..session import fresh_dir
    from ..sinks.tables import append_ticks
    name = _table_name("ticks_rt")
    append_ticks(spark, fixture_ticks(spark, sf), name, location=fresh_dir(spark, "table"))
    return spark.table(name).select(*TICK_COLUMNS)


def q_csv_roundtrip(spark, sf):
    from ..session import fresh_dir
    from ..sinks import files
    path = fresh_dir(spark, "csv")
    files.write_csv(_ticks_keyed(spark, sf), path, session_col="session_date")
    return files.strip_keys(files.read_csv(spark, path))


def q_parquet_roundtrip(spark, sf):
    from ..session import fresh_dir
    from ..sinks import files
    path = fresh_dir(spark, "parquet")
    files.write_parquet(_ticks_keyed(spark, sf), path, session_col="session_date")
    return files.strip_keys(files.read_parquet(spark, path))


def q_schema_evolution(spark, sf):
    """Older-layout table, first flushes appended, evolved by ALTER TABLE, newer rows appended."""
    from ..session import fresh_dir
    from ..sinks.tables import append_ticks
    from ..session import materialised
    name = _table_name("ticks_evo")
    # Two appends read one materialised copy instead of recomputing from the events scan.
    t = materialised(fixture_ticks(spark, sf, keep=("tick_no",)), "evo-rows")
    first = F.col("tick_no") <= FLUSH_EVERY
    append_ticks(spark, t.where(first).drop("tick_no", *LEGACY_MISSING), name,
                 location=fresh_dir(spark, "evo"))
    append_ticks(spark, t.where(~first).drop("tick_no"), name, create=False)
    return spark.table(name).select(*TICK_COLUMNS)


def q_sink_fanout(spark, sf):
    """All three sinks written from one persisted frame, then compared with it (EXP-10)."""
    from ..operators.expectations import sinks_agree
    from ..session import fresh_dir, materialised
    from ..sinks.fanout import Sinks, fan_out
    base = fresh_dir(spark, "fanout")
    name = _table_name("ticks_fan")
    # The sinks and the reference read one copy in the shared folder.
    t = materialised(_ticks_keyed(spark, sf), "fan-out-rows")
    fan_out(spark, t, name, f"{base}/csv", f"{base}/parquet", session_col="session_date",
            table_location=f"{base}/table")
    return sinks_agree(t.select(*TICK_COLUMNS), Sinks(name, f"{base}/csv", f"{base}/parquet").read(spark))


SQL_SINK_FANOUT = O.with_ctes(O.ticks_ctes(), " UNION ALL ".join(
    f"SELECT '{k}' AS sink, count(*) AS rows, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS extra FROM ticks"
    for k in ("table", "csv", "parquet")))


def q_stream_ticks(spark, sf):
    from ..streaming.run import stream_ticks
    return stream_ticks(spark, fx.fixture_poll_events(spark, sf), None)


def _scattered(n: int = 3):
    """Row conditions that deal the rows of every poll over ``n`` landings."""
    deal = F.pmod(F.xxhash64("symbol", "poll_id", "seq"), F.lit(n))
    return [deal == k for k in range(n)]


def q_stream_ticks_multi_batch(spark, sf):
    """Polls split between files and triggers, in no order: the batch result once the sessions' end markers have come."""
    from ..streaming.run import stream_ticks
    return stream_ticks(spark, fx.fixture_poll_events(spark, sf), None, DEFAULT.with_(live_delay_s=10 ** 9), _scattered(), max_files=25)


def q_stream_late_polls(spark, sf):
    """Polls landed out of order beyond the delay: every one is folded or reported late, none is lost."""
    from ..streaming.run import stream_poll_states
    deal = F.pmod(F.xxhash64("symbol", "poll_id"), F.lit(3))
    st = stream_poll_states(spark, fx.fixture_poll_events(spark, sf), None, parts=[deal == k for k in range(3)], max_files=25)
    return st.groupBy("symbol", "session_date").agg(F.countDistinct("poll_id").alias("n_polls"))


SQL_STREAM_LATE = _sql("SELECT symbol, session_date, count(*) AS n_polls FROM polls GROUP BY symbol, session_date", O.fixture_ctes())


def q_stream_dedup(spark, sf):
    from ..streaming.run import stream_dedup
    return stream_dedup(spark, fx.fixture_poll_events(spark, sf), None, _scattered(), max_files=25).select("symbol", _mkt().alias("bar_ts"))


def _live_ticks(spark, sf, p, parts, ended=True):
    """Live mode over a landing folder into fresh sinks, worked off; the tick table as its readers see it."""
    from ..session import fresh_dir
    from ..streaming.run import land_poll_log, start_live
    base, name = fresh_dir(spark, "live"), _table_name("ticks_live")
    land_poll_log(spark, fx.fixture_poll_events(spark, sf), None, f"{base}/landing", parts, ended)
    start_live(spark, f"{base}/landing", name, f"{base}/csv", f"{base}/parquet", f"{base}/checkpoint", p, table_location=f"{base}/table",
               max_files=60, drain=True).awaitTermination()
    return spark.table(name).select(*TICK_COLUMNS)


def q_stream_restated(spark, sf):
    """A third of the polls landed after all others had been folded and their sessions closed: restated, the table is the batch result."""
    deal = F.pmod(F.xxhash64("symbol", "poll_id"), F.lit(3)) == 0
    return _live_ticks(spark, sf, DEFAULT.with_(live_delay_s=0), [~deal, deal])


def q_stream_dedup_exact(spark, sf):
    """Distinct bars of scattered landings over several triggers, without streaming state."""
    from ..session import fresh_dir
    from ..streaming.run import land_poll_log, start_dedup, stored_bars
    base = fresh_dir(spark, "bars")
    land_poll_log(spark, fx.fixture_poll_events(spark, sf), None, f"{base}/landing", _scattered())
    start_dedup(spark, f"{base}/landing", f"{base}/bars", f"{base}/checkpoint", max_files=40, drain=True).awaitTermination()
    return stored_bars(spark, f"{base}/bars").select("symbol", _mkt().alias("bar_ts"))


def q_sink_retry(spark, sf):
    """A micro-batch staged in all three sinks but not published, then written again and again: readers see its rows once."""
    from ..operators.expectations import sinks_agree
    from ..session import fresh_dir, materialised
    from ..sinks import fanout, files
    base, name = fresh_dir(spark, "retry"), _table_name("ticks_retry")
    t = materialised(fixture_ticks(spark, sf), "retry-rows")
    sinks = fanout.Sinks(name, f"{base}/csv", f"{base}/parquet", f"{base}/table")
    fanout._stage(spark, files.with_file_keys(t), sinks, sinks.ledger(spark), "first-try")       # the first try ended here
    write = fanout.batch_writer(name, f"{base}/csv", f"{base}/parquet", table_location=f"{base}/table")
    write(t, 7)
    write(t, 7)
    return sinks_agree(t, sinks.read(spark))


# Symbols that one file-safe name stands for.
_TWINS = {"click": "^A.B", "purchase": "A_B"}


def q_sink_append_twice(spark, sf):
    """A session's halves written one after the other and repeated, live batches and a whole run over the same sessions, symbols with one
    file-safe name, then the attempts compacted: every sink reads every tick once."""
    from ..session import fresh_dir, materialised
    from ..sinks import fanout
    base, name = fresh_dir(spark, "twice"), _table_name("ticks_twice")
    t = fixture_ticks(spark, sf, keep=("session_date", "tick_no"))
    t = materialised(t.replace(_TWINS, subset=["symbol"]), "twice-rows")
    where = (name, f"{base}/csv", f"{base}/parquet", "session_date", f"{base}/table")
    half = F.col("tick_no") % 2 == 0
    for write_id, rows in (("first", t.where(half)), ("second", t.where(~half)), ("first", t.where(half))):
        fanout.fan_out(spark, rows.drop("tick_no"), *where, write_id=write_id)
    live = fanout.batch_writer(*where)
    for k in range(2):
        live(t.where(F.col("tick_no") % 3 == k).drop("tick_no"), k)
    fanout.fan_out(spark, t.drop("tick_no"), *where)
    sinks = fanout.Sinks(name, f"{base}/csv", f"{base}/parquet", f"{base}/table")
    fanout.compact(spark, sinks, "9999_12_31")
    parts = [df.select(F.lit(sink).alias("sink"), *TICK_COLUMNS) for sink, df in sinks.read(spark).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


SQL_SINK_APPEND_TWICE = O.with_ctes(O.ticks_ctes(), f"""SELECT sink, t.* REPLACE (CASE symbol {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in _TWINS.items())}
  ELSE symbol END AS symbol) FROM ticks t, (VALUES ('table'), ('csv'), ('parquet')) s(sink)""")


def q_two_table_ticks(spark, sf):
    """The tick table from polls and bar snapshots as two tables (the join of polls with their bar)."""
    from .ticks import ticks
    return ticks(*fx.fixture_poll_log(spark, sf))


CHECK_DAY = (2024, 1, 16)


def q_day_check_one_day(spark, sf):
    """One day's rows from the partitioned table, numbered in the check's order."""
    from pyspark.sql import Window
    from ..session import fresh_dir
    from ..sinks.tables import append_ticks
    from .verify import adaptive_select, day_filter
    name = _table_name("ticks_day")
    append_ticks(spark, fixture_ticks(spark, sf), name, location=fresh_dir(spark, "day"))
    day = day_filter(spark.table(name), *CHECK_DAY)
    order = Window.partitionBy("year", "month", "date").orderBy("bar_ts", "symbol", "tick_ts")
    numbered = day.withColumn("n", F.row_number().over(order))
    return adaptive_select(numbered, ["n", "symbol", "bar_ts", "tick_ts", "close", "vwap", "data_quality"])


SQL_DAY_CHECK_ONE = O.with_ctes(O.ticks_ctes(), """SELECT CAST(row_number() OVER (ORDER BY bar_ts, symbol, tick_ts) AS INTEGER) AS n, symbol,
  bar_ts, tick_ts, close, vwap, data_quality FROM ticks WHERE year = %d AND month = %d AND date = %d""" % CHECK_DAY)


SQL_STREAM_DEDUP = _sql(f"SELECT DISTINCT symbol, {O.mkt_from_micros('slot * ' + W_US_SQL)} AS bar_ts FROM snaps",
                        O.fixture_ctes())


# ---------------------------------------------------------------- registry
QUERIES: dict = {
    "tick_table": (q_tick_table, SQL_TICK_TABLE),
    "tick_table_split_sessions": (q_tick_table_split_sessions, SQL_TICK_TABLE),
    "bars_ist": (q_bars_ist, SQL_BARS_IST),
    "calendar_dims": (q_calendar_dims, SQL_CALENDAR_DIMS),
    "expiry_features": (q_expiry_features, SQL_EXPIRY_FEATURES),
    "session_bucket": (q_session_bucket, SQL_SESSION_BUCKET),
    "market_state": (q_market_state, SQL_MARKET_STATE),
    "market_hours": (q_market_hours, SQL_MARKET_HOURS),
    "candle_features": (q_candle_features, SQL_CANDLE_FEATURES),
    "typical_price": (q_typical_price, SQL_TYPICAL_PRICE),
    "nan_safe_ohlcv": (q_nan_safe_ohlcv, SQL_NAN_SAFE),
    "dedup_keep_last": (q_dedup_keep_last, SQL_DEDUP),
    "last_closed_bar": (q_last_closed_bar, SQL_LAST_CLOSED),
    "poll_outcomes": (q_poll_outcomes, SQL_POLL_OUTCOMES),
    "fail_streak_abort": (q_fail_streak_abort, SQL_FAIL_STREAK),
    "tick_numbers": (q_tick_numbers, SQL_TICK_NUMBERS),
    "log_returns": (q_log_returns, SQL_LOG_RETURNS),
    "running_vwap": (_vwap_query(GOOD_ONLY), _vwap_sql(GOOD_ONLY)),
    "running_vwap_all_polls": (_vwap_query(DEFAULT), _vwap_sql(DEFAULT)),
    "data_quality": (q_data_quality, SQL_DATA_QUALITY),
    "quality_counts": (q_quality_counts, SQL_QUALITY_COUNTS),
    "latency_summary": (q_latency_summary, SQL_LATENCY_SUMMARY),
    "latency_overall": (q_latency_overall, SQL_LATENCY_OVERALL),
    "bad_price_outcomes": (q_bad_price_outcomes, SQL_BAD_PRICE),
    "provider_rows": (q_provider_rows, SQL_PROVIDER_ROWS),
    "schema_checks": (q_schema_checks, _schema_checks_sql()),
    "session_totals": (q_session_totals, SQL_SESSION_TOTALS),
    "day_counts": (q_day_counts, SQL_DAY_COUNTS),
    "day_check": (q_day_check, SQL_DAY_CHECK),
    "flush_batches": (q_flush_batches, SQL_FLUSH_BATCHES),
    "union_append": (q_union_append, SQL_UNION_APPEND),
    "symbol_safe": (q_symbol_safe, SQL_SYMBOL_SAFE),
    "bar_lag": (q_bar_lag, SQL_BAR_LAG),
    "expectations": (q_expectations, _expectations_sql()),
    "expectations_stored": (q_expectations_stored, _expectations_sql(PLANTED, "CAST(tick_ts AS DATE)")),
    "expectations_planted": (q_expectations_planted, _expectations_sql(PLANTED, "CAST(tick_ts AS DATE)")),
    "table_roundtrip": (q_table_roundtrip, SQL_TICK_TABLE),
    "csv_roundtrip": (q_csv_roundtrip, SQL_TICK_TABLE),
    "parquet_roundtrip": (q_parquet_roundtrip, SQL_TICK_TABLE),
    "schema_evolution": (q_schema_evolution, SQL_UNION_APPEND),
    "sink_fanout": (q_sink_fanout, SQL_SINK_FANOUT),
    "stream_ticks": (q_stream_ticks, SQL_TICK_TABLE),
    "stream_dedup": (q_stream_dedup, SQL_STREAM_DEDUP),
    "stream_ticks_multi_batch": (q_stream_ticks_multi_batch, SQL_TICK_TABLE),
    "stream_late_polls": (q_stream_late_polls, SQL_STREAM_LATE),
    "stream_restated": (q_stream_restated, SQL_TICK_TABLE),
    "stream_dedup_exact": (q_stream_dedup_exact, SQL_STREAM_DEDUP),
    "sink_retry": (q_sink_retry, SQL_SINK_FANOUT),
    "sink_append_twice": (q_sink_append_twice, SQL_SINK_APPEND_TWICE),
    "two_table_ticks": (q_two_table_ticks, SQL_TICK_TABLE),
    "day_check_one_day": (q_day_check_one_day, SQL_DAY_CHECK_ONE),
}

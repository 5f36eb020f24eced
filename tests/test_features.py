"""Candle, VWAP, quality and golden-row checks (FIXTURES.md F1, F2)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tickframe.functions import candle as cd
from tickframe.functions.quality import data_quality, quality_ok, symbol_safe
from tickframe.functions.rounding import round_half_up
from tickframe.plans.ticks import ticks
from tickframe.schema import TICK_COLUMNS
from tickframe.sources.polls import poll_log_from_rows

UTC = dt.timezone.utc


@pytest.mark.parametrize("o,h,l,c", [(50.0, 58.0, 48.0, 55.0), (55.0, 58.0, 48.0, 50.0), (12.5, 12.5, 12.0, 12.0)])
def test_candle_features_follow_from_the_prices(spark, o, h, l, c):
    df = spark.createDataFrame([(o, h, l, c)], "o double, h double, l double, c double")
    rng = cd.price_range("h", "l")
    r = df.select(rng.alias("rng"), cd.upper_shadow("o", "h", "c").alias("us"), cd.lower_shadow("o", "l", "c").alias("ls"),
                  cd.return_pct("o", "c").alias("ret"), cd.body_pct("o", "c", rng).alias("body"), cd.hl_ratio("h", "l").alias("hl")).first()
    assert (r.rng, r.us, r.ls) == (h - l, h - max(o, c), min(o, c) - l)
    assert r.us + r.ls + abs(c - o) == pytest.approx(r.rng)
    assert r.ret == pytest.approx((c - o) / o * 100, abs=5e-5) and r.body == pytest.approx(abs(c - o) / (h - l) * 100, abs=5e-3)
    assert r.hl == pytest.approx(h / l, abs=5e-7)


def test_candle_guards(spark):
    df = spark.createDataFrame([(0.0, 5.0, 0.0, 5.0, None), (10.0, 10.0, 10.0, 10.0, 0.0)],
                               "o double, h double, l double, c double, p double")
    rows = df.select(cd.return_pct("o", "c").alias("ret"), cd.hl_ratio("h", "l").alias("hl"),
                     cd.body_pct("o", "c", cd.price_range("h", "l")).alias("body"),
                     cd.log_return("c", "p").alias("lr")).collect()
    assert rows[0].ret == 0.0 and rows[0].hl == 1.0 and rows[0].lr == 0.0
    assert rows[1].body == 0.0 and rows[1].lr == 0.0


def test_log_return_sign(spark):
    df = spark.createDataFrame([(64.0, 60.0), (57.0, 60.0)], "c double, p double")
    a, b = [r[0] for r in df.select(cd.log_return("c", "p")).collect()]
    assert (a, b) == (round(math.log(64 / 60), 6), round(math.log(57 / 60), 6)) and b < 0 < a


def quality_by_hand(close, volume, before, limit=0.05):
    if close <= 0:
        return "BAD_PRICE"
    if before is not None and before > 0 and abs(close - before) / before > limit:
        return "SPIKE"
    return "OK_NO_VOL" if volume == 0 else "OK"


def test_data_quality_over_a_grid(spark):
    """Every rule, alone and against the ones before it: sign of the price, size of the move either way, volume, unknown previous close."""
    closes = [-3.0, 0.0, 0.01, 380.0, 379.9, 381.0, 399.0, 400.0, 419.0, 420.5, 800.0]
    cases = [(c, v, p) for c in closes for v in (0.0, 17.0) for p in (None, 0.0, -1.0, 400.0)]
    df = spark.createDataFrame(cases, "c double, v double, p double")
    got = df.select("c", "v", "p", data_quality("c", "v", "p").alias("q")).collect()
    assert {(r.c, r.v, r.p): r.q for r in got} == {x: quality_by_hand(*x) for x in cases}
    assert {r.q for r in got} == {"BAD_PRICE", "SPIKE", "OK_NO_VOL", "OK"}


def test_spike_boundary_is_strict(spark):
    df = spark.createDataFrame([(105.0, 1.0, 100.0)], "c double, v double, p double")
    # |105-100|/100 is 0.05 in binary arithmetic here only if exactly equal; the rule is strict ">".
    moved = abs(105.0 - 100.0) / 100.0
    expect = "SPIKE" if moved > 0.05 else "OK"
    assert df.select(data_quality("c", "v", "p")).first()[0] == expect


def test_quality_ok_and_symbol_safe(spark):
    df = spark.createDataFrame([("OK", "^IDX"), ("SPIKE", "BRK.B")], "q string, s string")
    r = df.select(quality_ok("q").alias("ok"), symbol_safe("s").alias("s")).collect()
    assert [x.ok for x in r] == [True, False] and [x.s for x in r] == ["IDX", "BRK_B"]


def test_collapsed_needs_four_equal_positive_prices(spark):
    flat = [7.25, 7.25, 7.25, 7.25]
    cases = [tuple(flat), (-1.0,) * 4, (0.0,) * 4]
    cases += [tuple(x + (0.5 if i == k else 0.0) for i, x in enumerate(flat)) for k in range(4)]  # any one differs
    df = spark.createDataFrame(cases, "o double, h double, l double, c double")
    got = [r[0] for r in df.select(cd.is_collapsed("o", "h", "l", "c")).collect()]
    assert got == [True] + [False] * 6


def test_round_half_up_ties(spark):
    df = spark.createDataFrame([(2.675,), (1.005,), (-1.005,), (0.78125,)], "x double")
    got = [r[0] for r in df.select(round_half_up(F.col("x"), 2)).collect()]
    assert got == [2.68, 1.01, -1.01, 0.78]
    assert df.select(round_half_up(F.col("x") * 1e20, 2)).first()[0] == pytest.approx(2.675e20)


def _poll(symbol, pid, session, start_utc, latency_ms, ok=True):
    end = start_utc + dt.timedelta(microseconds=int(round(latency_ms * 1000)))
    return (symbol, pid, session, start_utc, end, ok)


def test_vwap_example(spark):
    # Two bars; each poll also returns the live bar.
    s, day = "^IDX", dt.date(2026, 3, 23)
    t0 = dt.datetime(2026, 3, 23, 4, 0, tzinfo=UTC)
    polls = [_poll(s, 1, day, t0 + dt.timedelta(minutes=1, seconds=2), 300),
             _poll(s, 2, day, t0 + dt.timedelta(minutes=2, seconds=2), 300)]
    snaps = [(s, 1, 0, t0, 81.0, 84.0, 80.0, 82.0, 1500.0),
             (s, 1, 1, t0 + dt.timedelta(minutes=1), 1.0, 1.0, 1.0, 1.0, 0.0),
             (s, 2, 0, t0 + dt.timedelta(minutes=1), 82.0, 90.0, 81.0, 88.5, 4500.0),
             (s, 2, 1, t0 + dt.timedelta(minutes=2), 1.0, 1.0, 1.0, 1.0, 0.0)]
    p, b = poll_log_from_rows(spark, polls, snaps)
    out = ticks(p, b).orderBy("bar_ts").collect()
    tp1, tp2 = (84 + 80 + 82) / 3, (90 + 81 + 88.5) / 3
    assert out[0].vwap == round(tp1, 2)
    assert out[1].vwap == round((tp1 * 1500 + tp2 * 4500) / 6000, 2)
    assert 80 <= out[1].vwap <= 90


def test_golden_row(spark):
    """The one stored row: bar 15:28 IST of 2026-04-02, polled 2026-04-03 09:35:31.927661 IST."""
    # The one stored example row (as in test_tables.py), its prices and times as input and its columns as result.
    s = "^IDX"
    end = dt.datetime(2026, 4, 3, 4, 5, 31, 927661, tzinfo=UTC)
    start = end - dt.timedelta(microseconds=560500)
    bar = dt.datetime(2026, 4, 2, 9, 58, tzinfo=UTC)
    polls = [(s, 1, dt.date(2026, 4, 3), start, end, True)]
    snaps = [(s, 1, 0, bar, 22704.9, 22705.4, 22696.0, 22700.15, 0.0),
             (s, 1, 1, bar + dt.timedelta(minutes=1), 22700.0, 22700.0, 22700.0, 22700.0, 0.0)]
    p, b = poll_log_from_rows(spark, polls, snaps)
    r = ticks(p, b).first().asDict()
    expected = {
        "tick_ts": dt.datetime(2026, 4, 3, 9, 35, 31, 927661), "bar_ts": dt.datetime(2026, 4, 2, 15, 28),
        "tick_time_str": "09:35", "bar_time_str": "15:28", "symbol": "^IDX", "year": 2026, "month": 4,
        "date": 2, "day": 3, "hour": 15, "minute": 28, "week_of_month": 1, "open": 22704.9,
        "high": 22705.4, "low": 22696.0, "close": 22700.15, "volume": 0.0, "typical_price": 22700.52,
        "vwap": 22700.52, "price_range": 9.4, "return_pct": -0.0209, "log_return": 0.0, "body_pct": 50.53,
        "upper_shadow": 0.5, "lower_shadow": 4.15, "hl_ratio": 1.000414, "session_number": 6, "expiry": 0,
        "is_monthly_expiry": 0, "days_to_expiry": 5, "data_quality": "OK_NO_VOL", "fetch_latency_ms": 560.5,
    }
    assert list(r) == TICK_COLUMNS
    assert r == expected

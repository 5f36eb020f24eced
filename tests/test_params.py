"""Parameter validation (the collector's configuration checks)."""

import pytest

from tickframe.params import DEFAULT, Params


def test_defaults_are_the_collector_constants():
    assert DEFAULT.expiry_weekday == 1 and DEFAULT.flush_every == 10 and DEFAULT.max_bad_ticks == 5
    assert DEFAULT.spike_pct == 0.05 and DEFAULT.open_minute == 555 and DEFAULT.close_minute == 933
    assert DEFAULT.market_tz == "Asia/Kolkata" and DEFAULT.vwap_mode == "all_polls"


@pytest.mark.parametrize("kw", [dict(expiry_weekday=5), dict(expiry_weekday=-1), dict(flush_every=0),
                                dict(max_bad_ticks=0), dict(spike_pct=0.0005), dict(spike_pct=0.6),
                                dict(open_minute=900, close_minute=800), dict(vwap_mode="x"),
                                dict(market_tz="")])
def test_invalid_parameters_rejected(kw):
    with pytest.raises(ValueError):
        Params(**kw)


def test_all_errors_reported_together():
    with pytest.raises(ValueError) as e:
        Params(expiry_weekday=9, flush_every=0)
    assert "expiry_weekday" in str(e.value) and "flush_every" in str(e.value)


def test_with_returns_validated_copy():
    p = DEFAULT.with_(spike_pct=0.1)
    assert p.spike_pct == 0.1 and DEFAULT.spike_pct == 0.05
    with pytest.raises(ValueError):
        DEFAULT.with_(max_bad_ticks=0)


def test_rounding_is_one_rule_for_all_sizes(spark):
    from pyspark.sql import functions as F
    from tickframe.functions.rounding import round_half_up, sql_round
    import duckdb
    values = [1.005, 2.675, -1.005, 0.0, 1e12 + 0.125, 123456789012.345, 4e15 + 0.5, 1e17, -1e20, 1e300, 2.0 ** 52]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(round_half_up(F.col("x"), 2)).collect()]
    sql = [r[0] for r in df.selectExpr(sql_round("x", 2)).collect()]
    assert got == sql and got[:3] == [1.01, 2.68, -1.01] and got[4:6] == [1e12 + 0.13, 123456789012.35] and got[7:] == values[7:]
    duck = [duckdb.sql(f"SELECT {sql_round(f'CAST({v!r} AS DOUBLE)', 2)}").fetchall()[0][0] for v in values]
    assert duck == got


def test_open_and_close_break_ties_by_event_id(spark):
    from tickframe.sources.fixtures import bars_from_events
    rows = [(i, float(i * 7 % 1000)) for i in range(1000)]
    df = spark.createDataFrame(rows, "event_id long, value double").selectExpr("event_id", "timestamp_ntz'2024-01-03 10:00:00' AS ts", "'x' AS event_type", "value")
    r = bars_from_events(df.repartition(7)).first()
    assert (r.open, r.close) == (0.0, 999 * 7 % 1000)

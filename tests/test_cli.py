"""Command line: build from a landed poll log, verify a day, report expectations."""

import datetime as dt

from conftest import SF001
from tickframe.__main__ import main
from tickframe.session import fresh_dir
from tickframe.sources.fixtures import fixture_poll_events, fixture_poll_log


def test_cli_round_trip(spark, capsys):
    base = fresh_dir(spark, "cli")
    polls, snaps = fixture_poll_log(spark, SF001, bar_minutes=360)
    polls.write.parquet(f"{base}/polls")
    snaps.write.parquet(f"{base}/snaps")
    table = "default.cli_" + base.rsplit("-", 1)[-1]
    assert main(["ticks", "--polls", f"{base}/polls", "--snaps", f"{base}/snaps", "--table", table,
                 "--csv", f"{base}/csv", "--parquet", f"{base}/pq", "--table-location", f"{base}/t"],
                spark=spark) == 0
    day = spark.table(table).select("year", "month", "date").first()
    assert main(["verify", "--table", table, "--date", dt.date(day.year, day.month, day.date).isoformat()],
                spark=spark) == 0
    out = capsys.readouterr().out
    assert "ticks" in out and "data quality" in out and "latency ms" in out
    assert main(["expectations", "--table", table], spark=spark) == 0
    assert "EXP-12" in capsys.readouterr().out
    kept = ["expectations", "--table", table, "--csv", f"{base}/csv", "--parquet", f"{base}/pq", "--report-dir", f"{base}/report"]
    assert main(kept, spark=spark) == 0 and main(kept, spark=spark) == 0
    out = capsys.readouterr().out
    assert out.count("EXP-10") == 2 and len(set(out.splitlines())) == 12


def test_cli_poll_events_layout(spark):
    base = fresh_dir(spark, "cli2")
    fixture_poll_events(spark, SF001, bar_minutes=360).write.parquet(f"{base}/pe")
    table = "default.cli2_" + base.rsplit("-", 1)[-1]
    assert main(["ticks", "--poll-events", f"{base}/pe", "--table", table, "--csv", f"{base}/csv",
                 "--parquet", f"{base}/pq", "--table-location", f"{base}/t"], spark=spark) == 0
    assert spark.table(table).count() > 0

"""Command line: build ticks, verify a day, check expectations, run live mode.

    python -m tickframe ticks --polls P --snaps S --table T --csv C --parquet Q
    python -m tickframe ticks --poll-events E --table T --csv C --parquet Q
    python -m tickframe verify --table T --date 2026-04-02
    python -m tickframe expectations --table T --report-dir R
    python -m tickframe live --landing L --table T --csv C --parquet Q --checkpoint K

Only summary rows are brought to the driver and printed.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from dataclasses import fields

from pyspark.sql import functions as F

from .params import DEFAULT, Params


def _params(a):
    """The parameters given on the command line, the collector's defaults for the rest."""
    return DEFAULT.with_(**{f.name: getattr(a, f.name) for f in fields(Params) if getattr(a, f.name, None) is not None})


def _add_params(sp) -> None:
    """One option for every field of Params, checked by Params itself."""
    for f in fields(Params):
        flag, now = "--" + f.name.replace("_", "-"), getattr(DEFAULT, f.name)
        if isinstance(now, bool):
            sp.add_argument(flag, action=argparse.BooleanOptionalAction, default=None)
        else:
            kind = float if isinstance(now, float) else str if isinstance(now, str) else int
            sp.add_argument(flag, type=kind, choices=f.metadata["choices"], help=f"default {now}")


def _sessions(df, a):
    """Rows of the sessions asked for; on a log partitioned by session date only their folders are read."""
    if not a.session_date:
        return df
    last = dt.date.fromisoformat(a.to or a.session_date)
    return df.where(F.col("session_date").between(dt.date.fromisoformat(a.session_date), last))


def cmd_ticks(spark, a) -> int:
    from .functions.calendar import session_string
    from .plans.ticks import event_ticks, ticks
    from .sinks.fanout import replace_sessions
    from .sources.polls import read_poll_log
    from .streaming.live import read_landed
    p = _params(a)
    if a.poll_events:
        log = _sessions(read_landed(spark, a.poll_events, a.format), a)
        t = event_ticks(log, p, keep=("session_date",))
    else:
        polls, snaps = read_poll_log(spark, a.polls, a.snaps, a.format, symbol=a.symbol)
        log = _sessions(polls, a)
        t = ticks(log, snaps, p, keep=("session_date",))
    # Whole sessions: a corrected rerun takes the place of what was there, sessions without a tick included.
    covers = log.select("symbol", session_string("session_date").alias("session")).distinct()
    replace_sessions(spark, t, _sinks(a), "session_date", covers=covers)
    print(f"written to {a.table}, {a.csv}, {a.parquet}")
    return 0


def _sinks(a):
    from .sinks.fanout import Sinks
    return Sinks(a.table, a.csv, a.parquet, a.table_location, a.table_format)


def cmd_maintain(spark, a) -> int:
    from .sinks.fanout import compact, vacuum
    if a.compact_before:
        print("compacted" if compact(spark, _sinks(a), a.compact_before) else "nothing to compact")
    if a.vacuum_hours is not None:
        print(f"{vacuum(spark, _sinks(a), int(a.vacuum_hours * 3600))} folders deleted")
    return 0


def cmd_verify(spark, a) -> int:
    from .plans.verify import day_check
    d = dt.date.fromisoformat(a.date)
    res = day_check(spark, a.table, d.year, d.month, d.day)
    print(f"{d}: {res['count'].first().n_ticks} ticks")
    print("data quality:", {r.data_quality: r.n for r in res["quality"].collect()})
    lat = res["latency"].first()
    if lat is not None and lat["count"]:
        print(f"latency ms: min={lat.latency_min} mean={lat.latency_mean} max={lat.latency_max}")
    if a.out:
        res["rows"].write.mode("overwrite").option("header", True).csv(a.out)
        print(f"rows written to {a.out}")
    if a.rows:
        res["rows"].show(a.rows, truncate=False)
    if res["missing_columns"]:
        cols = ", ".join(f"{c} {'TIMESTAMP_NTZ' if c == 'bar_ts' else 'STRING'}" for c in res["missing_columns"])
        print(f"older layout: ALTER TABLE {a.table} ADD COLUMNS ({cols})")
    return 0


def cmd_expectations(spark, a) -> int:
    from .operators.expectations import full_report
    from .plans.report import stored_report
    of = _sinks(a) if a.csv and a.parquet else a.table
    rows = full_report(spark, of, data_rules=stored_report(spark, of, a.report_dir) if a.report_dir else None).collect()
    for r in rows:
        print(f"{r.rule:7s} checked={r.checked} violations={r.violations}")
    return 1 if a.strict and any(r.violations for r in rows) else 0


def cmd_live(spark, a) -> int:
    from .streaming.run import start_live, start_quarantine
    start_quarantine(spark, a.landing, f"{a.checkpoint}/quarantine", f"{a.checkpoint}/quarantine-stream", a.format)
    q = start_live(spark, a.landing, a.table, a.csv, a.parquet, a.checkpoint, _params(a), every=a.every, poll_minutes=a.interval,
                   table_location=a.table_location, late_dir=a.late, idle_s=a.idle, fmt=a.table_format, close_s=a.close, landing_format=a.format)
    q.awaitTermination()
    return 0


def build_parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="python -m tickframe")
    sub = ap.add_subparsers(dest="cmd", required=True)

    def common(sp):
        _add_params(sp)
        sp.add_argument("--table-location")
        sp.add_argument("--table-format", default="parquet", help="parquet, or delta where its jars are present")

    t = sub.add_parser("ticks", help="poll log -> tick table, CSV and Parquet")
    t.add_argument("--polls")
    t.add_argument("--snaps")
    t.add_argument("--poll-events")
    t.add_argument("--format", default="parquet")
    t.add_argument("--symbol", help="the log holds one symbol and its files have no symbol column")
    for k in ("--table", "--csv", "--parquet"):
        t.add_argument(k, required=True)
    t.add_argument("--session-date", help="only this session, or from it on with --to")
    t.add_argument("--to", help="last session of a range")
    common(t)
    v = sub.add_parser("verify", help="one day's summary from the tick table")
    v.add_argument("--table", required=True)
    v.add_argument("--date", required=True)
    v.add_argument("--rows", type=int, default=0, help="show so many rows of the day")
    v.add_argument("--out", help="write the day's rows as CSV")
    e = sub.add_parser("expectations", help="table expectations report")
    e.add_argument("--table", required=True)
    e.add_argument("--strict", action="store_true", help="exit 1 on any violation")
    e.add_argument("--csv", help="with --parquet: compare the three sinks too (EXP-10)")
    e.add_argument("--parquet")
    e.add_argument("--report-dir", help="keep the report there and read only what changed since the last one")
    e.set_defaults(table_location=None, table_format="parquet")
    m = sub.add_parser("maintain", help="compact finished sessions, delete what no reader sees")
    for k in ("--table", "--csv", "--parquet"):
        m.add_argument(k, required=True)
    m.add_argument("--compact-before", help="session label yyyy_MM_dd")
    m.add_argument("--vacuum-hours", type=float, help="age from which unseen folders go")
    m.set_defaults(table_location=None, table_format="parquet")
    lv = sub.add_parser("live", help="stream a landing folder to the three sinks")
    for k in ("--landing", "--table", "--csv", "--parquet", "--checkpoint"):
        lv.add_argument(k, required=True)
    lv.add_argument("--every", help="trigger interval; by default flush-every polls")
    lv.add_argument("--interval", type=int, default=1, help="minutes between polls")
    lv.add_argument("--late", help="folder for late rows, by default beside the checkpoint")
    lv.add_argument("--format", default="parquet", choices=["parquet", "json", "csv"], help="format of the landing files")
    lv.add_argument("--close", type=int, default=6 * 3600, help="drop a session's state after so many seconds without data")
    lv.add_argument("--idle", type=int, default=600, help="fold waiting polls after so many seconds without data")
    common(lv)
    for sp in sub.choices.values():
        sp.add_argument("--checkpoint-dir", help="shared folder for work files, where the cluster names none")
    return ap


def main(argv=None, spark=None) -> int:
    a = build_parser().parse_args(argv)
    if a.cmd == "ticks" and not a.poll_events and not (a.polls and a.snaps):
        raise SystemExit("ticks needs --poll-events, or --polls and --snaps")
    if spark is None:
        from .session import get_spark
        spark = get_spark(checkpoint_dir=a.checkpoint_dir)
    return {"ticks": cmd_ticks, "verify": cmd_verify, "expectations": cmd_expectations, "maintain": cmd_maintain,
            "live": cmd_live}[a.cmd](spark, a)


if __name__ == "__main__":
    sys.exit(main())

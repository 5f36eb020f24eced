"""Table DDL, evolution, appends and file round trips (SNK-*, DDL-*, SRC-*, EXP-9/10)."""

import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF001
from tickframe.operators.expectations import schema_report, sinks_agree
from tickframe.plans.ticks import fixture_ticks
from tickframe.plans.verify import adaptive_select, day_check, day_filter
from tickframe.schema import INT_COLUMNS, LEGACY_MISSING, LEGACY_TICK_SCHEMA, TICK_COLUMNS, TICK_SCHEMA, conform
from tickframe.session import fresh_dir
from tickframe.sinks import files
from tickframe.sinks import fanout
from tickframe.sinks.fanout import fan_out
from tickframe.sinks.ledger import Ledger
from tickframe.sinks.tables import (append_ticks, create_tick_table, evolve, live_columns, schema_diff)

# The one stored example row. Its symbol is replaced by a neutral index name; no other column depends on it.
GOLDEN_ROW = ("2026-04-03 09:35:31.927661,2026-04-02 15:28:00,09:35,15:28,^IDX,2026,4,2,3,15,28,1,22704.9,22705.4,"
              "22696.0,22700.15,0.0,22700.52,22700.52,9.4,-0.0209,0.0,50.53,0.5,4.15,1.000414,6,0,0,5,OK_NO_VOL,560.5")


@pytest.fixture(scope="module")
def ticks(spark):
    return fixture_ticks(spark, SF001, bar_minutes=360).cache()


def _name(p):
    return f"default.{p}_{uuid.uuid4().hex[:8]}"


def test_create_and_columns(spark):
    name = _name("t")
    create_tick_table(spark, name, fresh_dir(spark, "t"))
    create_tick_table(spark, name, fresh_dir(spark, "t"))  # IF NOT EXISTS
    cols = live_columns(spark, name)
    assert sorted(cols) == sorted(TICK_COLUMNS) and len(cols) == len(set(cols))
    parts = [r.col_name for r in spark.sql(f"DESCRIBE TABLE {name}").collect()]
    assert len(parts) > len(cols)  # DESCRIBE repeats partition columns (why we do not use it)


def test_append_keeps_duplicates_and_types(spark, ticks):
    name = _name("app")
    loc = fresh_dir(spark, "app")
    append_ticks(spark, ticks, name, location=loc)
    append_ticks(spark, ticks, name, create=False)
    t = spark.table(name)
    assert t.count() == 2 * ticks.count()
    types = {f.name: f.dataType for f in t.schema.fields}
    assert all(isinstance(types[c], T.IntegerType) for c in INT_COLUMNS)
    assert os.path.isdir(loc) and any("year=" in d for d in os.listdir(loc))


def test_conform_casts_longs(spark, ticks):
    wide = ticks.select(*[F.col(c).cast("long").alias(c) if c in INT_COLUMNS else c for c in TICK_COLUMNS])
    out = conform(wide)
    assert [(f.name, f.dataType) for f in out.schema.fields] == [(f.name, f.dataType) for f in TICK_SCHEMA.fields]


def test_schema_evolution(spark, ticks):
    name = _name("evo")
    old = ticks.drop(*LEGACY_MISSING)
    append_ticks(spark, old, name, location=fresh_dir(spark, "evo"))
    assert set(LEGACY_MISSING).isdisjoint(live_columns(spark, name))
    diff = schema_diff(spark.table(name).schema, ticks.schema)
    assert {r[0] for r in diff if not r[1]} == set(LEGACY_MISSING)
    added = evolve(spark, name, ticks.schema)
    assert added == LEGACY_MISSING
    append_ticks(spark, ticks, name, create=False)
    t = spark.table(name)
    n = ticks.count()
    assert t.count() == 2 * n
    assert t.where(F.col("bar_ts").isNull()).count() == n
    # Day check adapts to both layouts.
    assert adaptive_select(old).columns[0] == "tick_ts" and "bar_ts" not in adaptive_select(old).columns
    assert adaptive_select(t).columns[:2] == ["tick_ts", "bar_ts"]


def test_day_filter_prunes_partitions(spark, ticks):
    name = _name("day")
    append_ticks(spark, ticks, name, location=fresh_dir(spark, "day"))
    r = ticks.select("year", "month", "date").first()
    q = day_filter(spark.table(name), r.year, r.month, r.date)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "year" in plan.split("PartitionFilters")[1][:300]
    res = day_check(spark, name, r.year, r.month, r.date)
    assert res["count"].first().n_ticks == ticks.where(
        (F.col("year") == r.year) & (F.col("month") == r.month) & (F.col("date") == r.date)).count()
    assert res["missing_columns"] == []


def test_csv_roundtrip_header_per_file(spark, ticks):
    path = fresh_dir(spark, "csv")
    assert files.write_csv(ticks, path, write_id="flush-1")
    assert not files.write_csv(ticks, path, write_id="flush-1")  # the same write again changes nothing
    assert files.read_csv(spark, path).count() == ticks.count()
    files.write_csv(ticks, path, write_id="flush-2")  # another write: a second set of part files, each with its header
    back = files.strip_keys(files.read_csv(spark, path))
    assert back.count() == 2 * ticks.count()
    assert back.exceptAll(ticks.unionByName(ticks)).count() == 0
    parts = glob.glob(f"{path}/session=*/attempt=*/*.csv")
    assert parts and all(open(p).readline().startswith("tick_ts,bar_ts,") for p in parts)


def test_parquet_roundtrip_merge_schema(spark, ticks):
    path = fresh_dir(spark, "pq")
    files.write_parquet(ticks.drop(*LEGACY_MISSING), path)
    files.write_parquet(ticks, path)
    back = files.read_parquet(spark, path)
    assert set(LEGACY_MISSING) <= set(back.columns)
    assert back.where(F.col("bar_ts").isNull()).count() == ticks.count()


def test_fan_out_and_sinks_agree(spark, ticks):
    base = fresh_dir(spark, "fan")
    name = _name("fan")
    fan_out(spark, ticks, name, f"{base}/csv", f"{base}/pq", table_location=f"{base}/table")
    rep = {r.sink: r for r in sinks_agree(ticks, {
        "table": spark.table(name).select(*TICK_COLUMNS),
        "csv": files.strip_keys(files.read_csv(spark, f"{base}/csv")),
        "parquet": files.strip_keys(files.read_parquet(spark, f"{base}/pq"))}).collect()}
    n = ticks.count()
    assert all(r.rows == n and r.missing == 0 and r.extra == 0 for r in rep.values())
    short = sinks_agree(ticks, {"x": ticks.limit(n - 1)}).first()
    assert short.missing == 1 and short.extra == 0


def _sinks(base, name):
    return fanout.Sinks(name, f"{base}/csv", f"{base}/pq", f"{base}/table")


def _counts(spark, sinks):
    spark.catalog.refreshTable(sinks.table)
    return [df.count() for df in sinks.read(spark).values()]


def test_append_reads_only_the_days_of_the_batch(spark, ticks):
    from tickframe.sinks.tables import days_of, new_rows
    name = _name("prune")
    append_ticks(spark, ticks, name, location=fresh_dir(spark, "prune"))
    day = ticks.where(F.col("date") == ticks.agg(F.min("date")).first()[0]).cache()
    assert days_of(day)._jc.toString().count("year") == day.select("year", "month", "date").distinct().count()
    join = new_rows(day, spark.table(name).where(days_of(day)))
    read = {f.split("/year=")[1].rsplit("/", 1)[0] for f in join.inputFiles() if "/year=" in f}
    assert read == {f"{r.year}/month={r.month}/date={r.date}" for r in day.collect()}  # the table's other folders are not read
    assert len(spark.table(name).inputFiles()) > len(read) and join.count() == 0
    append_ticks(spark, ticks, name, create=False, new_only=True)
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == ticks.count()


def test_corrected_rerun_replaces_in_all_sinks(spark, ticks):
    ticks = ticks.where("date <= 5").cache()
    base, name = fresh_dir(spark, "fix"), _name("fix")
    sinks = _sinks(base, name)
    fan_out(spark, ticks, name, sinks.csv_dir, sinks.parquet_dir, table_location=sinks.table_location)
    fixed = ticks.withColumn("close", F.col("close") + 1)
    fanout.replace_sessions(spark, fixed, sinks)
    spark.catalog.refreshTable(name)
    rep = sinks_agree(fixed, sinks.read(spark)).collect()
    assert all(r.missing == r.extra == 0 and r.rows == ticks.count() for r in rep)
    # A session without any tick now: named in ``covers``, its rows go.
    one = ticks.select("symbol", F.date_format("tick_ts", "yyyy_MM_dd").alias("session")).limit(1).cache()
    fanout.replace_sessions(spark, fixed.limit(0), sinks, covers=one)
    gone = fixed.join(one, [F.date_format("tick_ts", "yyyy_MM_dd") == one.session, fixed.symbol == one.symbol], "left_semi").count()
    assert gone > 0 and _counts(spark, sinks) == [ticks.count() - gone] * 3


def test_a_writer_that_was_overtaken_starts_over(spark, ticks, monkeypatch):
    ticks = ticks.where("date <= 5").cache()
    base, name = fresh_dir(spark, "race"), _name("race")
    sinks = _sinks(base, name)
    whole, done = Ledger.commit, []

    def commit(self, number, *a, **kw):
        if not done:  # another writer of the same ticks is first
            done.append(1)
            fan_out(spark, ticks, name, sinks.csv_dir, sinks.parquet_dir, table_location=sinks.table_location, write_id="first")
        return whole(self, number, *a, **kw)
    monkeypatch.setattr(Ledger, "commit", commit)
    assert fan_out(spark, ticks, name, sinks.csv_dir, sinks.parquet_dir, table_location=sinks.table_location, write_id="second")
    assert _counts(spark, sinks) == [ticks.count()] * 3


def test_compact_and_vacuum(spark, ticks):
    ticks = ticks.where("date <= 5").cache()
    base, name = fresh_dir(spark, "small"), _name("small")
    sinks = _sinks(base, name)
    for k in range(3):
        part = ticks.where(F.pmod(F.xxhash64("symbol", "tick_ts"), F.lit(3)) == k)
        fan_out(spark, part, name, sinks.csv_dir, sinks.parquet_dir, table_location=sinks.table_location, write_id=f"w{k}")
    fan_out(spark, ticks.withColumn("tick_ts", F.expr("tick_ts + interval 1 second")), name, sinks.csv_dir, sinks.parquet_dir,
            table_location=sinks.table_location, write_id="more")
    before = files.strip_keys(files.read_parquet(spark, sinks.parquet_dir)).cache()
    n = before.count()
    assert fanout.compact(spark, sinks, "9999_12_31") and not fanout.compact(spark, sinks, "9999_12_31")
    assert _counts(spark, sinks) == [n] * 3
    assert before.exceptAll(files.strip_keys(files.read_parquet(spark, sinks.parquet_dir))).isEmpty()
    assert fanout.vacuum(spark, sinks) == 0  # too young
    assert fanout.vacuum(spark, sinks, older_than_s=-60) > 0
    assert _counts(spark, sinks) == [n] * 3
    days = before.select(F.to_date("tick_ts")).distinct().count()
    for folder in ("csv", "pq"):
        assert len(glob.glob(f"{base}/{folder}/session=*/attempt=*/part-*")) == days  # one file a session day


def test_schema_report():
    assert all(ok for _, ok in schema_report(TICK_SCHEMA))
    bad = dict(schema_report(LEGACY_TICK_SCHEMA))
    assert bad["present:bar_ts"] is False and bad["int:year"] is True


def test_bucketed_poll_events_need_no_exchange(spark):
    from tickframe.plans.ticks import event_ticks
    from tickframe.sources.fixtures import fixture_poll_events
    from tickframe.sources.polls import save_poll_events_bucketed
    name = _name("pe")
    ev = fixture_poll_events(spark, SF001, bar_minutes=360)
    save_poll_events_bucketed(ev, name, 4, fresh_dir(spark, "pe"))
    t = event_ticks(spark.table(name), clustered=True)
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" in plan
    exp = event_ticks(ev)
    assert t.count() == exp.count() and t.exceptAll(exp).count() == 0


def test_sinks_agree_finds_changed_and_duplicated_rows(spark, ticks):
    n = ticks.count()
    changed = ticks.withColumn("close", F.when(F.col("tick_time_str") == F.lit(
        ticks.first().tick_time_str), F.col("close") + 1).otherwise(F.col("close")))
    k = ticks.where(F.col("tick_time_str") == ticks.first().tick_time_str).count()
    r = sinks_agree(ticks, {"chg": changed, "dup": ticks.unionByName(ticks.limit(1))}).collect()
    rep = {x.sink: x for x in r}
    assert rep["chg"].rows == n and rep["chg"].missing == k and rep["chg"].extra == k
    assert rep["dup"].rows == n + 1 and rep["dup"].missing == 0 and rep["dup"].extra == 1


def test_schema_diff_frame(spark, ticks):
    from tickframe.sinks.tables import schema_diff_df
    d = {r.column: r for r in schema_diff_df(spark, LEGACY_TICK_SCHEMA, TICK_SCHEMA).collect()}
    assert not d["bar_ts"].in_table and d["bar_ts"].in_frame and d["bar_ts"].type_frame == "timestamp_ntz"
    assert d["year"].in_table and d["year"].type_table == "int"


def test_ticks_from_rows_golden_strings(spark):
    from tickframe.sources.polls import ticks_from_rows
    row = dict(zip(TICK_COLUMNS, GOLDEN_ROW.split(",")))
    r = ticks_from_rows(spark, [row]).first()
    assert r.bar_ts.isoformat() == "2026-04-02T15:28:00" and r.tick_ts.microsecond == 927661
    assert r.close == 22700.15 and r.days_to_expiry == 5 and r.data_quality == "OK_NO_VOL"
    # EXP-12: the row was polled on 2026-04-03, its bar is of 2026-04-02.
    from tickframe.operators.expectations import violations
    v = violations(ticks_from_rows(spark, [row]).withColumn("session_date", F.to_date("tick_ts")),
                   session_col="session_date").first()
    assert v.v_EXP_12 and not v.v_EXP_1 and not v.v_EXP_3 and not v.v_EXP_4 and not v.v_EXP_6


def test_read_poll_log_formats(spark):
    from tickframe.sources.fixtures import fixture_poll_log
    from tickframe.sources.polls import read_poll_log
    polls, snaps = fixture_poll_log(spark, SF001, bar_minutes=360)
    base = fresh_dir(spark, "pl")
    for fmt in ("parquet", "json"):
        polls.write.format(fmt).save(f"{base}/{fmt}/polls")
        snaps.write.format(fmt).save(f"{base}/{fmt}/snaps")
        p, s = read_poll_log(spark, f"{base}/{fmt}/polls", f"{base}/{fmt}/snaps", fmt)
        assert p.count() == polls.count() and s.exceptAll(snaps).count() == 0


def test_read_plain_daily_csv(spark):
    """SRC-3: a collector-style daily CSV (header + rows, no folder keys) reads with the tick schema."""
    path = fresh_dir(spark, "daily")
    os.makedirs(path, exist_ok=True)
    header = ",".join(TICK_COLUMNS)
    with open(f"{path}/IDX_2026_04_03.csv", "w") as f:
        f.write(header + "\n" + GOLDEN_ROW + "\n")
    r = files.strip_keys(files.read_csv(spark, path)).first()
    assert r.tick_ts.isoformat() == "2026-04-03T09:35:31.927661" and r.bar_ts.isoformat() == "2026-04-02T15:28:00"
    assert r.hl_ratio == 1.000414 and r.year == 2026 and r.data_quality == "OK_NO_VOL"


def test_single_symbol_log_without_symbol_column(spark):
    from tickframe.sources.fixtures import fixture_poll_log
    from tickframe.sources.polls import read_poll_log
    polls, snaps = fixture_poll_log(spark, SF001, bar_minutes=360)
    one = polls.where("symbol = 'click'").drop("symbol")
    base = fresh_dir(spark, "single")
    one.write.parquet(f"{base}/polls")
    snaps.where("symbol = 'click'").drop("symbol").write.parquet(f"{base}/snaps")
    p, s = read_poll_log(spark, f"{base}/polls", f"{base}/snaps", symbol="^IDX")
    assert p.columns[0] == "symbol" and p.select("symbol").distinct().collect()[0][0] == "^IDX"
    assert s.count() == snaps.where("symbol = 'click'").count()


def test_digest_tells_shifted_nulls_apart(spark, ticks):
    """A NULL that moves to another column is a difference."""
    old = ticks.select("*").withColumn("vwap", F.lit(None).cast("double"))
    moved = ticks.withColumn("vwap", F.col("typical_price")).withColumn("typical_price", F.lit(None).cast("double"))
    r = sinks_agree(old, {"moved": moved}).first()
    assert r.missing == r.extra == ticks.count()


def test_expectations_on_clean_and_old_layouts(spark, ticks):
    """No false violation without a session column, nor on rows of the older layout; what can't be told isn't counted."""
    from tickframe.operators.expectations import expectation_report
    n = ticks.count()
    for frame in (ticks, ticks.drop(*LEGACY_MISSING)):
        rep = {r.rule: (r.checked, r.violations) for r in expectation_report(frame).collect()}
        assert {k for k, (_, v) in rep.items() if v} <= {"EXP-11", "EXP-12"}
        assert rep["EXP-3"] == (n, 0) and rep["EXP-5"] == (n, 0)
    late = ticks.withColumn("tick_ts", F.expr("tick_ts + interval 1 day"))
    rep = {r.rule: r.violations for r in expectation_report(late).collect()}
    assert rep["EXP-12"] >= n - {r.rule: r.violations for r in expectation_report(ticks).collect()}["EXP-12"]


def test_session_run_twice_gives_one_table(spark):
    from tickframe.__main__ import main
    from tickframe.sources.fixtures import fixture_poll_events
    from tickframe.streaming.run import land_poll_log
    base = fresh_dir(spark, "day")
    land_poll_log(spark, fixture_poll_events(spark, SF001), None, f"{base}/pe", ended=False)
    days = [r[0] for r in spark.read.parquet(f"{base}/pe").select("session_date").distinct().orderBy("session_date").limit(2).collect()]
    table = _name("day")
    args = ["ticks", "--poll-events", f"{base}/pe", "--table", table, "--csv", f"{base}/csv", "--parquet", f"{base}/pq",
            "--table-location", f"{base}/t", "--spike-pct", "0.1", "--flush-every", "5"]
    for day in (days[0], days[0], days[1]):
        assert main([*args, "--session-date", day.isoformat()], spark=spark) == 0
    spark.catalog.refreshTable(table)
    t = spark.table(table)
    assert t.count() == t.select("symbol", "tick_ts").distinct().count() == files.read_parquet(spark, f"{base}/pq").count() > 0
    assert t.select(F.to_date("tick_ts")).distinct().count() <= 2


def test_no_shared_folder_on_a_cluster_is_an_error():
    from tickframe.session import is_local
    assert is_local("local") and is_local("local[4]") and not is_local("local-cluster[2,1,1024]") and not is_local("spark://h:7077")

    class Context:
        applicationId, master = "app-without-folder", "spark://h:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()
    from tickframe.session import shared_dir
    with pytest.raises(ValueError, match="shared folder"):
        shared_dir(Session())

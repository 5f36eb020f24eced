"""Stored expectations: a repeated report reads only what changed since the last one.

Every report is kept under its folder as three small tables: a mark for each day folder of the tick table, the days that hold rows of each
unit (the day a tick was collected), and each unit's counts by rule. The next report compares the marks, reads the units met in
changed days again, and takes the other units' counts as they are. No rule looks beyond a unit, so the sum equals the whole report.

A mark is made of the names, sizes and times of a day's files (no data is read for it), and for a published table of the sessions that the
ledger shows of each attempt, so replaced and compacted sessions count as changed. Marks, units and counts grow with
days, not rows. Other parameters mean a report from scratch; so does an empty folder.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.expectations import RULES, session_report, unit_of
from ..params import DEFAULT, Params
from ..schema import PARTITION_COLUMNS
from ..session import file_system, materialised
from ..sinks.ledger import create_file, read_file
from ..sinks.tables import days_of, rows_table

_MARKS = "year int, month int, date int, mark decimal(38,0)"
_HOMES = "unit string, year int, month int, date int"
_COUNTS = "unit string, rule string, checked long, violations long"


def day_marks(spark: SparkSession, of) -> DataFrame:
    """(year, month, date, mark) of a plain table (its name) or of the three sinks' table (``sinks.fanout.Sinks``)."""
    facts = [F.col(f"_metadata.{c}").alias(c) for c in ("file_path", "file_size", "file_modification_time")]
    names = ["file_path", "file_size", "file_modification_time"]
    if isinstance(of, str):
        spark.catalog.refreshTable(of)
        found = spark.table(of).select(*PARTITION_COLUMNS, *facts).distinct()
    else:
        spark.catalog.refreshTable(rows_table(of.table))
        found = spark.table(rows_table(of.table)).select(*PARTITION_COLUMNS, "attempt", *facts).distinct()
        seen = of.ledger(spark).visible().groupBy("attempt").agg(F.sum(F.xxhash64("symbol", "session").cast("decimal(38,0)")).alias("seen"))
        found = found.join(seen, "attempt")
        names = [*names, "seen"]
    return found.groupBy(*PARTITION_COLUMNS).agg(F.sum(F.xxhash64(*names).cast("decimal(38,0)")).cast("decimal(38,0)").alias("mark"))


def _last(spark: SparkSession, folder: str) -> tuple[int, dict]:
    """Number and content of the newest report's note; (-1, {}) before any."""
    fs, at = file_system(spark, f"{folder}/reports")
    if not fs.exists(at):
        fs.mkdirs(at)
    newest = max((int(n.split(".")[0]) for n in (f.getPath().getName() for f in fs.listStatus(at)) if n[0].isdigit()), default=-1)
    return newest, json.loads(read_file(spark, f"{folder}/reports/{newest:012d}.json")) if newest >= 0 else {}


def changed_rows(rows: DataFrame, marks: DataFrame, was: DataFrame, homes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(units to look at again, their rows): units met, now or before, in days whose mark changed. Only the days that hold rows of
    such units are read."""
    days = marks.exceptAll(was).union(was.exceptAll(marks)).select(*PARTITION_COLUMNS).distinct()
    days = materialised(days, "report-days")
    here = days_of(days)
    units = rows.where(here).select(unit_of().alias("unit")).union(homes.where(here).select("unit")).distinct()
    units = materialised(units, "report-units")
    reach = days.union(homes.join(units, "unit", "left_semi").select(*PARTITION_COLUMNS))
    again = rows.where(days_of(reach)).withColumn("unit", unit_of()).join(units, "unit", "left_semi")
    return units, again


def stored_report(spark: SparkSession, of, folder: str, p: Params = DEFAULT) -> DataFrame:
    """``(rule, checked, violations)`` of the data rules, as ``expectation_report`` gives them for the whole table."""
    folder = folder.rstrip("/")
    name = of if isinstance(of, str) else of.table
    setup = {"table": name, **{k: str(v) for k, v in asdict(p).items()}}
    while True:
        number, note = _last(spark, folder)
        marks, rows = materialised(day_marks(spark, of), "report-marks"), spark.table(name)
        state = f"{folder}/state-{uuid.uuid4().hex[:12]}"
        if note.get("setup") == setup:
            was, homes, counts = (spark.read.schema(s).parquet(f"{note['state']}/{t}") for t, s in (("marks", _MARKS), ("homes", _HOMES), ("counts", _COUNTS)))
            units, again = changed_rows(rows, marks, was, homes)
            kept_homes, kept = (t.join(units, "unit", "left_anti") for t in (homes, counts))
        else:
            again, kept_homes, kept = rows.withColumn("unit", unit_of()), None, None
        new_homes, new = again.select("unit", *PARTITION_COLUMNS).distinct(), session_report(again.drop("unit"), p)
        for table, df in (("marks", marks), ("homes", new_homes if kept_homes is None else kept_homes.unionByName(new_homes)),
                          ("counts", new if kept is None else kept.unionByName(new))):
            df.write.parquet(f"{state}/{table}")
        if create_file(spark, f"{folder}/reports/{number + 1:012d}.json", json.dumps({"state": state, "setup": setup})):
            break
    zero = spark.createDataFrame([(r, 0, 0) for r in RULES], "rule string, checked long, violations long")
    out = zero.unionByName(spark.read.schema(_COUNTS).parquet(f"{state}/counts").drop("unit"))
    return out.groupBy("rule").agg(F.sum("checked").alias("checked"), F.sum("violations").alias("violations"))

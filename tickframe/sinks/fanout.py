"""One batch of ticks to all three sinks (table, CSV, Parquet), published in one step.

The rows are written to the three sinks as one attempt, then one commit of the shared ledger (``sinks/ledger.py``) makes them visible in all
three. A failure after any step leaves every reader with the old state or every reader with the new one; the same write
may be repeated at any time.

* ``fan_out`` adds the ticks that the sinks do not hold yet (by symbol and collection time, looked up in the batch's session folders only).
* ``replace_sessions`` publishes whole sessions anew: a corrected rerun, or a restatement with late polls.
* ``compact`` rewrites finished sessions from many attempts into one, ``vacuum`` deletes what no reader can see any more.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import file_system, materialised
from . import files, tables
from .ledger import Ledger

# Session labels of a batch that become literals one by one.
MOST_SESSIONS = 400


@dataclass(frozen=True)
class Sinks:
    """The three sinks of one tick table and where their ledger lies (beside the Parquet files by default)."""
    table: str
    csv_dir: str
    parquet_dir: str
    table_location: str | None = None
    fmt: str = "parquet"
    ledger_dir: str | None = None

    def ledger(self, spark: SparkSession) -> Ledger:
        own = Ledger.start(spark, self.parquet_dir, self.ledger_dir)
        return Ledger.start(spark, self.csv_dir, own.root)

    def read(self, spark: SparkSession) -> dict[str, DataFrame]:
        """What readers of each sink see, in the tick layout."""
        return {"table": files.strip_keys(spark.table(self.table)), "csv": files.strip_keys(files.read_csv(spark, self.csv_dir)),
                "parquet": files.strip_keys(files.read_parquet(spark, self.parquet_dir))}


def _in_sessions(keyed: DataFrame) -> Column:
    """A literal condition on ``session`` that prunes a dataset to the folders of these rows."""
    labels = [r[0] for r in keyed.select("session").distinct().collect()]
    known = sorted(x for x in labels if x is not None)
    if len(known) > MOST_SESSIONS:
        found = F.col("session").between(known[0], known[-1])
    else:
        found = F.col("session").isin(known) if known else F.lit(False)
    return found | F.col("session").isNull() if None in labels else found


def _stage(spark: SparkSession, rows: DataFrame, sinks: Sinks, ledger: Ledger, attempt: str) -> None:
    """An attempt's rows in all three sinks; no reader sees them yet."""
    files.add_csv(rows, sinks.csv_dir, attempt)
    files.add_parquet(rows, sinks.parquet_dir, attempt)
    tables.add_to_published(spark, rows, sinks.table, ledger, attempt, sinks.table_location, sinks.fmt)


def _publish(spark: SparkSession, keyed: DataFrame, sinks: Sinks, write_id: str, replace: bool, covers: DataFrame | None = None) -> bool:
    """Stage and publish; starts over on the new state when another write was published meanwhile."""
    ledger = sinks.ledger(spark)
    while not ledger.committed(write_id):
        as_of, attempt, rows = ledger.last(), ledger.new_attempt(write_id), keyed
        if not replace:
            here = _in_sessions(keyed)
            if not ledger.visible(as_of).where(here).isEmpty():
                held = files.read_parquet(spark, sinks.parquet_dir, upto=as_of).where(here)
                rows = materialised(tables.new_rows(keyed, held), "fan-out-new")
        _stage(spark, rows, sinks, ledger, attempt)
        ledger.stage_sessions(attempt, rows if covers is None else rows.select("symbol", "session").unionByName(covers.select("symbol", "session")))
        if ledger.commit(as_of + 1, write_id, attempt, as_of if replace else -1):
            return True
    return False


def fan_out(spark: SparkSession, df: DataFrame, table: str, csv_dir: str, parquet_dir: str,
            session_col: str | None = None, table_location: str | None = None, fmt: str = "parquet", write_id: str | None = None) -> bool:
    """Add the ticks of ``df`` that the sinks lack to the table and both file datasets (one computation, kept in the shared folder).

    False if ``write_id`` was published before."""
    keyed = materialised(files.with_file_keys(df, session_col), "fan-out")
    return _publish(spark, keyed, Sinks(table, csv_dir, parquet_dir, table_location, fmt), write_id or uuid.uuid4().hex, False)


def replace_sessions(spark: SparkSession, df: DataFrame, sinks: Sinks, session_col: str | None = None, write_id: str | None = None,
                     covers: DataFrame | None = None) -> bool:
    """Publish whole sessions anew in all three sinks: the rows of ``df`` in place of what their (symbol, session) pairs held.

    ``covers`` (symbol, session label) names further sessions whose rows go, such as those without any tick now."""
    keyed = materialised(files.with_file_keys(df, session_col), "fan-out")
    return _publish(spark, keyed, sinks, write_id or uuid.uuid4().hex, True, covers)


def batch_writer(table: str, csv_dir: str, parquet_dir: str, session_col: str | None = None, table_location: str | None = None,
                 fmt: str = "parquet", late_dir: str | None = None, ticks=lambda states: states, late: Column | None = None):
    """A ``foreachBatch`` function writing each micro-batch to the three sinks, once per streaming query and batch id.

    ``ticks`` makes tick rows of a micro-batch; rows where ``late`` holds go to ``late_dir``.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        cached = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if late_dir and late is not None:
                cached.where(late).write.mode("overwrite").parquet(f"{late_dir}/batch={batch_id}")
            fan_out(batch.sparkSession, ticks(cached), table, csv_dir, parquet_dir, session_col, table_location, fmt, live_id(batch, batch_id))
        finally:
            cached.unpersist()
    return write


def live_id(batch: DataFrame, batch_id: int) -> str:
    """A micro-batch's write id: the streaming query's id, kept in its checkpoint, and the batch id."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"live-{query or 'query'}-{batch_id:09d}"


def compact(spark: SparkSession, sinks: Sinks, before: str) -> bool:
    """Rewrite the sessions labelled below ``before`` (yyyy_MM_dd) that several attempts hold, as one attempt: the same rows, one
    file a session day and sink (more only beyond the advisory file size). Repeating it changes nothing. False if there is nothing to do."""
    ledger = sinks.ledger(spark)
    as_of = ledger.last()
    seen = ledger.visible(as_of).where(F.col("session") < before)
    days = materialised(seen.groupBy("session").agg(F.countDistinct("attempt").alias("n")).where("n > 1").select("session"), "compact-days")
    if days.isEmpty():
        return False
    here = _in_sessions(days)
    rows = files.read_parquet(spark, sinks.parquet_dir, upto=as_of).where(here).drop("attempt")
    rows = materialised(rows.join(days, "session", "left_semi"), "compact-rows")
    attempt = ledger.new_attempt("compact")
    _stage(spark, rows, sinks, ledger, attempt)
    ledger.stage_sessions(attempt, rows)
    # Another write meanwhile: what was read is out of date; the caller may try again.
    return ledger.commit(as_of + 1, attempt, attempt, as_of)


def vacuum(spark: SparkSession, sinks: Sinks, older_than_s: int = 7 * 86_400) -> int:
    """Delete the folders of attempts that no reader sees (replaced, or never published) and whose files are older; how many went.

    The age protects writers at work and readers that began before a replacement."""
    import time
    ledger = sinks.ledger(spark)
    newest = (time.time() - older_than_s) * 1000
    seen = ledger.visible().select("attempt", "session").distinct()
    gone = 0
    for root in (sinks.csv_dir, sinks.parquet_dir):
        fs, at = file_system(spark, f"{root.rstrip('/')}/session=*/attempt=*")
        old = [(f.getPath().getParent().getName()[8:], f.getPath().getName()[8:], f.getPath().toString()) for f in fs.globStatus(at) or [] if f.getModificationTime() < newest]
        if old:
            found = spark.createDataFrame(old, "session string, attempt string, path string")
            for r in found.join(seen, ["session", "attempt"], "left_anti").toLocalIterator():
                _, folder = file_system(spark, r["path"])
                gone += bool(fs.delete(folder, True))
    behind = tables.rows_table(sinks.table)
    if spark.catalog.tableExists(behind):
        home = spark.sql(f"DESCRIBE FORMATTED {behind}").where("col_name = 'Location'").first()["data_type"]
        parts = spark.sql(f"SHOW PARTITIONS {behind}").withColumn("attempt", F.element_at(F.split("partition", "attempt="), -1))
        for r in parts.join(seen, "attempt", "left_anti").toLocalIterator():
            fs, at = file_system(spark, f"{home}/{r['partition']}")
            if not fs.exists(at) or fs.getFileStatus(at).getModificationTime() < newest:
                spec = ", ".join("{}='{}'".format(*kv.split("=", 1)) for kv in r["partition"].split("/"))
                spark.sql(f"ALTER TABLE {behind} DROP IF EXISTS PARTITION ({spec})")
                fs.delete(at, True)  # a table with a location of its own keeps the files
                gone += 1
    return gone

"""Write ledger: which writes of a set of sinks readers see.

Rows are first written to all sinks under an *attempt* (a folder and a table partition of its own) that no reader looks at. One small file then
publishes the attempt in all of them: ``commits/<number>.json``, created only if it does not exist. A failure before that leaves the old
state, after it the new one. Attempts that were never published stay unseen until ``vacuum``.

* A write has an id; an id that is published is not written again, so a write may be repeated at any time.
* A commit takes the number after the last one it saw. If another writer was first, the write starts over on the new state, so what it
  left out as already held, or replaces, is never out of date.
* A write may *replace* sessions: it hides what was published for its (symbol, session) pairs up to the commit it has read (``as_of``).

``sessions/`` names the (symbol, session) pairs of every attempt, as JSON lines written by Spark. The exclusive create is atomic
on local and HDFS folders; on an object store one writer at a time has to be ensured.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import file_system

_COMMIT = "commit BIGINT, write_id STRING, attempt STRING, as_of BIGINT"
_SESSION = "attempt STRING, symbol STRING, session STRING"
# Where a dataset that shares another one's ledger says so, and the ledger's folder in its own.
_POINTER, _FOLDER = "_ledger_at", "_ledger"


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    @classmethod
    def of(cls, spark: SparkSession, path: str) -> "Ledger | None":
        """The ledger of the dataset at ``path``; None for plain files."""
        path = path.rstrip("/")
        fs, at = file_system(spark, f"{path}/{_POINTER}")
        if fs.exists(at):
            return cls(spark, read_file(spark, f"{path}/{_POINTER}"))
        fs, at = file_system(spark, f"{path}/{_FOLDER}/commits")
        return cls(spark, f"{path}/{_FOLDER}") if fs.exists(at) else None

    @classmethod
    def start(cls, spark: SparkSession, path: str, root: str | None = None) -> "Ledger":
        """The dataset's ledger, made if there is none; ``root``: one that several datasets share."""
        path = path.rstrip("/")
        have = cls.of(spark, path)
        if have is not None:
            if root is not None and have.root != root.rstrip("/"):
                raise ValueError(f"{path} belongs to the ledger {have.root}")
            return have
        led = cls(spark, root or f"{path}/{_FOLDER}")
        for folder in (path, f"{led.root}/commits", f"{led.root}/sessions"):
            fs, at = file_system(spark, folder)
            fs.mkdirs(at)
        if root is not None:
            create_file(spark, f"{path}/{_POINTER}", led.root)
        return led

    def last(self) -> int:
        """Number of the newest commit, -1 before any."""
        fs, at = file_system(self.spark, f"{self.root}/commits")
        return max((int(n.split(".")[0]) for n in (f.getPath().getName() for f in fs.listStatus(at)) if n[0].isdigit()), default=-1)

    def commits(self) -> DataFrame:
        """Published writes, the first of each id."""
        return self.spark.sql(_commits_sql(self.root))

    def committed(self, write_id: str) -> bool:
        return not self.commits().where(F.col("write_id") == write_id).isEmpty()

    def visible(self, upto: int | None = None) -> DataFrame:
        """(attempt, symbol, session) that readers see now, or saw after commit ``upto``."""
        return self.spark.sql(visible_sql(self.root, upto))

    def new_attempt(self, write_id: str) -> str:
        name = "".join(c if c.isalnum() or c in "-_" else "-" for c in write_id)[:60]
        return f"{name}-{uuid.uuid4().hex[:12]}"

    def stage_sessions(self, attempt: str, sessions: DataFrame) -> None:
        """Name the (symbol, session) pairs that an attempt holds or replaces."""
        rows = sessions.select(F.lit(attempt).alias("attempt"), "symbol", "session").distinct()
        rows.write.mode("append").option("ignoreNullFields", False).json(f"{self.root}/sessions")

    def commit(self, number: int, write_id: str, attempt: str, as_of: int = -1) -> bool:
        """Publish an attempt under this number; False if the number is taken."""
        line = json.dumps({"commit": number, "write_id": write_id, "attempt": attempt, "as_of": as_of})
        return create_file(self.spark, f"{self.root}/commits/{number:012d}.json", line)


def read_file(spark: SparkSession, path: str) -> str:
    fs, at = file_system(spark, path)
    stream = fs.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist yet; False if it does."""
    from py4j.protocol import Py4JJavaError
    fs, at = file_system(spark, path)
    try:
        out = fs.create(at, False)
    except Py4JJavaError as e:
        if fs.exists(at):
            return False
        raise e
    out.write(bytearray(text.encode()))
    out.close()
    return True


def _commits_sql(root: str, upto: int | None = None) -> str:
    limit = "" if upto is None else f" WHERE c.commit <= {upto}"
    return f"""SELECT commit, write_id, attempt, as_of FROM (
  SELECT c.*, row_number() OVER (PARTITION BY c.write_id ORDER BY c.commit) AS nth
  FROM (SELECT from_json(value, '{_COMMIT}') AS c FROM text.`{root}/commits`){limit}) WHERE nth = 1 AND commit IS NOT NULL"""


def visible_sql(root: str, upto: int | None = None) -> str:
    return f"""SELECT attempt, symbol, session FROM (
  SELECT s.s.attempt, s.s.symbol, s.s.session, c.commit, max(c.as_of) OVER (PARTITION BY s.s.symbol, s.s.session) AS gone
  FROM (SELECT from_json(value, '{_SESSION}') AS s FROM text.`{root}/sessions`) s
  JOIN ({_commits_sql(root, upto)}) c ON s.s.attempt = c.attempt) WHERE commit > gone"""


def published(rows: DataFrame, ledger: Ledger, upto: int | None = None) -> DataFrame:
    """The rows (with ``attempt``, ``symbol``, ``session``) that readers see."""
    seen = ledger.visible(upto)
    same = [rows[c].eqNullSafe(seen[c]) for c in ("attempt", "session", "symbol")]
    return rows.join(seen, same, "left_semi")

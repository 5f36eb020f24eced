"""SparkSession helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings the pipeline relies on for correctness (time zone) or plan shape.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tickframe", extra: dict | None = None,
              checkpoint_dir: str | None = None) -> SparkSession:
    """Build (or reuse) a session with the pipeline's settings.

    On a cluster pass ``master=None`` and let the launcher decide; the shuffle
    partition count should then be sized to the data (about 128 MB per task).
    ``checkpoint_dir`` names the shared folder for checkpoints and work files;
    it is a start-time setting, used only when the cluster's defaults name none.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(CORE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    # Static: PySpark's per-Column call-site capture (error context only) costs a
    # JVM round trip per expression; the plans here build hundreds of expressions.
    conf["spark.python.sql.dataFrameDebugging.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if checkpoint_dir and not spark.conf.get("spark.checkpoint.dir", None):
        # The cluster names no shared folder (its defaults are only visible now).
        _FALLBACK_DIRS.setdefault(spark.sparkContext.applicationId, checkpoint_dir)
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(checkpoint_dir)
    return spark


_FALLBACK_DIRS: dict = {}


def is_local(master: str) -> bool:
    """True where driver and executors are one process (``local``, ``local[8]``, but not ``local-cluster``)."""
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared checkpoint directory.

    ``spark.checkpoint.dir`` names the shared folder on a cluster (it can only
    be set when the application starts). Only when it is unset and everything
    runs in one process (a local master, as in tests), a fresh scratch folder
    becomes the context's checkpoint folder; on a cluster that would be a
    different folder on every host, so there it is an error.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = _FALLBACK_DIRS.get(sc.applicationId)
        if base is None:
            base = sc.getCheckpointDir()
            if base is None and not is_local(sc.master):
                raise ValueError("spark.checkpoint.dir names no shared folder: set it when the application starts")
            base = base or tempfile.mkdtemp(prefix="tickframe-ckpt-")
            _FALLBACK_DIRS[sc.applicationId] = base
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    base = base.rstrip("/")
    return "/".join([base, *parts]) if parts else base


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused folder name under the shared directory (never reused, never cleared)."""
    import uuid
    return shared_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def file_system(spark: SparkSession, path: str):
    """(file system, path) of a file or folder name, through Hadoop's API."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tickframe`` importable on executors' Python workers (once per context).

    Code that runs in Python workers (the streaming state function) is pickled
    by reference to this package. The package is zipped into the shared folder
    and added with ``addPyFile``, as ``--py-files`` would do at submit time.
    """
    import hashlib
    import io
    import os
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(dirpath, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    data = buf.getvalue()
    path = shared_dir(spark, "pyfiles", f"tickframe-{hashlib.sha1(data).hexdigest()[:12]}.zip")
    fs, hp = file_system(spark, path)
    if not fs.exists(hp):
        out = fs.create(hp, True)
        out.write(bytearray(data))
        out.close()
    sc.addPyFile(path)
    _SHIPPED.add(key)


def materialised(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: one computation for several uses, no lineage."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

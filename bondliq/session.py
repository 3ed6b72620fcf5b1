"""Session helpers shared by tests, the bench and the entry module."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "bondliq", event_log_dir: str | None = None
) -> SparkSession:
    """A local session with the settings the package is tested under.

    On a cluster the caller builds the session; nothing in the package creates
    or stops one. ``event_log_dir`` (or $BONDLIQ_EVENT_LOG_DIR) turns on Spark's
    event log there, for stage and task times without the web UI
    (``tools/stage_times.py`` reads it).
    """
    event_log_dir = event_log_dir or os.environ.get("BONDLIQ_EVENT_LOG_DIR")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BONDLIQ_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if event_log_dir:
        os.makedirs(event_log_dir, exist_ok=True)
        builder = (
            builder.config("spark.eventLog.enabled", "true")
            .config("spark.eventLog.dir", event_log_dir)
            .config("spark.eventLog.compress", "false")
        )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def let_workers_import(spark: SparkSession) -> None:
    """Python workers find this package where the driver has it. On a cluster whose
    executors have no such path, ship the package with ``--py-files``."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *paths])


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Read from ``spark.checkpoint.dir`` as the cluster names it. Only a local
    session without it (tests) gets a fresh folder; any other master must name
    a folder that all executors share.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no context, checkpoints follow the conf
        sc = None
    current = (sc.getCheckpointDir() if sc else None) or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = sc.master if sc else "connect"
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share (master {master})")
        current = tempfile.mkdtemp(prefix="bondliq-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current.rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """A unique path below the shared folder for a staged table."""
    return f"{shared_dir(spark)}/staged/{name}-{uuid.uuid4().hex[:12]}"


def files(spark: SparkSession, path: str):
    """Hadoop's file system of ``path``, and a maker of its paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def staged(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read back, one folder per
    value of the columns ``by`` (readers that filter on them skip the rest). Unlike a
    checkpoint it is columnar, so each reader reads its columns only, and ``unstage``
    removes it."""
    path = staging_path(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path) if by else df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
    out.staged_path = path
    return out


def unstage(*frames: DataFrame) -> None:
    """Remove staged tables that nothing reads any more."""
    for f in frames:
        fs, make = files(f.sparkSession, f.staged_path)
        fs.delete(make(f.staged_path), True)


def materialize(df):
    """Checkpoint ``df`` into the shared folder (reliable, not local): cuts the
    lineage and fixes nondeterministic splits for every later reader."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)

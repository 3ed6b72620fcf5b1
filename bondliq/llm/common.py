"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bondliq.session import let_workers_import, shared_dir

#: Spark's setting that shuffle files go at the end of the job that made them
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared folder."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: cuts the lineage,
    survives lost executors and fixes what later readers see."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    before = spark.conf.get(DROP_SHUFFLES, None)
    try:  # what has been written needs its shuffle files no more
        spark.conf.set(DROP_SHUFFLES, "true")
        df.write.parquet(path)
    finally:
        spark.conf.set(DROP_SHUFFLES, before) if before is not None else spark.conf.unset(DROP_SHUFFLES)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def let_go(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more, and let Spark's cleaner, which goes
    by what the driver has collected, drop the shuffle files of jobs that are over."""
    jvm = spark.sparkContext._jvm
    for t in tables:
        path = jvm.org.apache.hadoop.fs.Path(t.scratch)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    jvm.System.gc()


def local_path(path: str) -> str | None:
    """``path`` as the operating system names it, or None for a store that only
    Hadoop's or Arrow's file systems read."""
    if path.startswith("file:"):
        return "/" + path[len("file:"):].lstrip("/")
    return path if path.startswith("/") else None


def fold(doc_id: str, n: int):
    """crc32 of the id as text, modulo ``n`` (null ids: null, so in no training fold)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % F.lit(n)

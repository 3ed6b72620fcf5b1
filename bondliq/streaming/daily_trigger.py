"""Run the daily job when a date's files have arrived.

The staging program drops one folder per anchor date, ``<root>_<yyyyMMdd>/``, with the bond
list and the two quote files, in any order and at any time. A Structured Streaming file source
over the folders yields one row per arrived file (names only, contents are not read, so a file
without rows counts like any other), and a streaming aggregation keeps which kinds of file
each date has. A date whose files are all there is run; a file that comes again, or a further
part of one, runs its date again. The dates of one micro-batch are one plan and one commit
(``run_inputs``).

The state store and the source's checkpoint remember what has arrived and what was handled. A run
that fails is not marked as handled, so a restarted trigger takes it up again. A staging program
that writes a file in several parts can name a ``marker`` file that it drops last, such as
``complete_{d}.flag``; then a date also waits for that.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bondliq.plans.daily import run_inputs
from bondliq.sources.paths import BONDS_FILE, EXCHANGE_FILE, OTC_FILE, day_inputs

#: Spark's columns of a file; only the path is asked for
FILES = "path string, modificationTime timestamp, length long, content binary"
DIGITS = r"(\d{8})"


def _pattern(name: str) -> str:
    """The file name, or that of the folder with the file's parts, within a path."""
    return "/" + name.replace(".", r"\.").format(d=DIGITS) + "(/|$)"


def arrived_files(spark: SparkSession, root: str, marker: str | None = None) -> DataFrame:
    """A stream of (anchor, kind), one row per arrived file of a date."""
    kinds = {"bonds": BONDS_FILE, "exchange": EXCHANGE_FILE, "otc": OTC_FILE} | ({"marker": marker} if marker else {})
    stream = spark.readStream.format("binaryFile").schema(FILES).load(f"{root.rstrip('/')}_*/*")
    path = F.col("path")
    kind, anchor = F.lit(None).cast("string"), F.lit(None).cast("string")
    for k, name in kinds.items():
        found = F.regexp_extract(path, _pattern(name), 1)
        kind = F.when(found != "", F.lit(k)).otherwise(kind)
        anchor = F.when(found != "", found).otherwise(anchor)
    return stream.select(anchor.alias("anchor"), kind.alias("kind")).where("kind is not null")


def arrived_dates(spark: SparkSession, root: str, marker: str | None = None) -> DataFrame:
    """A stream of the dates that files have arrived for, with the kinds that they have so far
    (one row of state per date)."""
    return arrived_files(spark, root, marker).groupBy("anchor").agg(F.collect_set("kind").alias("kinds"))


def start(
    spark: SparkSession,
    root: str,
    weights: Mapping[str, float],
    out_root: str,
    checkpoint: str,
    available_now: bool = True,
    marker: str | None = None,
    **options,
):
    """Start the trigger; with ``available_now`` it processes what is there and stops."""
    needed = 4 if marker else 3

    def handle(batch: DataFrame, _epoch: int) -> None:
        # one row per date that changed: a handful of values, not data
        ready = sorted(r["anchor"] for r in batch.where(F.size("kinds") == needed).select("anchor").collect())
        if ready:
            run_inputs(spark, [day_inputs(root, a) for a in ready], weights, out_root, **options)

    writer = (arrived_dates(spark, root, marker).writeStream.outputMode("update").foreachBatch(handle)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 minutes")
    return writer.start()

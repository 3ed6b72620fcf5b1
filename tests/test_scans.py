"""How often the inputs are read and how many rows the joins make, from Spark's event log."""

import os
import subprocess
import sys
import tempfile

import pytest

from tests.conftest import SF001
from tools.plan_rows import node_rows

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
DAYS, SIDE = 12, 300

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import functions as F
from bondliq.operators.pair_median import pair_spread_medians
from bondliq.plans import daily
from bondliq.plans.registry import REGISTRY
from bondliq.session import local_session
from bondliq.sources.paths import day_inputs
from tests import golden

spark = local_session(cores=4, shuffle_partitions=4, event_log_dir=sys.argv[1])
spark.conf.set("spark.sql.maxMetadataStringLength", 1000)

def job(name, run):
    spark.sparkContext.setJobDescription(name)
    out = run()
    if out is not None:
        out.write.format("noop").mode("overwrite").save()

job("exchange", lambda: REGISTRY["exchange_metrics"](spark, {SF001!r}))
job("otc", lambda: REGISTRY["otc_metrics"](spark, {SF001!r}))
job("hot", lambda: REGISTRY["median_by_bond_date_hot"](spark, {SF001!r}))

paths = day_inputs(sys.argv[2] + "/archive", "20200131")
spark.sparkContext.setJobDescription("staging")
for name, df in zip(("bonds", "exchange", "otc"), golden.frames(spark)):
    df.coalesce(1).write.option("header", "true").csv(getattr(paths, name))
spark.sparkContext.setJobDescription("day")
daily.run_day(spark, paths, golden.WEIGHTS, sys.argv[2] + "/out")

# many days, each with as many distinct bids and asks as a task ranks easily
days = spark.range({DAYS} * {SIDE}).select(
    F.lit(1).cast("long").alias("bond"), F.lit(1).cast("long").alias("prov"),
    F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % {DAYS}).cast("int")).alias("date"),
    (F.lit(100.0) + (F.xxhash64("id") % 10_000) / F.lit(977.0)).alias("bid"), (F.lit(101.0) + (F.hash("id") % 10_000) / F.lit(991.0)).alias("ask"))
days.write.parquet(sys.argv[2] + "/days")
days = spark.read.parquet(sys.argv[2] + "/days")
keys = ["bond", "prov", "date"]
spark.sparkContext.setJobDescription("many days")
got = pair_spread_medians(days.select(*keys, "bid"), days.select(*keys, "ask"), "m").collect()
spark.sparkContext.setJobDescription("reference")
spread = (F.col("ask") - F.col("bid")) / ((F.col("ask") + F.col("bid")) / 2)
every = days.select(*keys, "bid").join(days.select(*keys, "ask"), keys).groupBy("date").agg(
    F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY (ask - bid) / ((ask + bid) / 2))").alias("m")).collect()
assert {{r["date"]: r["m"] for r in got}} == {{r["date"]: r["m"] for r in every}} and len(got) == {DAYS}
spark.stop()
"""


@pytest.fixture(scope="module")
def log():
    events, work = tempfile.mkdtemp(prefix="bondliq-events-"), tempfile.mkdtemp(prefix="bondliq-scan-")
    done = subprocess.run([sys.executable, "-c", SCRIPT, events, work], cwd=ROOT, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    return node_rows(events)


def _scanned(log, job, what):
    return [r for r in log if r.job == job and r.node.startswith("Scan") and what in r.detail]


@pytest.mark.parametrize("job", ["exchange", "otc", "hot"])
def test_raw_quotes_are_scanned_once(log, job):
    import pyarrow.parquet as pq

    scans = _scanned(log, job, "lineitem.parquet")
    assert len(scans) == 1 and scans[0].rows <= pq.ParquetFile(f"{SF001}/lineitem.parquet").metadata.num_rows


@pytest.mark.parametrize("name,lines", [("bonds_", 8), ("quotes_2020", 51), ("quotes_mp", 13)])
def test_each_csv_is_parsed_once_in_a_run(log, name, lines):
    scans = _scanned(log, "day", name)
    assert scans and all(s.node.strip() == "Scan text" for s in scans)
    whole = [s for s in scans if s.rows > 1]  # the other one reads the header line
    assert len(whole) == 1 and len(scans) <= 2 and whole[0].rows <= lines + 1


def test_pair_joins_stay_within_a_multiple_of_the_values(log):
    from bondliq.operators.pair_median import LIST_FACTOR

    values = 2 * SIDE * DAYS
    joins = [r.rows for r in log if r.job == "many days" and ("Join" in r.node or "Generate" in r.node)]
    assert joins and max(joins) <= LIST_FACTOR * values
    assert max(r.rows for r in log if r.job == "reference" and "Join" in r.node) > 5 * LIST_FACTOR * values


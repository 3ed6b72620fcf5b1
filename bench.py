"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "liquidity_table_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is built and fully executed into Spark's no-op sink (no rows
collected to the driver); the reported time is the median of
$BENCH_REPEATS runs after one warm-up run of the flagship.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bondliq.plans.registry import REGISTRY, Inputs  # noqa: E402
from bondliq.session import local_session  # noqa: E402
from bondliq.sources import fixtures as fx  # noqa: E402
from tests.single_partition import window_liquidity  # noqa: E402

HEADLINE = [
    "liquidity_table",
    "exchange_metrics",
    "otc_metrics",
    "median_by_bond_date_dense",
    "pos_by_spread",
    "quote_counts",
    "dedupe_by_key",
]


def _window_liquidity(spark, sf):
    """The same table with the single-partition row_number windows (comparison)."""
    i = Inputs(spark, sf)
    return window_liquidity(i.tsq_metrics(), i.otc_metrics(), i.bonds(), fx.WEIGHTS, fx.ANCHOR_DATE)


def _run(spark, fn, sf) -> float:
    t0 = time.perf_counter()
    fn(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * int(cpus) if cpus.isdigit() else 16)))
    spark = local_session(cores=cpus, shuffle_partitions=parts, app="bondliq-bench")
    _run(spark, REGISTRY["liquidity_table"], sf)  # warm-up (JIT, file listing)
    times: dict[str, float] = {}
    # $BENCH_QUERIES: comma-separated registered keys instead of the headline set
    keys = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k] or HEADLINE
    for key in keys:
        times[key] = round(statistics.median(_run(spark, REGISTRY[key], sf) for _ in range(repeats)), 3)
    if keys == HEADLINE:
        times["liquidity_table_single_partition_windows"] = round(
            statistics.median(_run(spark, _window_liquidity, sf) for _ in range(repeats)), 3
        )
    m = re.search(r"sf([0-9.]+)", sf)
    print(json.dumps({
        "metric": "liquidity_table_sec",
        "value": times.get("liquidity_table", round(sum(times.values()), 3)),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf,
        "cpus": cpus,
        "shuffle_partitions": parts,
        "repeats": repeats,
        "spark": spark.version,
    }))


if __name__ == "__main__":
    main()

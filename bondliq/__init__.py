"""bondliq: bond-liquidity metrics as Spark DataFrame jobs.

From exchange quotes, over-the-counter (OTC) quotes and a bond list the package
computes, per bond, the median over days of the per-day median relative
bid-ask spread, the number of quote providers and quoted days, global
positions among all bonds and a weighted geometric-mean liquidity index for an
anchor date.

Layout
  sources/    readers (CSV, JDBC, dated paths, fixture views over test tables)
  functions/  column expressions (dates, spread, merge rules, ranks, index)
  operators/  DataFrame -> DataFrame building blocks (cleaning, pairing,
              exact skew-safe medians, distributed global position, ...)
  plans/      composite jobs (market metrics, liquidity table, daily run)
  sinks/      writers (full refresh, per-date replace, JDBC append, dedupe)
  streaming/  file-triggered daily runs on Structured Streaming
"""

from bondliq.plans.daily import run_day, run_days
from bondliq.plans.liquidity import liquidity_table
from bondliq.plans.metrics import exchange_metrics, otc_metrics, quote_metrics

__all__ = ["exchange_metrics", "liquidity_table", "otc_metrics", "quote_metrics", "run_day", "run_days"]

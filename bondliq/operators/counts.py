"""A3 / A4: distinct providers and distinct quoted days per bond."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def quote_counts(quotes: DataFrame, key: str = "bond", approx_rsd: float | None = None) -> DataFrame:
    """(key, providers_cnt, qdays_cnt) over all quote rows of a bond.

    Exact: both distinct counts in one aggregation. Spark expands each row once
    per distinct column and aggregates (key, value) pairs map-side before the
    first shuffle, then counts per key with another partial aggregation, so a
    hot bond never collects its values in one buffer.

    ``approx_rsd``: HyperLogLog sketches (``approx_count_distinct``) with that
    relative standard deviation instead, with one shuffle of fixed-size
    sketches per bond and map task.
    """
    if approx_rsd is None:
        prov, days = F.count_distinct("prov"), F.count_distinct("date")
    else:
        prov, days = F.approx_count_distinct("prov", approx_rsd), F.approx_count_distinct("date", approx_rsd)
    return quotes.groupBy(key).agg(prov.cast("bigint").alias("providers_cnt"), days.cast("bigint").alias("qdays_cnt"))

"""Merge both markets onto the bond list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondliq.functions.combine import combined_providers, combined_qdays, combined_spread, exchange_indicator
from bondliq.functions.dates import anchor_date_lit, days_between


def coverage_merge(bonds: DataFrame, tsq: DataFrame, otc: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Bonds left-join exchange metrics, left-join OTC metrics, keep bonds
    found in at least one market. ``also``: further columns of the key (the anchor date where
    several run as one plan)."""
    key = [*also, "id"]

    def market(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            *key,
            F.col("id").alias(f"{name}_id"),
            F.col("bid_ask_spread_relative_median").alias(f"{name}_baspread_rel_median"),
            F.col("providers_cnt").alias(f"{name}_providers_cnt"),
            F.col("qdays_cnt").alias(f"{name}_qdays_cnt"),
        )

    b = bonds.select(*key, "isin", "usd_volume", "date_of_end_placing", "maturity_date")
    return (
        b.join(market(tsq, "tsq"), key, "left")
        .join(market(otc, "otc"), key, "left")
        .where(F.col("tsq_id").isNotNull() | F.col("otc_id").isNotNull())
        .drop("otc_id")
    )


def merge_metrics(merged: DataFrame, anchor: str | None, also: Sequence[str] = ()) -> DataFrame:
    """D3, X2-X5, D4 on the coverage merge: of one anchor date, or of the date (yyyyMMdd) that
    the first column of ``also`` names."""
    anchor_date = anchor_date_lit(anchor) if anchor is not None else F.to_date(F.col(also[0]).cast("string"), "yyyyMMdd")
    return merged.select(
        *also,
        "id", "tsq_id", "isin", "usd_volume", "date_of_end_placing", "maturity_date",
        "tsq_baspread_rel_median", "tsq_providers_cnt", "tsq_qdays_cnt",
        "otc_baspread_rel_median", "otc_providers_cnt", "otc_qdays_cnt",
        anchor_date.alias("anchor_date"),
        combined_spread("tsq_baspread_rel_median", "otc_baspread_rel_median").alias("baspread_rel_median"),
        combined_providers("tsq_providers_cnt", "otc_providers_cnt").alias("providers_cnt"),
        combined_qdays("tsq_qdays_cnt", "otc_qdays_cnt").alias("qdays_cnt"),
        exchange_indicator("tsq_id").alias("exchange_indicator_rank"),
        days_between(anchor_date, "date_of_end_placing").alias("days_since_issue"),
        days_between("maturity_date", anchor_date).alias("days_to_maturity"),
    )


def global_aggs(merged: DataFrame) -> DataFrame:
    """A5: per anchor date max providers, max quoted days and bond count.

    A plain aggregation with map-side partial aggregation; one row per
    anchor date (one row for a daily run).
    """
    return merged.groupBy("anchor_date").agg(
        F.max("providers_cnt").cast("bigint").alias("max_providers_cnt"),
        F.max("qdays_cnt").cast("bigint").alias("max_qdays_cnt"),
        F.count("id").cast("bigint").alias("total_bonds"),
    )


def with_global_aggs(merged: DataFrame, aggs: DataFrame) -> DataFrame:
    """Attach the aggregates to every row.

    An equi-join on anchor_date instead of a cross join; the aggregate side
    has one row per anchor date, so broadcasting it is bounded.
    """
    return merged.join(F.broadcast(aggs), "anchor_date", "inner")

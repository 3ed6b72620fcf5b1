"""The single-partition form of the global positions, which tests and the bench compare with."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bondliq.operators.weights import weights_dict
from bondliq.plans import liquidity as liq


def window_position(df: DataFrame, order: Sequence[Column], alias: str) -> DataFrame:
    return df.withColumn(alias, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def spread_order():
    return [F.col("baspread_rel_median").desc_nulls_last(), F.col("id").asc()]


def volume_order():
    return [F.col("usd_volume").asc_nulls_first(), F.col("id").asc()]


def window_liquidity(tsq, otc, bonds, weights, anchor: str) -> DataFrame:
    m = window_position(liq.merged_metrics(tsq, otc, bonds, anchor), spread_order(), "pos_by_baspread_rel_median")
    m = window_position(m, volume_order(), "pos_by_usd_volume")
    return liq.indexed(liq.with_ranks(m), weights_dict(weights))

"""Merge both markets, rank, and compute the liquidity index."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondliq import schemas
from bondliq.functions.index import MIN_QUOTED_DAYS, index_from_columns, qdays_rank, ratio
from bondliq.operators.enforce import enforce
from bondliq.operators.merge import coverage_merge, global_aggs, merge_metrics, with_global_aggs
from bondliq.operators.position import Ranking, global_positions, with_row_key
from bondliq.operators.weights import weights_dict
from bondliq.session import materialize

# Widest spread first, unknown spread last; W2: smallest volume first,
# unknown volume first (ranks worst). Ties go to the lower id.
SPREAD = Ranking("baspread_rel_median", "pos_by_baspread_rel_median", descending=True, nulls_first=False)
VOLUME = Ranking("usd_volume", "pos_by_usd_volume", descending=False, nulls_first=True)
#: names the rows of the kept merged table, so that narrow tables can be ranked and joined back
ROW_KEY = "_row"


def merged_metrics(
    tsq: DataFrame, otc: DataFrame, bonds: DataFrame, anchor: str | None, checkpoint_merged: bool = True, also: Sequence[str] = ()
) -> DataFrame:
    """J5 + D3 + X2-X5 + D4 + A5 + J6: one row per covered bond with the
    per-date aggregates attached.

    With ``checkpoint_merged`` the merged table (one row per bond, with a row key) is checkpointed
    to the shared folder before it is read three times (aggregates, positions, result);
    without it every reader would recompute the quote aggregations. ``also``: the columns that
    name the anchor date of a row, where several run as one plan (``anchor`` is None then).
    """
    merged = merge_metrics(coverage_merge(bonds, tsq, otc, also), anchor, also)
    if checkpoint_merged:
        merged = materialize(with_row_key(merged, ROW_KEY))
    return with_global_aggs(merged, global_aggs(merged))


def positions(merged: DataFrame, rankings: Sequence[Ranking] = (SPREAD, VOLUME)) -> DataFrame:
    """W1 and W2 of every anchor date: widest spread first, unknown spread last; smallest volume
    first, unknown volume first (ranks worst). Ties go to the lower id."""
    if ROW_KEY not in merged.columns:
        merged = materialize(with_row_key(merged, ROW_KEY))
    return global_positions(merged, rankings, ROW_KEY, "id", within=["anchor_date"]).drop(ROW_KEY)


def ranked(merged: DataFrame) -> DataFrame:
    """W1, W2, X6, X7 on the merged table."""
    return with_ranks(positions(merged))


def with_ranks(m: DataFrame) -> DataFrame:
    """X6, X7 on the merged table with its positions."""
    return m.select(
        "*",
        ratio("pos_by_baspread_rel_median", "total_bonds").alias("baspread_rel_rank"),
        ratio("providers_cnt", "max_providers_cnt").alias("providers_cnt_rank"),
        ratio("pos_by_usd_volume", "total_bonds").alias("usd_volume_rank"),
        qdays_rank("qdays_cnt", "max_qdays_cnt", MIN_QUOTED_DAYS).alias("qdays_cnt_rank"),
    )


def liquidity_table(
    tsq: DataFrame,
    otc: DataFrame,
    bonds: DataFrame,
    weights: DataFrame | Mapping[str, float],
    anchor: str | None,
    *,
    zero_policy: str = "product",
    index_digits: int | None = None,
    also: Sequence[str] = (),
) -> DataFrame:
    """The 33-column result for one anchor date (``yyyyMMdd`` or ``yyyy-MM-dd``), or for the
    dates in the first column of ``also`` (``anchor`` is None then).

    ``index_digits`` rounds the index (``pow`` of the JVM and of C math
    libraries can differ in the last bit; a cross-engine comparison rounds).
    """
    w = weights_dict(weights)
    return indexed(ranked(merged_metrics(tsq, otc, bonds, anchor, also=also)), w, zero_policy, index_digits)


def indexed(m: DataFrame, w: Mapping[str, float], zero_policy: str = "product", index_digits: int | None = None) -> DataFrame:
    """The index and the fixed columns on the ranked table."""
    m = m.select("*", *[F.lit(v).alias(k) for k, v in w.items()])
    index = index_from_columns(w, zero_policy)
    if index_digits is not None:
        index = F.round(index, index_digits)
    m = m.withColumn("liq_index", index)
    return enforce(m.select(*schemas.LIQUIDITY_COLUMNS), schemas.LIQUIDITY, "liquidity")

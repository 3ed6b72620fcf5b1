"""Rank ratios and the liquidity index."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Quoted-days threshold of the days rank (fixed value)
MIN_QUOTED_DAYS = 19

# rank column -> weight name, in the order the index multiplies them
RANK_WEIGHTS = (
    ("baspread_rel_rank", "baspread_rel_rank_w"),
    ("providers_cnt_rank", "providers_cnt_rank_w"),
    ("usd_volume_rank", "usd_volume_rank_w"),
    ("qdays_cnt_rank", "qdays_cnt_rank_w"),
    ("exchange_indicator_rank", "exchange_indicator_rank_w"),
)


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(num: Column | str, den: Column | str) -> Column:
    """A count or position over a total, as double."""
    return _c(num).cast("double") / _c(den).cast("double")


def qdays_rank(qdays: Column | str, max_qdays: Column | str, min_days: int = MIN_QUOTED_DAYS) -> Column:
    """0 below ``min_days`` quoted days, else qdays / max qdays."""
    q = _c(qdays)
    return F.when(q < F.lit(min_days), F.lit(0.0)).otherwise(ratio(q, max_qdays))


def liquidity_index(
    ranks: Sequence[Column | str],
    weights: Sequence[Column | str | float],
    zero_policy: str = "product",
) -> Column:
    """Weighted geometric mean of the ranks.

    ``product``: (prod r_i ** w_i) ** (1 / sum w_i), the production rule;
    any zero rank with positive weight gives 0.
    ``skip``: exp(sum w_i ln r_i / sum w_i) with zero ranks left out.
    """
    r = [_c(x) for x in ranks]
    w = [F.lit(float(x)) if isinstance(x, (int, float)) else _c(x) for x in weights]
    wsum = w[0]
    for x in w[1:]:
        wsum = wsum + x
    if zero_policy == "product":
        prod = F.pow(r[0], w[0])
        for ri, wi in zip(r[1:], w[1:]):
            prod = prod * F.pow(ri, wi)
        return F.pow(prod, F.pow(wsum, F.lit(-1)))
    if zero_policy == "skip":
        total = None
        for ri, wi in zip(r, w):
            term = F.when(ri != F.lit(0), wi * F.log(ri)).otherwise(F.lit(0.0))
            total = term if total is None else total + term
        return F.exp(F.pow(wsum, F.lit(-1)) * total)
    raise ValueError(f"unknown zero_policy {zero_policy!r}")


def index_from_columns(weights: Mapping[str, float], zero_policy: str = "product") -> Column:
    """The index over the standard rank columns with literal weights."""
    return liquidity_index(
        [rank for rank, _ in RANK_WEIGHTS], [weights[w] for _, w in RANK_WEIGHTS], zero_policy
    )

"""Rules that combine the exchange (tsq) and OTC sides of a bond."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def combined_spread(tsq: Column | str, otc: Column | str) -> Column:
    """Mean of both markets when both exist, else the one that exists."""
    tsq, otc = _c(tsq), _c(otc)
    return (
        F.when(tsq.isNotNull() & otc.isNotNull(), (tsq + otc) / F.lit(2))
        .when(tsq.isNotNull(), tsq)
        .otherwise(otc)
    )


def combined_providers(tsq: Column | str, otc: Column | str) -> Column:
    """Sum when both exist, else the one that exists."""
    tsq, otc = _c(tsq), _c(otc)
    return F.coalesce(tsq + otc, tsq, otc)


def combined_qdays(tsq: Column | str, otc: Column | str) -> Column:
    """Exchange value when present, else OTC (neither sum nor max)."""
    return F.coalesce(_c(tsq), _c(otc))


def exchange_indicator(tsq_key: Column | str) -> Column:
    """1.0 when the bond has exchange metrics, else 0.5."""
    return F.when(_c(tsq_key).isNotNull(), F.lit(1.0)).otherwise(F.lit(0.5))

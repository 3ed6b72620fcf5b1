"""Quote-level expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def relative_spread(bid: Column | str = "bid", ask: Column | str = "ask") -> Column:
    """(ask - bid) / ((ask + bid) / 2).

    Crossed quotes (ask < bid) give negative values and are kept. A zero mid
    gives null instead of an error (ANSI mode stays on).
    """
    bid, ask = _c(bid), _c(ask)
    return F.try_divide(ask - bid, (ask + bid) / F.lit(2))

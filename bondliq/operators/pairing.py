"""Pair OTC bid and ask rows of the same (bond, provider, day).

The production rule is an inner join of the two sides on (bond, prov, date):
k bids and m asks of one key give k * m quotes, unpaired sides vanish.
``pair_sides`` lists those rows; adaptive execution splits the rows of a hot key
over tasks. The metrics never need the list (``pair_median.pair_spread_medians``
works on it implicitly).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

PAIR_KEYS = ["bond", "prov", "date"]


def pair_sides(bids: DataFrame, asks: DataFrame) -> DataFrame:
    """(bond, prov, date, bid, ask) for every bid x ask of a key."""
    return bids.join(asks, PAIR_KEYS, "inner").select(*PAIR_KEYS, "bid", "ask")

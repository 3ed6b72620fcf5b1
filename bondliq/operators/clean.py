"""Cleaning and restriction of the inputs."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondliq import schemas
from bondliq.operators.enforce import enforce

# Trading grounds excluded from the exchange quotes (fixed values)
EXCLUDED_GROUNDS = (327, 381)

BID, ASK = 1, 2  # OTC quote_type codes (fixed values)

# Largest bond list filtered into the quotes with an explicit broadcast
# (ids only: a hash relation of a few tens of MB at most).
BROADCAST_BOND_ROWS = 2_000_000
# Largest bond list that a Bloom filter of the size in operators/bloom.py still restricts well
BLOOM_BOND_ROWS = 30_000_000


def strict_bonds(bonds_raw: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """C1 = P1 + P2 + P3: drop rows without id or isin, rename, cast, enforce.
    ``also`` (here and below) keeps further columns, such as the anchor date."""
    kept = bonds_raw.where(F.col("id").isNotNull() & F.col("isin_code").isNotNull())
    projected = kept.select(
        *also, "id", F.col("isin_code").alias("isin"), "usd_volume", "date_of_end_placing", "maturity_date"
    )
    return enforce(projected, schemas.STRICT_BONDS, "bonds", also)


def exchange_clean(raw: DataFrame, excluded: Iterable[int] = EXCLUDED_GROUNDS, also: Sequence[str] = ()) -> DataFrame:
    """All five fields present, excluded grounds out, day granularity."""
    cond = F.lit(True)
    for c in ("bond", "tg", "date", "bid", "ask"):
        cond = cond & F.col(c).isNotNull()
    excluded = list(excluded)
    if excluded:
        cond = cond & ~F.col("tg").isin(excluded)
    return raw.where(cond).select(
        *also,
        F.col("bond").try_cast("bigint").alias("bond"),
        F.col("tg").try_cast("bigint").alias("prov"),
        F.to_date(F.col("date")).alias("date"),
        F.col("bid").try_cast("double").alias("bid"),
        F.col("ask").try_cast("double").alias("ask"),
    )


def listed(quotes: DataFrame, bonds: DataFrame, broadcast: bool = False, also: Sequence[str] = ()) -> DataFrame:
    """Keep quotes of listed bonds (inner join bond = id, quote columns only).

    An inner join, not a semi join: duplicate bond ids fan out as in the
    production job. ``broadcast`` forces the id list to every task (the
    caller has counted it); otherwise the planner broadcasts it when its
    estimated size is small and adaptive execution re-plans from the real
    size, else a shuffle join is used (with skew splitting for hot bonds).
    """
    ids = bonds.select(*also, F.col("id").alias("bond"))
    if broadcast:
        ids = F.broadcast(ids)
    return quotes.join(ids, [*also, "bond"], "inner").select(*quotes.columns)


def listing_plan(bonds: DataFrame, max_rows: int = BROADCAST_BOND_ROWS, max_bloom_rows: int = BLOOM_BOND_ROWS) -> str:
    """``early``: filter the quotes by a broadcast of the (counted, bounded)
    bond ids before any shuffle. ``bloom``: the list is too large for that, so a
    Bloom filter of bounded size removes most quotes of unlisted bonds before the
    shuffle. ``late``: the list is too large for a useful filter as well. After ``bloom`` and
    ``late`` the metrics' final per-bond join with the bond list restricts the quotes exactly
    (per-bond medians and distinct counts do not change when all quotes of a bond repeat, so
    the result is the same)."""
    n = bonds.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    return "early" if n <= max_rows else "bloom" if n <= max_bloom_rows else "late"


def otc_clean(raw: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Bond, org, date, price present and price > 0; quote_type unchecked."""
    cond = (
        F.col("bond").isNotNull()
        & F.col("org").isNotNull()
        & F.col("date").isNotNull()
        & F.col("price").isNotNull()
        & (F.col("price") > 0)
    )
    return raw.where(cond).select(
        *also,
        F.col("bond").try_cast("bigint").alias("bond"),
        F.col("org").try_cast("bigint").alias("prov"),
        F.to_date(F.col("date")).alias("date"),
        F.col("quote_type"),
        F.col("price").try_cast("double").alias("price"),
    )


def otc_sides(quotes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split by side; codes other than 1 (bid) and 2 (ask) vanish."""
    keys = ["bond", "prov", "date"]
    bids = quotes.where(F.col("quote_type") == BID).select(*keys, F.col("price").alias("bid"))
    asks = quotes.where(F.col("quote_type") == ASK).select(*keys, F.col("price").alias("ask"))
    return bids, asks


def strict_quotes(quotes: DataFrame, name: str, also: Sequence[str] = ()) -> DataFrame:
    """P3 on a quote frame (bond, prov, date, bid, ask all non-null)."""
    return enforce(quotes, schemas.STRICT_QUOTES, name, also)

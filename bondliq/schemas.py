"""Fixed schemas of every stage (names, types, nullability)."""

from __future__ import annotations

from pyspark.sql import types as T

L, S, D, DT = T.LongType(), T.StringType(), T.DoubleType(), T.DateType()


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# raw CSV layouts (read with an explicit schema: one pass, stable types)
BONDS_CSV = _schema(
    ("id", L, True), ("isin_code", S, True), ("usd_volume", D, True),
    ("date_of_end_placing", DT, True), ("maturity_date", DT, True),
)
EXCHANGE_CSV = _schema(
    ("bond", L, True), ("tg", L, True), ("date", T.TimestampType(), True),
    ("bid", D, True), ("ask", D, True),
)
OTC_CSV = _schema(
    ("bond", L, True), ("org", L, True), ("date", T.TimestampType(), True),
    ("quote_type", T.IntegerType(), True), ("price", D, True),
)

STRICT_BONDS = _schema(
    ("id", L, False), ("isin", S, False), ("usd_volume", D, True),
    ("date_of_end_placing", DT, True), ("maturity_date", DT, True),
)

STRICT_QUOTES = _schema(
    ("bond", L, False), ("prov", L, False), ("date", DT, False),
    ("bid", D, False), ("ask", D, False),
)

MARKET_METRICS = _schema(
    ("id", L, False), ("isin", S, False), ("bid_ask_spread_relative_median", D, False),
    ("providers_cnt", L, False), ("qdays_cnt", L, False),
)

WEIGHTS = _schema(("rank", S, False), ("weight", D, False))

# the five weight names the index looks up (fixed values)
WEIGHT_NAMES = (
    "baspread_rel_rank_w",
    "providers_cnt_rank_w",
    "usd_volume_rank_w",
    "qdays_cnt_rank_w",
    "exchange_indicator_rank_w",
)

# final table: 33 columns in this order
LIQUIDITY = _schema(
    ("id", L, False), ("isin", S, False),
    ("date_of_end_placing", DT, True), ("maturity_date", DT, True),
    ("anchor_date", DT, False),
    ("days_since_issue", L, True), ("days_to_maturity", L, True),
    ("total_bonds", L, True),
    ("tsq_baspread_rel_median", D, True), ("otc_baspread_rel_median", D, True),
    ("baspread_rel_median", D, True), ("pos_by_baspread_rel_median", L, True),
    ("baspread_rel_rank", D, True), ("baspread_rel_rank_w", D, True),
    ("tsq_providers_cnt", L, True), ("otc_providers_cnt", L, True),
    ("max_providers_cnt", L, True), ("providers_cnt", L, True),
    ("providers_cnt_rank", D, True), ("providers_cnt_rank_w", D, True),
    ("usd_volume", D, True), ("pos_by_usd_volume", L, True),
    ("usd_volume_rank", D, True), ("usd_volume_rank_w", D, True),
    ("tsq_qdays_cnt", L, True), ("otc_qdays_cnt", L, True),
    ("max_qdays_cnt", L, True), ("qdays_cnt", L, True),
    ("qdays_cnt_rank", D, True), ("qdays_cnt_rank_w", D, True),
    ("exchange_indicator_rank", D, True), ("exchange_indicator_rank_w", D, True),
    ("liq_index", D, True),
)

LIQUIDITY_COLUMNS = [f.name for f in LIQUIDITY.fields]

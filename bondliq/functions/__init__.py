"""Column expressions: built-in Spark functions only, so they stay in codegen."""

from bondliq.functions.combine import combined_providers, combined_qdays, combined_spread, exchange_indicator
from bondliq.functions.dates import (
    anchor_compact,
    anchor_compact_str,
    anchor_date_lit,
    business_date,
    clamp_far_date,
    days_between,
)
from bondliq.functions.index import liquidity_index, qdays_rank, ratio
from bondliq.functions.spread import relative_spread

__all__ = [
    "anchor_compact", "anchor_compact_str", "anchor_date_lit", "business_date", "clamp_far_date",
    "combined_providers", "combined_qdays", "combined_spread", "days_between", "exchange_indicator",
    "liquidity_index", "qdays_rank", "ratio", "relative_spread",
]

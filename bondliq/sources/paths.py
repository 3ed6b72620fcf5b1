"""Dated input paths of a daily run."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

# File name patterns of the daily archive (fixed values)
EXCHANGE_FILE = "quotes_{d}.csv"
OTC_FILE = "quotes_mp_month_raw_{d}.csv"
BONDS_FILE = "bonds_{d}.csv"


@dataclass(frozen=True)
class DayInputs:
    anchor: str  # yyyyMMdd
    exchange: str
    otc: str
    bonds: str


def day_inputs(root: str, anchor: str | None) -> DayInputs:
    """``<root>_<yyyyMMdd>/{quotes,quotes_mp_month_raw,bonds}_<yyyyMMdd>.csv``.

    ``anchor`` is compact (yyyyMMdd), ISO (yyyy-MM-dd), or "0"/None for the
    current business date (D1/D2).
    """
    if anchor is None or not (len(anchor) == 8 and anchor.isdigit()):
        from bondliq.functions.dates import anchor_compact_str

        anchor = anchor_compact_str(anchor)
    folder = f"{root.rstrip('/')}_{anchor}"
    return DayInputs(
        anchor,
        f"{folder}/{EXCHANGE_FILE.format(d=anchor)}",
        f"{folder}/{OTC_FILE.format(d=anchor)}",
        f"{folder}/{BONDS_FILE.format(d=anchor)}",
    )


def backfill_inputs(root: str, anchors: Iterable[str | None]) -> list[DayInputs]:
    """Inputs of several anchor dates (for recalculation date by date)."""
    return [day_inputs(root, a) for a in anchors]

"""Date expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Business-day rule of the daily run (fixed values): before 10:00 Moscow
# time the business date is the previous day.
BUSINESS_ZONE = "Europe/Moscow"
BUSINESS_CUTOFF_HOURS = 10

# Far-date clamp of the old sink (fixed values): dates after 2037-12-30
# become the sentinel 1970-01-01.
CLAMP_LIMIT = "2037-12-30"
CLAMP_SENTINEL = "1970-01-01"


_EPOCH = "1970-01-01 00:00:00"


def business_date(
    ts: Column | str,
    zone: str = BUSINESS_ZONE,
    cutoff_hours: int = BUSINESS_CUTOFF_HOURS,
    source_zone: str | None = None,
) -> Column:
    """Business date = local date in ``zone`` of (local time - cutoff).

    ``source_zone=None``: ``ts`` is an instant (TIMESTAMP). A string: ``ts`` is
    a wall-clock time without zone (TIMESTAMP_NTZ) in that zone, e.g. "UTC".
    Either way the result does not depend on the session time zone.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    if source_zone is None:  # from the instant itself: a session zone's repeated hour is two instants
        local = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.lit(_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), (F.unix_micros(ts.cast("timestamp")) / F.lit(1_000_000).cast("decimal(8,0)")).cast("decimal(18,6)")))
    else:
        local = F.convert_timezone(F.lit(source_zone), F.lit(zone), ts.cast("timestamp_ntz"))
    return F.to_date(local - F.make_dt_interval(F.lit(0), F.lit(cutoff_hours)))


def anchor_compact(anchor: Column | str, fallback: Column | None = None) -> Column:
    """D2: 'yyyy-MM-dd' -> 'yyyyMMdd'; '0' or null means "use the business date".

    ``fallback`` is the business date column to use in that case
    (default: business date of now).
    """
    anchor = F.col(anchor) if isinstance(anchor, str) else anchor
    if fallback is None:
        fallback = business_date(F.current_timestamp())
    use_fallback = anchor.isNull() | (anchor == F.lit("0"))
    return F.when(use_fallback, F.date_format(fallback, "yyyyMMdd")).otherwise(
        F.date_format(F.to_date(anchor, "yyyy-MM-dd"), "yyyyMMdd")
    )


def anchor_compact_str(anchor: str | None, now: _dt.datetime | None = None) -> str:
    """D2 on the driver for a run argument (a scalar, not data)."""
    if anchor is None or anchor == "0":
        from zoneinfo import ZoneInfo

        now = now or _dt.datetime.now(_dt.timezone.utc)
        local = now.astimezone(ZoneInfo(BUSINESS_ZONE)) - _dt.timedelta(hours=BUSINESS_CUTOFF_HOURS)
        return local.strftime("%Y%m%d")
    return _dt.datetime.strptime(anchor, "%Y-%m-%d").strftime("%Y%m%d")


def anchor_date_lit(anchor: str) -> Column:
    """D3: compact (yyyyMMdd) or ISO anchor string -> constant DATE column."""
    fmt = "yyyyMMdd" if len(anchor) == 8 and anchor.isdigit() else "yyyy-MM-dd"
    return F.to_date(F.lit(anchor), fmt)


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """Signed day difference as bigint; null in, null out."""
    later = F.col(later) if isinstance(later, str) else later
    earlier = F.col(earlier) if isinstance(earlier, str) else earlier
    return F.datediff(later, earlier).cast("bigint")


def clamp_far_date(d: Column | str, limit: str = CLAMP_LIMIT, sentinel: str = CLAMP_SENTINEL) -> Column:
    """X11: dates after ``limit`` become ``sentinel`` (optional sink patch)."""
    d = F.col(d) if isinstance(d, str) else d
    return F.when(d > F.lit(limit).cast("date"), F.lit(sentinel).cast("date")).otherwise(d)

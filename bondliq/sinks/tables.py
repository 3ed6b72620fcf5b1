"""K1-K3, K5, K6: result writers.

All writes are distributed (no ``coalesce(1)``, nothing collected to the
driver) and fail loudly; the old sink swallowed errors. K1 and K2 publish through a
``Store``: readers see the old table or the new one, never a part of either.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bondliq import schemas
from bondliq.sinks.store import Store

METRICS_COLUMNS = [f.name for f in schemas.MARKET_METRICS.fields]
#: the one table of a store that ``write_full_refresh`` or ``write_replace_date`` keeps
TABLE = "data"


def with_audit(df: DataFrame, column: str = "upsert_time") -> DataFrame:
    """K5: row audit timestamp filled at write time."""
    return df.withColumn(column, F.current_timestamp())


def write_full_refresh(df: DataFrame, path: str, keep: tuple[str, ...] = ()) -> None:
    """K1: replace the whole market-metrics table (truncate + insert).

    The new version is written in full and published last, by one manifest; a write that
    fails, or dies at any moment, leaves the old table as it was. ``keep`` adds extra
    columns (e.g. the audit column). Read it with ``read_table``.
    """
    store = Store(df.sparkSession, path)
    store.commit({TABLE: store.write(df.select(*METRICS_COLUMNS, *keep), TABLE)})
    store.vacuum()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``write_full_refresh`` has published last."""
    return Store(spark, path).read(TABLE)


def iso_date(date: str) -> str:
    """yyyy-MM-dd of yyyyMMdd or yyyy-MM-dd."""
    return f"{date[:4]}-{date[4:6]}-{date[6:]}" if len(date) == 8 and date.isdigit() else date


def write_replace_date(df: DataFrame, path: str, date_col: str = "anchor_date", date: str | None = None) -> None:
    """K2: replace only the anchor dates present in ``df``.

    Other dates stay untouched, and all dates of ``df`` are switched at once, after the write
    (a failed run leaves the previous version in place, unlike delete-then-insert).
    ``date`` (yyyy-MM-dd or yyyyMMdd) names the date that the run computes: if
    the frame has no row of it, its old rows go as well. Read it with ``read_dated``.
    """
    store = Store(df.sparkSession, path)
    gone = {iso_date(date): None} if date is not None else {}
    store.commit({TABLE: gone | store.write_parts(df, TABLE, date_col)})
    store.vacuum()


def read_dated(spark: SparkSession, path: str, columns=None, dates: Iterable[str] | None = None) -> DataFrame:
    """Read back a date-partitioned table in the fixed column order, or only some ``dates`` of
    it. A table whose every date is empty reads as empty."""
    parts = None if dates is None else [iso_date(d) for d in dates]
    df = Store(spark, path).read(TABLE, schemas.LIQUIDITY, parts)
    return df.select(*(columns or schemas.LIQUIDITY_COLUMNS))


def append_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None) -> None:
    """K3: append to a JDBC table from every partition in parallel."""
    df.write.mode("append").jdbc(url, table, properties=dict(properties or {}))


def write_export(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """K6: parquet or CSV export folder of a result frame."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", "true").csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unknown export format {fmt!r}")

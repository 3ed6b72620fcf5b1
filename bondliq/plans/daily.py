"""The daily run, for one anchor date or for several in one plan.

Each CSV of the dated archive is parsed once, by a job that splits rows that convert from
those that do not into a staged table. The anchor date is part of every key from there on
(quotes, bonds, metrics, positions), so a backfill of many dates is one plan whose stages hold
all dates, and a single day is the same plan with one date. The two metrics tables, the result
of every date and the rejects are published by one manifest (``sinks.store``): a run that dies at any moment
leaves all of them as they were. The session is the caller's; nothing here stops it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bondliq import schemas
from bondliq.operators.clean import listing_plan, strict_bonds
from bondliq.operators.dedupe import dedupe_by_key
from bondliq.plans.liquidity import liquidity_table
from bondliq.plans.metrics import exchange_metrics, otc_metrics
from bondliq.session import staging_path, files
from bondliq.sinks.store import Store
from bondliq.sinks.tables import METRICS_COLUMNS, iso_date, with_audit
from bondliq.sources.csv import read_bonds, read_exchange_quotes, read_otc_quotes, stage_csv
from bondliq.sources.paths import DayInputs, backfill_inputs

# Result table names (fixed values)
TSQ_TABLE, OTC_TABLE, LIQUIDITY_TABLE = "tsq_metrics", "otc_metrics", "metrics_merged_with_ranks"
REJECTS_TABLE = "rejects"
REJECTS = "anchor string, input string, raw string"

ANCHOR = "anchor"


@dataclass(frozen=True)
class DayOutputs:
    """The tables of a store (names), to be read through its manifest."""

    root: str
    tsq_metrics: str = TSQ_TABLE
    otc_metrics: str = OTC_TABLE
    liquidity: str = LIQUIDITY_TABLE
    rejects: str = REJECTS_TABLE

    def read(self, spark: SparkSession, table: str, dates: Iterable[str] | None = None) -> DataFrame:
        """A table as last published; of the result table also some anchor dates only."""
        store = Store(spark, self.root)
        if table == self.rejects:
            return store.read(table, spark.createDataFrame([], REJECTS).schema, dates)
        if table == self.liquidity:
            audited = with_audit(spark.createDataFrame([], schemas.LIQUIDITY)).schema
            return store.read(table, audited, None if dates is None else [iso_date(d) for d in dates])
        return store.read(table)


def outputs(root: str) -> DayOutputs:
    return DayOutputs(root.rstrip("/"))


# Table keys and the stated order that picks the kept row of a repeated key
# (the bond list may repeat an id; joins then fan out as in production).
METRICS_KEY, METRICS_ORDER = ["id"], ["isin"]
LIQUIDITY_KEY, LIQUIDITY_ORDER = ["id", "anchor_date"], ["isin", "pos_by_baspread_rel_median"]


def _unpriced(spark: SparkSession, folders: Mapping[str, str]) -> DataFrame | None:
    """Bonds without a median, as rejects."""
    out = None
    for name, folder in folders.items():
        fs, make = files(spark, folder)
        if fs.exists(make(folder)):
            rows = spark.read.parquet(folder)
            one = rows.select(ANCHOR, F.lit(name).alias("input"), F.to_json(F.struct(*[c for c in rows.columns if c != ANCHOR])).alias("raw"))
            out = one if out is None else out.unionByName(one)
    return out


def run_inputs(
    spark: SparkSession,
    inputs: Sequence[DayInputs],
    weights: DataFrame | Mapping[str, float],
    out_root: str,
    *,
    on_corrupt: str = "raise",
    on_null: str = "raise",
    **options,
) -> DayOutputs:
    """Compute and publish the tables of all ``inputs`` (one per anchor date) in one plan.

    The metrics tables hold the last of the anchor dates, as if the dates had been run one
    after the other; the result table gets each date.

    Input rows with a value that does not convert, or that the CSV parser cannot split, go
    to the rejects table with their line; any such row fails the run before a result is
    published, unless ``on_corrupt`` is ``"reject"``. A value that is missing in the file is an
    ordinary null. A bond without a median (every mid is zero) fails the run unless
    ``on_null`` is ``"reject"``; then it is in the rejects table too.

    Each table keeps one row per key (K4), as the production tables' primary
    keys did, but under a stated order instead of arrival order.
    """
    if not inputs:
        return outputs(out_root)
    out, store = outputs(out_root), Store(spark, out_root)
    last = inputs[-1].anchor
    inputs = list({i.anchor: i for i in inputs}.values())
    readers = {"bonds": read_bonds, "exchange": read_exchange_quotes, "otc": read_otc_quotes}
    read = {k: stage_csv(spark, f, {i.anchor: getattr(i, k) for i in inputs}, k, ANCHOR) for k, f in readers.items()}
    unpriced = {k: staging_path(spark, f"{k}-unpriced") for k in ("exchange", "otc")}
    try:
        bad = sum(r.rejected for r in read.values())
        rejects = None
        for k, r in read.items():
            rows = r.rejects.select(ANCHOR, F.lit(k).alias("input"), "raw")
            rejects = rows if rejects is None else rejects.unionByName(rows)
        no_rejects = {i.anchor: None for i in inputs}
        if bad and on_corrupt != "reject":
            store.commit({out.rejects: no_rejects | store.write_parts(rejects, out.rejects, ANCHOR)})
            raise ValueError(f"{bad} input rows of {', '.join(no_rejects)} do not convert: see {out.root}, table {out.rejects}")
        also = [ANCHOR]
        bonds = strict_bonds(read["bonds"].good, also)
        listing = listing_plan(bonds)  # one count of the bond list for both markets
        common = {"listing": listing, "on_null": on_null, "also": also}
        tsq = exchange_metrics(read["exchange"].good, bonds, rejects=unpriced["exchange"], **common)
        otc = otc_metrics(read["otc"].good, bonds, rejects=unpriced["otc"], **common)
        tsq, otc = [dedupe_by_key(m, [ANCHOR, *METRICS_KEY], METRICS_ORDER) for m in (tsq, otc)]
        table = liquidity_table(tsq, otc, bonds, weights, None, also=also, **options)
        more = _unpriced(spark, unpriced)
        if more is not None:
            rejects = rejects.unionByName(more)
        changes = {out.rejects: no_rejects | (store.write_parts(rejects, out.rejects, ANCHOR) if bad or more is not None else {})}
        for frame, name in ((tsq, out.tsq_metrics), (otc, out.otc_metrics)):
            changes[name] = store.write(with_audit(frame.where(F.col(ANCHOR) == last).select(*METRICS_COLUMNS)), name)
        result = with_audit(dedupe_by_key(table, LIQUIDITY_KEY, LIQUIDITY_ORDER))
        changes[out.liquidity] = {iso_date(i.anchor): None for i in inputs} | store.write_parts(result, out.liquidity, "anchor_date")
        store.commit(changes)  # all tables and dates at once
    finally:
        for r in read.values():
            r.unstage()
        for folder in unpriced.values():
            fs, make = files(spark, folder)
            fs.delete(make(folder), True)
    store.vacuum()
    return out


def run_day(spark: SparkSession, inputs: DayInputs, weights: DataFrame | Mapping[str, float], out_root: str, **options) -> DayOutputs:
    """The run of one anchor date (see ``run_inputs``)."""
    return run_inputs(spark, [inputs], weights, out_root, **options)


def run_days(
    spark: SparkSession,
    root: str,
    anchors: Iterable[str],
    weights: DataFrame | Mapping[str, float],
    out_root: str,
    **options,
) -> DayOutputs:
    """Recalculate several anchor dates (backfill): one plan, one commit."""
    return run_inputs(spark, backfill_inputs(root, anchors), weights, out_root, **options)

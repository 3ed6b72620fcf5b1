"""Registered queries: one per operator of the inventory, each over the
fixture views of the driver's tables at a scale-factor folder.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names match the SQL text in ``bondliq.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bondliq import schemas
from bondliq.functions.dates import anchor_compact, business_date, clamp_far_date, days_between, anchor_date_lit
from bondliq.functions.index import liquidity_index, RANK_WEIGHTS
from bondliq.operators.clean import exchange_clean, listed, listing_plan, otc_clean, otc_sides, strict_bonds
from bondliq.operators.counts import quote_counts
from bondliq.operators.dedupe import dedupe_by_key
from bondliq.operators.enforce import split_rejects
from bondliq.operators.merge import coverage_merge, global_aggs, merge_metrics
from bondliq.plans import liquidity as liq
from bondliq.plans import metrics as met
from bondliq.operators.position import Ranking
from bondliq.session import materialize, staging_path
from bondliq.sinks import tables as sinks
from bondliq.sources import csv as csvsrc
from bondliq.sources import fixtures as fx
from bondliq.sources.paths import day_inputs

Query = Callable[[SparkSession, str], DataFrame]

SECOND_ANCHOR = "2001-10-31"

# pairs that the hot query may list at once, so that it takes the bracket path at any size
HOT_PAIR_CAP = 10_000

# The index is compared with the DuckDB text rounded to this many places:
# pow() of the JVM and of C math libraries can differ in the last bit.
INDEX_DIGITS = 9


class Inputs:
    """Lazily built fixture frames of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf
        self._listing: str | None = None

    def listing(self) -> str:
        """J1 plan, decided once per set of inputs (one count of the bond list)."""
        if self._listing is None:
            self._listing = listing_plan(self.bonds())
        return self._listing

    def bonds(self) -> DataFrame:
        return strict_bonds(fx.bonds_raw(self.spark, self.sf))

    def exchange(self) -> DataFrame:
        return met.exchange_quotes(fx.exchange_quotes_raw(self.spark, self.sf), self.bonds())

    def otc(self) -> DataFrame:
        return met.otc_quotes(fx.otc_quotes_raw(self.spark, self.sf), self.bonds())

    def tsq_metrics(self) -> DataFrame:
        return met.exchange_metrics(fx.exchange_quotes_raw(self.spark, self.sf), self.bonds(), listing=self.listing())

    def otc_metrics(self) -> DataFrame:
        return met.otc_metrics(fx.otc_quotes_raw(self.spark, self.sf), self.bonds(), listing=self.listing())

    def merged(self, anchor: str = fx.ANCHOR_DATE) -> DataFrame:
        return liq.merged_metrics(self.tsq_metrics(), self.otc_metrics(), self.bonds(), anchor)

    def ranked(self) -> DataFrame:
        return liq.ranked(self.merged())

    def liquidity(self, anchor: str = fx.ANCHOR_DATE) -> DataFrame:
        return liq.liquidity_table(
            self.tsq_metrics(), self.otc_metrics(), self.bonds(), fx.WEIGHTS, anchor, index_digits=INDEX_DIGITS
        )


def _q(fn: Callable[[Inputs], DataFrame]) -> Query:
    return lambda spark, sf: fn(Inputs(spark, sf))


def _median_via_sql(i: Inputs) -> DataFrame:
    """The two median levels as SQL text over temporary views."""
    spark = i.spark
    tag = uuid.uuid4().hex[:10]
    i.exchange().createOrReplaceTempView(f"quotes_{tag}")
    s = spark.sql(f"""SELECT bond, `date`, try_divide(ask - bid, (ask + bid) / 2) AS ba_spread FROM quotes_{tag}""")
    # the medians of a view go through the operator that splits hot groups
    met.day_medians(s).createOrReplaceTempView(f"days_{tag}")
    return met.median_of_medians(spark.sql(f"SELECT bond, median_of_tgs FROM days_{tag}"))


def _otc_sides(i: Inputs) -> DataFrame:
    bids, asks = otc_sides(listed(otc_clean(fx.otc_quotes_raw(i.spark, i.sf)), i.bonds()))
    keys = ["bond", "prov", "date"]
    return bids.select(*keys, F.lit("bid").alias("side"), F.col("bid").alias("price")).unionByName(
        asks.select(*keys, F.lit("ask").alias("side"), F.col("ask").alias("price"))
    )


def _staged_csv(i: Inputs, raw: DataFrame, file_attr: str, reader, date_is_ts: bool) -> DataFrame:
    """S1-S3 + S5: stage a raw frame as the dated CSV of the daily archive in
    the shared folder, then read it back with the explicit-schema reader."""
    anchor = fx.ANCHOR_DATE.replace("-", "")
    paths = day_inputs(staging_path(i.spark, "archive"), anchor)
    path = getattr(paths, file_attr)
    raw.write.mode("overwrite").option("header", "true").csv(path)
    df = reader(i.spark, path)
    if date_is_ts:
        df = df.withColumn("date", F.to_date("date"))
    return df


def _sink_full_refresh(i: Inputs) -> DataFrame:
    """K1: write the metrics twice (the second run replaces the first)."""
    path = staging_path(i.spark, "tsq_metrics")
    m = materialize(i.tsq_metrics())
    sinks.write_full_refresh(m, path)
    sinks.write_full_refresh(m, path)
    return sinks.read_table(i.spark, path)


def _sink_parquet_csv(i: Inputs) -> DataFrame:
    """K6: CSV export of the OTC metrics, read back with the metrics schema."""
    path = staging_path(i.spark, "otc_metrics_csv")
    sinks.write_export(i.otc_metrics(), path, "csv")
    return i.spark.read.option("header", "true").schema(schemas.MARKET_METRICS).csv(path)


def _sink_replace_date(i: Inputs) -> DataFrame:
    """K2: write date A, date B, then date A again: A is replaced, B kept."""
    path = staging_path(i.spark, "liquidity")
    tsq, otc = materialize(i.tsq_metrics()), materialize(i.otc_metrics())  # once for all dates
    for anchor in (fx.ANCHOR_DATE, SECOND_ANCHOR, fx.ANCHOR_DATE):
        table = liq.liquidity_table(tsq, otc, i.bonds(), fx.WEIGHTS, anchor, index_digits=INDEX_DIGITS)
        sinks.write_replace_date(table, path, date=anchor)
    return sinks.read_dated(i.spark, path)


def _daily_run(i: Inputs) -> DataFrame:
    """Stage the three inputs as the dated CSV archive, run the whole day
    (CSV reads, both metric tables, per-date replace of the result table) and
    read the result table back."""
    from bondliq.plans.daily import run_day

    anchor = fx.ANCHOR_DATE.replace("-", "")
    archive = staging_path(i.spark, "archive")
    paths = day_inputs(archive, anchor)
    fx.bonds_raw(i.spark, i.sf).write.mode("overwrite").option("header", "true").csv(paths.bonds)
    fx.exchange_quotes_raw(i.spark, i.sf).write.mode("overwrite").option("header", "true").csv(paths.exchange)
    fx.otc_quotes_raw(i.spark, i.sf).write.mode("overwrite").option("header", "true").csv(paths.otc)
    out = run_day(i.spark, paths, fx.WEIGHTS, staging_path(i.spark, "liquidity_day"), index_digits=INDEX_DIGITS)
    return out.read(i.spark, out.liquidity).select(*schemas.LIQUIDITY_COLUMNS)


def _liq_skip_zero(i: Inputs) -> DataFrame:
    r = i.ranked()
    w = fx.WEIGHTS
    idx = liquidity_index([rk for rk, _ in RANK_WEIGHTS], [w[n] for _, n in RANK_WEIGHTS], "skip")
    return r.select("id", F.round(idx, INDEX_DIGITS).alias("liq_index_skip_zero"))


def _otc_day_medians(i: Inputs) -> DataFrame:
    """J2 + A1: OTC day medians over every bid x ask pair, without listing them."""
    from bondliq.operators.pair_median import pair_spread_medians

    bids, asks = met.otc_listed_sides(fx.otc_quotes_raw(i.spark, i.sf), i.bonds(), i.listing())
    return pair_spread_medians(bids, asks, "median_of_tgs")


def _otc_hot(i: Inputs) -> DataFrame:
    """J2 + A1 on one hot day that holds every line item: the bracket path."""
    from bondliq.operators.pair_median import pair_spread_medians

    rows = fx.hot_rows(i.spark, i.sf)
    keys = ["bond", "prov", "date"]
    return pair_spread_medians(rows.where("side = 0").select(*keys, "bid"), rows.where("side = 1").select(*keys, "ask"),
                               "median_of_tgs", pair_cap=HOT_PAIR_CAP)


def _exchange_hot(i: Inputs) -> DataFrame:
    """A1 on one hot day that holds every line item: the range split."""
    return met.day_medians(met.spreads(fx.hot_rows(i.spark, i.sf)), method="split")


def _csv_rejects(i: Inputs) -> DataFrame:
    """A staged archive with planted prices that do not convert; the reader hands
    back each such row, counted here per bond."""
    raw = fx.table(i.spark, i.sf, "lineitem").select(
        F.col("l_partkey").alias("bond"), (300 + F.col("l_suppkey")).alias("tg"), F.col("l_shipdate").cast("date").alias("date"),
        F.when(F.col("l_orderkey") % 61 == 0, F.lit("9x9")).otherwise(F.col("l_extendedprice").cast("string")).alias("bid"),
        F.col("l_extendedprice").alias("ask"))
    path = day_inputs(staging_path(i.spark, "archive"), fx.ANCHOR_DATE.replace("-", "")).exchange
    raw.write.mode("overwrite").option("header", "true").csv(path)
    rows = csvsrc.read_exchange_quotes(i.spark, path, keep_corrupt=True)
    return rows.where(F.col(csvsrc.CORRUPT).isNotNull()).groupBy("bond").agg(F.count("*").alias("bad_rows"))


def _one_position(i: Inputs, ranking: Ranking) -> DataFrame:
    return liq.positions(i.merged(), [ranking]).select("id", ranking.column, ranking.alias)


def _dense_day_medians(i: Inputs) -> DataFrame:
    q = fx.exchange_quotes_dense(i.spark, i.sf)
    return met.day_medians(met.spreads(q))


def _bond_age(i: Inputs) -> DataFrame:
    a = anchor_date_lit(fx.ANCHOR_DATE)
    return i.bonds().select(
        "id",
        days_between(a, "date_of_end_placing").alias("days_since_issue"),
        days_between("maturity_date", a).alias("days_to_maturity"),
    )


def _strict_rejects(i: Inputs) -> DataFrame:
    raw = fx.bonds_raw(i.spark, i.sf).select(
        "id", F.col("isin_code").alias("isin"), "usd_volume", "date_of_end_placing", "maturity_date"
    )
    _, rejected = split_rejects(raw, schemas.STRICT_BONDS)
    return rejected


def _events(i: Inputs) -> DataFrame:
    return fx.table(i.spark, i.sf, "events")


REGISTRY: dict[str, Query] = {
    # sources
    "scan_bonds_csv": _q(lambda i: _staged_csv(i, fx.bonds_raw(i.spark, i.sf), "bonds", csvsrc.read_bonds, False)),
    "scan_exchange_csv": _q(lambda i: _staged_csv(
        i, fx.exchange_quotes_raw(i.spark, i.sf), "exchange", csvsrc.read_exchange_quotes, True)),
    "scan_otc_csv": _q(lambda i: _staged_csv(i, fx.otc_quotes_raw(i.spark, i.sf), "otc", csvsrc.read_otc_quotes, True)),
    "csv_rejects": _q(_csv_rejects),
    "median_via_sql": _q(_median_via_sql),
    # dates
    # events.ts is a wall-clock time without zone, in UTC
    "business_date": _q(lambda i: _events(i).select(
        "event_id", business_date("ts", source_zone="UTC").alias("business_date"))),
    "anchor_date_format": _q(lambda i: _events(i).select(
        "event_id", anchor_compact(F.to_date("ts").cast("string")).alias("anchor"))),
    "bond_age_days": _q(_bond_age),
    # projection, filtering, schema
    "bonds_strict": _q(lambda i: i.bonds()),
    "strict_rejects": _q(_strict_rejects),
    "exchange_clean": _q(lambda i: exchange_clean(fx.exchange_quotes_raw(i.spark, i.sf))),
    "otc_clean": _q(lambda i: otc_clean(fx.otc_quotes_raw(i.spark, i.sf))),
    "otc_sides": _q(_otc_sides),
    # joins
    "quotes_for_listed_bonds": _q(lambda i: i.exchange()),
    "otc_paired": _q(lambda i: i.otc()),
    "coverage_merge": _q(lambda i: coverage_merge(i.bonds(), i.tsq_metrics(), i.otc_metrics()).drop("tsq_id")),
    "with_global_aggs": _q(lambda i: i.merged().select(
        "id", "anchor_date", "max_providers_cnt", "max_qdays_cnt", "total_bonds")),
    # aggregations
    "relative_spread": _q(lambda i: met.spreads(i.exchange())),
    "median_by_bond_date": _q(lambda i: met.day_medians(met.spreads(i.exchange()))),
    "median_by_bond_date_dense": _q(_dense_day_medians),
    "median_by_bond_date_otc": _q(_otc_day_medians),
    "median_by_bond_date_hot": _q(_exchange_hot),
    "median_by_bond_date_otc_hot": _q(_otc_hot),
    "median_of_medians": _q(lambda i: met.median_of_medians(met.day_medians(met.spreads(i.exchange())))),
    "quote_counts": _q(lambda i: quote_counts(met.spreads(i.exchange()))),
    "global_aggs": _q(lambda i: global_aggs(merge_metrics(
        coverage_merge(i.bonds(), i.tsq_metrics(), i.otc_metrics()), fx.ANCHOR_DATE))),
    # window / ranking
    "pos_by_spread": _q(lambda i: _one_position(i, liq.SPREAD)),
    "pos_by_usd_volume": _q(lambda i: _one_position(i, liq.VOLUME)),
    # scalar expressions
    "merge_metrics": _q(lambda i: merge_metrics(
        coverage_merge(i.bonds(), i.tsq_metrics(), i.otc_metrics()), fx.ANCHOR_DATE).select(
        "id", "isin", "anchor_date", "baspread_rel_median", "providers_cnt", "qdays_cnt",
        "exchange_indicator_rank", "days_since_issue", "days_to_maturity")),
    "ratio_ranks": _q(lambda i: i.ranked().select("id", "baspread_rel_rank", "providers_cnt_rank", "usd_volume_rank")),
    "qdays_rank": _q(lambda i: i.ranked().select("id", "qdays_cnt", "qdays_cnt_rank")),
    "liq_index": _q(lambda i: i.liquidity().select("id", "liq_index")),
    "liq_index_skip_zero": _q(_liq_skip_zero),
    "clamp_dates": _q(lambda i: i.bonds().select(
        "id", clamp_far_date("date_of_end_placing").alias("date_of_end_placing"),
        clamp_far_date("maturity_date").alias("maturity_date"))),
    # composites
    "exchange_metrics": _q(lambda i: i.tsq_metrics()),
    "otc_metrics": _q(lambda i: i.otc_metrics()),
    "liquidity_table": _q(lambda i: i.liquidity()),
    "daily_run": _q(_daily_run),
    # sinks
    "sink_full_refresh": _q(_sink_full_refresh),
    "sink_replace_date": _q(_sink_replace_date),
    "sink_parquet_csv": _q(_sink_parquet_csv),
    "dedupe_by_key": _q(lambda i: dedupe_by_key(i.exchange(), ["bond", "prov", "date"], ["bid", "ask"])),
}

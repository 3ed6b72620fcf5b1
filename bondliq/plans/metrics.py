"""Per-bond market metrics from quotes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bondliq import schemas
from bondliq.functions.spread import relative_spread
from bondliq.operators.bloom import maybe_listed
from bondliq.operators.clean import ASK, BID, exchange_clean, listed, listing_plan, otc_clean, otc_sides, strict_quotes
from bondliq.operators.enforce import enforce, split_rejects
from bondliq.operators.median import HOT_GROUP_ROWS, lower_median
from bondliq.operators.pair_median import PAIR_CAP, day_medians_from_values, key_of, pair_profile, pair_stats
from bondliq.operators.pairing import pair_sides
from bondliq.session import materialize, staged, unstage

BY = ("bond",)


def spreads(quotes: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """X1 on strict quotes: (bond, prov, date, ba_spread)."""
    return quotes.select(*by, "prov", "date", relative_spread("bid", "ask").alias("ba_spread"))


# entries of the histogram: a spread of a day, a provider
DAY, PROVIDER = 1, 2


def quote_histogram(spread_rows: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """(bond, entry, date, ba_spread, prov, rows): how often each spread occurs on each day
    of a bond (null spreads too), and how many quotes each of its providers gave.

    Everything that the market metrics need from the quotes, in one pass: each row is
    expanded into its two entries, counted per entry with map-side partial aggregation (the
    same shape as Spark's own rewrite of several distinct counts).
    """
    kinds = {c: spread_rows.schema[c].dataType for c in ("date", "ba_spread", "prov")}

    def entry(kind: int, *columns: str):
        own = [F.col(c).alias(c) if c in columns else F.lit(None).cast(t).alias(c) for c, t in kinds.items()]
        return F.struct(F.lit(kind).alias("entry"), *own)

    rows = spread_rows.select(*by, F.explode(F.array(entry(DAY, "date", "ba_spread"), entry(PROVIDER, "prov"))).alias("e"))
    return rows.select(*by, "e.*").groupBy(*by, "entry", *kinds).agg(F.count(F.lit(1)).alias("rows"))


def quote_profile(histogram: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Per bond: providers_cnt, qdays_cnt (A3, A4) and the most distinct spreads of a day."""
    entries = histogram.groupBy(*by, "entry", "date", "prov").agg(F.count(F.lit(1)).alias("n"))
    day = F.col("entry") == DAY
    return entries.groupBy(*by).agg(
        F.count(F.when(~day, F.lit(1))).cast("bigint").alias("providers_cnt"),
        F.count(F.when(day, F.lit(1))).cast("bigint").alias("qdays_cnt"),
        F.max(F.when(day, F.col("n"))).alias("max_day_values"),
    )


def kept_profile(profile: DataFrame, **bounds) -> tuple[DataFrame, dict]:
    """Checkpoint a per-bond profile and observe ``bounds`` (name -> max of a
    column) in the same job (``DataFrame.observe``: no second job for them)."""
    obs = Observation("profile bounds")
    kept = materialize(profile.observe(obs, *[F.max(c).alias(name) for name, c in bounds.items()]))
    return kept, {k: int(v or 0) for k, v in obs.get.items()}


def day_medians(spread_rows: DataFrame, method: str = "exact", bound: int | None = None, by: Sequence[str] = BY,
                count: str | None = None) -> DataFrame:
    """A1: (bond, date, median_of_tgs) over every quote row of the day."""
    return lower_median(spread_rows, [*by, "date"], "ba_spread", "median_of_tgs",
                        method=method, max_group_rows=bound, count=count)


def median_of_medians(day: DataFrame, method: str = "exact", bound: int | None = None, by: Sequence[str] = BY) -> DataFrame:
    """A2: (bond, bid_ask_spread_relative_median) over the day medians."""
    return lower_median(day, list(by), "median_of_tgs", "bid_ask_spread_relative_median",
                        method=method, max_group_rows=bound)


def quote_metrics(
    quotes: DataFrame,
    bonds: DataFrame,
    *,
    median_method: str = "exact",
    on_null: str = "raise",
    rejects: str | None = None,
    name: str = "metrics",
    hot_rows: int = HOT_GROUP_ROWS,
    also: Sequence[str] = (),
) -> DataFrame:
    """(id, isin, bid_ask_spread_relative_median, providers_cnt, qdays_cnt).

    The quotes are read once, into a kept histogram; the counts, the group sizes that choose
    the median plans, and both median levels read that. It is removed when the metrics (one row
    per bond) are kept.

    ``on_null``: a bond whose every mid is zero has no median; ``raise`` fails
    the job (the production schema says non-null), ``reject`` drops the bond and, if
    ``rejects`` names a folder, writes it there. ``also``: further columns that identify a
    bond (the anchor date where several run as one plan).
    """
    by = (*also, "bond")
    s = spreads(quotes, by)
    histogram = staged(quote_histogram(s, by), name.replace(" ", "-"), by=["entry"])
    profile, b = kept_profile(quote_profile(histogram, by), values="max_day_values", days="qdays_cnt")
    days = histogram.where(F.col("entry") == DAY)
    if median_method in ("approx", "aggregate"):  # these take single rows: a second pass over the quotes
        day = day_medians(s, median_method, by=by)
        med = median_of_medians(day, median_method, by=by)
    else:
        day = day_medians(days, _plan(median_method, b["values"], hot_rows), b["values"], by, "rows")
        med = median_of_medians(day, _plan(median_method, b["days"], hot_rows), b["days"], by)
    out = _finish(bonds, profile.select(*by, "providers_cnt", "qdays_cnt"), med, on_null, name, rejects, also)
    unstage(histogram)
    return out


def _plan(method: str, largest: int, hot_rows: int) -> str:
    """``exact``: by the largest group of the level (both plans are exact)."""
    if method != "exact":
        return method
    return "window" if largest <= hot_rows else "split"


def market_schema(bonds: DataFrame, also: Sequence[str]) -> T.StructType:
    return T.StructType([*[T.StructField(c, bonds.schema[c].dataType, False) for c in also], *schemas.MARKET_METRICS.fields])


def _finish(bonds: DataFrame, cnt: DataFrame, med: DataFrame, on_null: str, name: str, rejects: str | None,
            also: Sequence[str]) -> DataFrame:
    """J3 + J4 + P3: bonds with counts (every quoted bond) and medians, kept."""
    key = [*also, "id"]
    joined = (
        bonds.select(*key, "isin")
        .join(cnt.withColumnRenamed("bond", "id"), key, "inner")
        .join(med.withColumnRenamed("bond", "id"), key, "left")
        .select(*key, "isin", "bid_ask_spread_relative_median", "providers_cnt", "qdays_cnt")
    )
    joined = materialize(joined)
    schema = market_schema(bonds, also)
    if on_null == "reject":
        good, bad = split_rejects(joined, schema)
        if rejects:
            bad.write.mode("overwrite").parquet(rejects)
        return good
    return enforce(joined, schema, name)


def _restrict(quotes: DataFrame, bonds: DataFrame, listing: str, also: Sequence[str] = ()) -> DataFrame:
    """J1 early (broadcast of a counted list, or of a Bloom filter of bounded size) or
    late (see ``listing_plan``)."""
    plan = listing_plan(bonds) if listing == "auto" else listing
    if plan == "early":
        return listed(quotes, bonds, broadcast=True, also=also)
    if plan == "join":  # the literal J1 join, planner's choice of strategy
        return listed(quotes, bonds, also=also)
    if plan == "bloom":
        return maybe_listed(quotes, bonds, also)
    return quotes


def exchange_quotes(raw: DataFrame, bonds: DataFrame, listing: str = "join", also: Sequence[str] = ()) -> DataFrame:
    """Strict exchange quotes of listed bonds
    (``listing`` "late" and "bloom" leave J1 to the per-bond join of the metrics)."""
    return strict_quotes(_restrict(exchange_clean(raw, also=also), bonds, listing, also), "exchange quotes", also)


def otc_listed(raw: DataFrame, bonds: DataFrame, listing: str = "join", also: Sequence[str] = ()) -> DataFrame:
    """OTC quotes of listed bonds."""
    return _restrict(otc_clean(raw, also=also), bonds, listing, also)


def otc_listed_sides(raw: DataFrame, bonds: DataFrame, listing: str = "join") -> tuple[DataFrame, DataFrame]:
    """(bids, asks) of listed bonds."""
    return otc_sides(otc_listed(raw, bonds, listing))


def otc_quotes(raw: DataFrame, bonds: DataFrame) -> DataFrame:
    """The literal paired OTC quotes (bid x ask rows)."""
    bids, asks = otc_listed_sides(raw, bonds)
    return strict_quotes(pair_sides(bids, asks), "otc quotes")


def price_histogram(quotes: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """(bond, prov, date, quote_type, price, w), how often each price was quoted on each
    side; codes of neither side vanish."""
    sides = quotes.where(F.col("quote_type").isin(BID, ASK))
    return sides.groupBy(*key_of(by), "quote_type", "price").agg(F.count(F.lit(1)).alias("w"))


def two_sided_metrics(
    quotes: DataFrame,
    bonds: DataFrame,
    *,
    median_method: str = "exact",
    on_null: str = "raise",
    rejects: str | None = None,
    name: str = "otc metrics",
    pair_cap: int = PAIR_CAP,
    hot_rows: int = HOT_GROUP_ROWS,
    also: Sequence[str] = (),
) -> DataFrame:
    """C2 over the bid x ask pairs of (bond, prov, date, quote_type, price) rows, without
    listing them.

    The quotes are read once, into a kept histogram of both sides. The key statistics, the
    per-bond profile (providers and days over keys present on both sides), the day medians and
    every bracket round read that.
    """
    by = (*also, "bond")
    histogram = staged(price_histogram(quotes, by), name.replace(" ", "-"), by=["quote_type"])
    bids_v, asks_v = [histogram.where(F.col("quote_type") == side).select(*key_of(by), F.col("price").alias(value), "w")
                      for side, value in ((BID, "bid"), (ASK, "ask"))]
    keys, groups = pair_stats(bids_v, asks_v, by)
    profile, b = kept_profile(pair_profile(keys, groups, by, pair_cap), d="max_day_pairs", n="max_day_weighted_pairs",
                              days="qdays_cnt", in_task="in_task", over_ranges="over_ranges")
    day = day_medians_from_values(bids_v, asks_v, groups, b["d"], "median_of_tgs", largest_day_weighted_pairs=b["n"],
                                  pair_cap=pair_cap, paths=(bool(b["in_task"]), bool(b["over_ranges"])), by=by)
    med = median_of_medians(day, _plan(median_method, b["days"], hot_rows), b["days"], by)
    out = _finish(bonds, profile.select(*by, "providers_cnt", "qdays_cnt"), med, on_null, name, rejects, also)
    unstage(histogram)
    return out


def paired_quote_metrics(bids: DataFrame, asks: DataFrame, bonds: DataFrame, **kw) -> DataFrame:
    """``two_sided_metrics`` of separate sides."""
    keys = ["bond", "prov", "date"]
    rows = [side.select(*keys, F.lit(code).alias("quote_type"), F.col(value).alias("price"))
            for side, code, value in ((bids, BID, "bid"), (asks, ASK, "ask"))]
    return two_sided_metrics(rows[0].unionByName(rows[1]), bonds, **kw)


def exchange_metrics(raw: DataFrame, bonds: DataFrame, listing: str = "auto", **kw) -> DataFrame:
    """C3. ``listing``: ``auto`` (count the bond list, see ``listing_plan``), ``early``,
    ``bloom``, ``late`` or ``join``."""
    return quote_metrics(exchange_quotes(raw, bonds, listing, kw.get("also", ())), bonds, name="exchange metrics", **kw)


def otc_metrics(raw: DataFrame, bonds: DataFrame, listing: str = "auto", **kw) -> DataFrame:
    """C4 (``listing`` as for ``exchange_metrics``)."""
    return two_sided_metrics(otc_listed(raw, bonds, listing, kw.get("also", ())), bonds, **kw)

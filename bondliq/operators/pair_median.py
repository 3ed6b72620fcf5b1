"""J2 + A1 for OTC quotes: per-day lower median of the relative spread over
every bid x ask pair of a (bond, provider, day), without listing all pairs.

The production rule pairs k bids with m asks of a key (k * m quotes) and takes
the lower median of their spreads per (bond, day) across providers. Listing
k * m rows is quadratic for a large key, so each side is reduced to distinct
values with multiplicities (map-side partial aggregation; a pair of distinct
values weighs w_bid * w_ask), and every day is solved in the way that is
cheapest for it:

1. *Listed*: a day with at most ``LIST_FACTOR`` times as many distinct value
   pairs as distinct values (and at most ``pair_cap``) lists its pairs and takes
   a weighted lower median. So the pair join never makes more than that multiple
   of the values it reads, however many such days there are.
2. *Ranked in a task*: a day with more pairs whose values fit in one task (most
   of the days between) is solved by rank selection on sorted sides: for positive
   prices the spread grows with the ratio ask / bid, so the k-th pair is found by
   narrowing a ratio bracket. Each round puts ``thresholds`` cut points inside
   the bracket and counts, for every bid b, the asks a <= b * t of its key by a
   running sum over the key's sorted asks and probes; the bracket holding rank
   ceil(n/2) is kept. All such days narrow their brackets in the same rounds.
3. *Ranked over keys*: a day whose values do not fit in one task is cut by its keys. The
   sorted sides of a key of at most ``KEY_VALUES`` values are kept as one row, and each round
   counts every key by binary search (``_counted``), so a round moves only its counts.
4. *Ranked over ranges*: for the larger keys of such a day, and where counts or prices are
   not plain numbers, the same running sums are taken over a range split
   (``cumulative_within``).

When a bracket holds at most as many distinct pairs as the day might have listed,
only those pairs are listed (by ask position per bid) and the remaining rank is
selected among them. A bracket whose bounds are adjacent doubles ends too: each
bid meets only a few distinct asks in it.

Ratio and computed spread order pairs alike up to rounding, so the last bracket is
widened on both sides by more than the rounding can move a pair (``_margin``). Pairs
below it are certainly not above the median, pairs beyond it not below; those inside
are listed, added up by computed spread, and the median is chosen among these values.
The answer is the one that listing every pair gives, bit for bit, at every size.

``by`` names the columns that identify a bond (with the anchor date where several
anchor dates run as one plan).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bondliq.functions.spread import relative_spread
from bondliq.operators.cumulative import cumulative_within
from bondliq.session import let_workers_import, materialize

# Distinct bid x ask value pairs of one day group listed at once, at most, and
# as a multiple of the day's distinct bids and asks.
PAIR_CAP = 1_000_000
LIST_FACTOR = 16
THRESHOLDS = 16
# Sorted asks and probes of one day that a task ranks.
HOT_DAY_ROWS = 1_000_000
# Distinct values of a key that are kept in one row, and of such rows in one partition.
KEY_VALUES, PART_VALUES = 20_000, 500_000

BY = ("bond",)


def group_of(by: Sequence[str]) -> list[str]:
    return [*by, "date"]


def key_of(by: Sequence[str]) -> list[str]:
    return [*by, "prov", "date"]

# Pair counts are products of side counts: past 9.2e18 a long overflows (an
# error under ANSI). The day statistics are summed in decimal(38,0); the
# per-pair arithmetic uses a long when the largest day has fewer pairs than
# LONG_SAFE_PAIRS (measured by the sizing job), else the exact decimal.
WIDE_COUNT = "decimal(38,0)"
LONG_SAFE_PAIRS = 2**62


def count_type(largest_day_weighted_pairs) -> str:
    return "bigint" if int(largest_day_weighted_pairs or 0) < LONG_SAFE_PAIRS else WIDE_COUNT


def _pairs(a, b, kind: str = WIDE_COUNT):
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return a.cast(kind) * b.cast(kind)


def side_values(side: DataFrame, value: str, by: Sequence[str] = BY) -> DataFrame:
    """(bond, prov, date, value, w): distinct values with their row counts."""
    return side.groupBy(*key_of(by), value).agg(F.count(F.lit(1)).alias("w"))


def pair_stats(bids_v: DataFrame, asks_v: DataFrame, by: Sequence[str] = BY) -> tuple[DataFrame, DataFrame]:
    """Per paired key (k, m, distinct counts, extremes) and per day group
    (n pairs, d distinct pairs, v distinct values, ratio bounds)."""
    KEY, GROUP = key_of(by), group_of(by)
    kb = bids_v.groupBy(*KEY).agg(
        F.sum("w").alias("k"), F.count(F.lit(1)).alias("kd"), F.min("bid").alias("bmin"), F.max("bid").alias("bmax")
    )
    ka = asks_v.groupBy(*KEY).agg(
        F.sum("w").alias("m"), F.count(F.lit(1)).alias("md"), F.min("ask").alias("amin"), F.max("ask").alias("amax")
    )
    keys = kb.join(ka, KEY, "inner")
    groups = keys.groupBy(*GROUP).agg(
        F.sum(_pairs("k", "m")).alias("n"),
        F.sum(_pairs("kd", "md")).alias("d"),
        F.sum(F.col("kd") + F.col("md")).alias("v"),
        F.min(F.col("amin") / F.col("bmax")).alias("rmin"),
        F.max(F.col("amax") / F.col("bmin")).alias("rmax"),
    )
    return keys, groups


def weighted_lower_median(
    df: DataFrame, keys: Sequence[str], value: str, weight: str, alias: str, rank: str | None = None
) -> DataFrame:
    """Element at weighted rank ceil(total / 2) (or at column ``rank``) per group.

    A window over each group: only for groups of bounded size.
    """
    keys = list(keys)
    w = Window.partitionBy(*keys)
    run = w.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum(weight).over(w)
    exact = isinstance(df.schema[weight].dataType, T.LongType)  # long division stays exact past 2^53
    half = F.shiftright(total, 1) + F.pmod(total, F.lit(2)) if exact else F.floor((total + 1) / 2)
    target = F.col(rank) if rank else half
    x = df.select(*keys, value, weight, *([rank] if rank else [])).select(
        "*", F.sum(weight).over(run).alias("_cum"), target.alias("_r")
    )
    hit = (F.col("_cum") >= F.col("_r")) & (F.col("_cum") - F.col(weight) < F.col("_r"))
    return x.where(hit).select(*keys, F.col(value).alias(alias))


def list_cap(pair_cap: int):
    """Distinct pairs that a day may list, from its distinct values ``v``."""
    return F.least(F.lit(pair_cap).cast("long"), F.col("v") * LIST_FACTOR)


def day_path(pair_cap: int, hot_rows: int, thresholds: int = THRESHOLDS):
    """How a day is solved: 0 listed, 1 ranked in a task, 2 ranked over ranges."""
    return F.when(F.col("d") <= list_cap(pair_cap), 0).when(F.col("v") * thresholds <= hot_rows, 1).otherwise(2)


def _light(bids_v: DataFrame, asks_v: DataFrame, alias: str, kind: str, by: Sequence[str]) -> DataFrame:
    KEY, GROUP = key_of(by), group_of(by)
    b = bids_v.withColumnRenamed("w", "wb")
    a = asks_v.withColumnRenamed("w", "wa")
    pairs = b.join(a, KEY, "inner")
    spreads = pairs.select(*GROUP, relative_spread("bid", "ask").alias("_s"), _pairs("wb", "wa", kind).alias("_w"))
    return weighted_lower_median(spreads, GROUP, "_s", "_w", alias)


def _margin(t):
    """Share of a ratio ``t`` that covers the rounding of a cut point's product and of
    a computed spread: the spread (t - 1) / (t + 1) * 2 has an error of a few units in
    the last place, which moves the ratio by (t - 1)(t + 1) / 2 times that."""
    return F.lit(2.0 ** -48) * (1 + t + 1 / t)


def _lookup(u: DataFrame, key: Sequence[str], over_ranges: bool, parts: int | None) -> DataFrame:
    """Per probe (and per ask), cumulative ask weight ``cum__aw`` and ask count
    ``cum__ad`` of its key up to its value (asks first on equal values)."""
    if over_ranges:
        return cumulative_within(u, key, ["_x", "_kind"], ["_aw", "_ad"], partitions=parts)
    run = Window.partitionBy(*key).orderBy("_x", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # an exchange of its own: a union whose sides happen to be dealt alike claims that dealing,
    # which adaptive execution may change on one side
    return u.repartition(*key).select("*", F.sum("_aw").over(run).alias("cum__aw"), F.sum("_ad").over(run).alias("cum__ad"))


def _arrays(column, null: float | int) -> list[np.ndarray]:
    """The lists of an Arrow column."""
    flat = column.flatten().fill_null(null).to_numpy(zero_copy_only=False)
    return np.split(flat, np.cumsum(column.value_lengths().to_numpy())[:-1])


def _sides(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per key: bids, their weights, ascending asks, and the ask weight before each of them and
    after the last. A null price stands below all others, as in a sort."""
    columns = [_arrays(batch.column(c), null) for c, null in (("_bids", -np.inf), ("_bws", 0), ("_asks", -np.inf), ("_aws", 0))]
    for bids, bw, asks, aw in zip(*columns):
        yield bids, bw, asks, np.concatenate([[0], np.cumsum(aw)])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per key and cut point ``_ts``: pairs up to it, with and without repeats."""
    for batch in (b for b in batches if b.num_rows):
        c, d = [], []
        for (bids, bw, asks, cum), ts in zip(_sides(batch), _arrays(batch.column("_ts"), np.nan)):
            at = np.searchsorted(asks, bids[:, None] * ts, side="right")
            c.append(bw @ cum[at])
            d.append(at.sum(0))
        rest = batch.drop_columns(["_bids", "_bws", "_asks", "_aws"])
        yield rest.append_column("_c", pa.array(c, pa.list_(pa.int64()))).append_column("_d", pa.array(d, pa.list_(pa.int64())))


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per key: pairs up to ``lo``, and the pairs (bid, ask, weight) in (lo, hi]."""
    for batch in (b for b in batches if b.num_rows):
        below, found = [], ([], [], [])
        ends = [batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("lo", "hi")]
        for (bids, bw, asks, cum), lo, hi in zip(_sides(batch), *ends):
            first, last = (np.searchsorted(asks, bids * t, side="right") for t in (lo, hi))
            below.append(int(bw @ cum[first]))
            many = np.maximum(last - first, 0)
            b = np.repeat(np.arange(len(bids)), many)
            a = np.arange(many.sum()) + np.repeat(first - np.cumsum(many) + many, many)
            for out, x in zip(found, (bids[b], asks[a], bw[b] * np.diff(cum)[a])):
                out.append(x)
        rest = batch.drop_columns(["_bids", "_bws", "_asks", "_aws", "lo", "hi"]).append_column("_c", pa.array(below, pa.int64()))
        for name, x, kind in zip(("_b", "_a", "_w"), found, (pa.float64(), pa.float64(), pa.int64())):
            rest = rest.append_column(name, pa.array(x, pa.list_(kind)))
        yield rest


def _by_key(bids: DataFrame, asks: DataFrame, KEY: Sequence[str]) -> tuple[DataFrame | None, DataFrame | None]:
    """Of ``bids`` (KEY, bid, _bw) and ``asks`` (KEY, _x, _aw): one kept row (KEY, _bids, _bws,
    _asks, _aws) for each key of both sides that is small enough, and the larger keys; None for
    none of a kind."""
    rows = bids.select(*KEY, F.lit(True).alias("_side"), F.col("bid").alias("x"), F.col("_bw").alias("w")).unionByName(
        asks.select(*KEY, F.lit(False).alias("_side"), F.col("_x").alias("x"), F.col("_aw").alias("w"))).dropna(subset=list(KEY))
    sizes = rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
    obs = Observation("key sizes")
    small = F.col("n") <= KEY_VALUES
    large = materialize(sizes.observe(obs, F.sum(F.when(small, F.col("n"))).alias("values"),
                                      F.count(F.when(~small, F.lit(1))).alias("large")).where(~small).select(*KEY))
    values, many = obs.get["values"] or 0, obs.get["large"]
    if not values:
        return None, large if many else None
    if many:  # at most one in KEY_VALUES of the values
        rows = rows.join(F.broadcast(large), list(KEY), "left_anti")
    side = [F.array_sort(F.collect_list(F.when(c, F.struct("x", "w")))).alias(name) for c, name in ((F.col("_side"), "b"), (~F.col("_side"), "a"))]
    sides = rows.repartition(-(-int(values) // PART_VALUES), *KEY).groupBy(*KEY).agg(*side).where("size(a) > 0 and size(b) > 0")
    # a checkpoint keeps the partitions, so a batch of rows stays small
    kept = materialize(sides.select(*KEY, F.col("b.x").alias("_bids"), F.col("b.w").alias("_bws"), F.col("a.x").alias("_asks"), F.col("a.w").alias("_aws")))
    return kept, large if many else None


def _in_arrow(frame: DataFrame, run, drop: Sequence[str], added: str) -> DataFrame:
    let_workers_import(frame.sparkSession)
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema if f.name not in drop], added])
    return frame.mapInArrow(run, schema)


def _met_by_lookup(bh: DataFrame, asks_u: DataFrame, bounds: DataFrame, KEY: Sequence[str], GROUP: Sequence[str], kind: str,
                   over_ranges: bool, parts: int | None) -> tuple[DataFrame, DataFrame]:
    """Per day the pairs up to ``lo``, and the pairs (bid, ask, weight) in (lo, hi], by ask positions."""
    ends = bh.join(bounds, GROUP)
    probes = ends.select(*KEY, (F.col("bid") * F.col("lo")).alias("_x"), F.lit(1).alias("_kind"),
                         F.lit(0).cast("long").alias("_aw"), F.lit(0).cast("long").alias("_ad"),
                         "bid", "_bw", F.lit("lo").alias("_end")).unionByName(
        ends.select(*KEY, (F.col("bid") * F.col("hi")).alias("_x"), F.lit(1).alias("_kind"),
                    F.lit(0).cast("long").alias("_aw"), F.lit(0).cast("long").alias("_ad"),
                    "bid", "_bw", F.lit("hi").alias("_end")))
    looked = _lookup(asks_u.unionByName(probes, allowMissingColumns=True), KEY, over_ranges, parts)
    asks_pos = looked.where(F.col("_kind") == 0).select(*KEY, F.col("_x").alias("ask"), F.col("_aw").alias("_aw"),
                                                        F.col("cum__ad").alias("_pos"))
    ends = looked.where(F.col("_kind") == 1)
    per_bid = ends.groupBy(*KEY, "bid", "_bw").agg(
        F.max(F.when(F.col("_end") == "lo", F.col("cum__ad"))).alias("_plo"),
        F.max(F.when(F.col("_end") == "hi", F.col("cum__ad"))).alias("_phi"),
        F.max(F.when(F.col("_end") == "lo", F.col("cum__aw"))).alias("_wlo"),
    )
    c_lo = per_bid.groupBy(*GROUP).agg(F.sum(_pairs("_bw", "_wlo", kind)).alias("c_lo"))
    spans = per_bid.where(F.col("_phi") > F.col("_plo"))
    # as many distinct pairs as the day might have listed, or a few asks to each bid
    listed = spans.select(
        *KEY, "bid", "_bw", F.explode(F.sequence(F.col("_plo") + 1, F.col("_phi"))).alias("_pos")
    ).join(asks_pos, [*KEY, "_pos"])
    pairs = listed.select(*GROUP, "bid", "ask", _pairs("_bw", "_aw", kind).alias("_w"))
    return c_lo, pairs


def _union(a: DataFrame | None, b: DataFrame | None) -> DataFrame:
    return a.unionByName(b) if a is not None and b is not None else b if a is None else a


def _ranked(bids_v: DataFrame, asks_v: DataFrame, groups: DataFrame, alias: str, *, pair_cap: int, thresholds: int,
            parts: int | None, kind: str, by: Sequence[str], over_ranges: bool) -> DataFrame:
    KEY, GROUP = key_of(by), group_of(by)
    groups = materialize(groups)  # every round needs them
    gsel = groups.select(*GROUP)
    bh = bids_v.join(gsel, GROUP, "left_semi").select(*KEY, "bid", F.col("w").alias("_bw"))
    asks_u = asks_v.join(gsel, GROUP, "left_semi").select(
        *KEY, F.col("ask").alias("_x"), F.lit(0).alias("_kind"), F.col("w").alias("_aw"),
        F.lit(1).cast("long").alias("_ad"),
    )
    # ``small`` keys are counted in place, those that are left in ``bh`` and ``asks_u`` by lookups
    plain = kind == "bigint" and all(f[c].dataType == T.DoubleType() for f, c in ((bh.schema, "bid"), (asks_u.schema, "_x")))
    small, lookups = None, True
    if over_ranges and plain:
        small, large = _by_key(bh, asks_u, KEY)
        lookups = large is not None
        if lookups and small is not None:
            bh, asks_u = (x.join(F.broadcast(large), KEY, "left_semi") for x in (bh, asks_u))
    open_cond = (F.col("d_hi") - F.col("d_lo") > F.col("cap")) & ~F.col("stuck")

    def keep(frame: DataFrame) -> tuple[DataFrame, int]:
        # checkpoint the state and count the open brackets in the same job
        obs = Observation("open brackets")
        kept = materialize(frame.observe(obs, F.count(F.when(open_cond, F.lit(1))).alias("open")))
        return kept, int(obs.get["open"] or 0)

    def by_lookup(cuts: DataFrame) -> DataFrame:
        probes = bh.join(cuts, GROUP).select(
            *KEY, (F.col("bid") * F.col("_t")).alias("_x"), F.lit(1).alias("_kind"),
            F.lit(0).cast("long").alias("_aw"), F.lit(0).cast("long").alias("_ad"), "_bw", "_j", "_t",
        )
        looked = _lookup(asks_u.unionByName(probes, allowMissingColumns=True), KEY, over_ranges, parts).where(F.col("_kind") == 1)
        return looked.groupBy(*GROUP, "_j", "_t").agg(
            F.sum(_pairs("_bw", "cum__aw", kind)).alias("_c"), F.sum(F.col("cum__ad").cast(WIDE_COUNT)).alias("_d")
        )

    def in_place(cuts: DataFrame) -> DataFrame:
        points = cuts.groupBy(*GROUP).agg(F.array_sort(F.collect_list(F.struct("_j", "_t"))).alias("_cuts"))
        points = points.select(*GROUP, F.col("_cuts._j").alias("_js"), F.col("_cuts._t").alias("_ts"))
        counted = _in_arrow(small.join(F.broadcast(points), GROUP), _counted, ["_bids", "_bws", "_asks", "_aws"], "_c array<bigint>, _d array<bigint>")
        each = counted.select(*GROUP, F.explode(F.arrays_zip("_js", "_ts", "_c", "_d")).alias("e"))
        return each.select(*GROUP, F.col("e._js").alias("_j"), F.col("e._ts").alias("_t"),
                           F.col("e._c").alias("_c"), F.col("e._d").cast(WIDE_COUNT).alias("_d"))

    # bracket (lo, hi] in ratio space with c(lo) = 0 and c(hi) = n
    state, still_open = keep(groups.select(
        *GROUP, list_cap(pair_cap).cast(WIDE_COUNT).alias("cap"), F.floor((F.col("n") + 1) / 2).alias("r"),
        (F.col("rmin") / 2).alias("lo"), (F.col("rmax") * 2).alias("hi"),
        F.lit(0).cast(WIDE_COUNT).alias("d_lo"), F.col("d").alias("d_hi"), F.lit(False).alias("stuck"),
    ))
    while still_open:  # each round narrows a bracket or finds that it cannot be split
        active = state.where(open_cond)
        cuts = active.select(
            *GROUP, "lo", "hi", F.explode(F.sequence(F.lit(1), F.lit(thresholds - 1))).alias("_j")
        ).select(*GROUP, "_j", (F.col("lo") * F.pow(F.col("hi") / F.col("lo"), F.col("_j") / thresholds)).alias("_t"))
        # cut points can round to one value near the end: count each apart
        counts = _union(by_lookup(cuts) if lookups else None, in_place(cuts) if small is not None else None)
        counts = counts.groupBy(*GROUP, "_j", "_t").agg(F.sum("_c").alias("_c"), F.sum("_d").alias("_d"))
        with_r = counts.join(state.select(*GROUP, "r"), GROUP)
        below = with_r.where(F.col("_c") < F.col("r")).groupBy(*GROUP).agg(
            F.max_by(F.struct(F.col("_t").alias("t"), F.col("_d").alias("d")), F.col("_t")).alias("b"))
        above = with_r.where(F.col("_c") >= F.col("r")).groupBy(*GROUP).agg(
            F.min_by(F.struct(F.col("_t").alias("t"), F.col("_d").alias("d")), F.col("_t")).alias("a"))
        nxt = (
            state.join(below, GROUP, "left").join(above, GROUP, "left")
            .select(
                *GROUP, "cap", "r",
                F.coalesce(F.col("b.t"), F.col("lo")).alias("lo"), F.coalesce(F.col("a.t"), F.col("hi")).alias("hi"),
                F.coalesce(F.col("b.d"), F.col("d_lo")).alias("d_lo"), F.coalesce(F.col("a.d"), F.col("d_hi")).alias("d_hi"),
                "stuck", F.col("lo").alias("_lo0"), F.col("hi").alias("_hi0"), open_cond.alias("_was_open"),
            )
        )
        # an open bracket that no cut point split cannot be split further
        # (settled brackets get no cuts and keep their bounds: not stuck)
        unchanged = (F.col("lo") == F.col("_lo0")) & (F.col("hi") == F.col("_hi0"))
        nxt = nxt.withColumn("stuck", F.col("stuck") | (F.col("_was_open") & unchanged)).drop(
            "_lo0", "_hi0", "_was_open"
        )
        state, still_open = keep(nxt)

    # final pass: the pairs of each widened bracket (lo, hi]
    lo, hi = F.col("lo"), F.col("hi")
    bounds = state.select(*GROUP, (lo * (1 - _margin(lo))).alias("lo"), (hi * (1 + _margin(hi))).alias("hi"))
    c_lo = pairs = None
    if lookups:
        c_lo, pairs = _met_by_lookup(bh, asks_u, bounds, KEY, GROUP, kind, over_ranges, parts)
    if small is not None:
        met = materialize(_in_arrow(small.join(F.broadcast(bounds), GROUP), _met, ["_bids", "_bws", "_asks", "_aws", "lo", "hi"],
                                    "_c bigint, _b array<double>, _a array<double>, _w array<bigint>"))
        each = met.select(*GROUP, F.explode(F.arrays_zip("_b", "_a", "_w")).alias("e"))
        pairs = _union(pairs, each.select(*GROUP, F.col("e._b").alias("bid"), F.col("e._a").alias("ask"), F.col("e._w").alias("_w")))
        c_lo = _union(c_lo, met.groupBy(*GROUP).agg(F.sum("_c").alias("c_lo"))).groupBy(*GROUP).agg(F.sum("c_lo").alias("c_lo"))
    cand = pairs.select(*GROUP, relative_spread("bid", "ask").alias("_s"), "_w")
    cand = cand.groupBy(*GROUP, "_s").agg(F.sum("_w").cast(kind).alias("_w"))
    rank = state.select(*GROUP, "r").join(c_lo, GROUP).select(*GROUP, (F.col("r") - F.col("c_lo")).alias("_rr"))
    return weighted_lower_median(cand.join(rank, GROUP), GROUP, "_s", "_w", alias, rank="_rr")


def pair_profile(keys: DataFrame, groups: DataFrame, by: Sequence[str] = BY, pair_cap: int = PAIR_CAP,
                 hot_rows: int = HOT_DAY_ROWS) -> DataFrame:
    """Per bond: providers_cnt and qdays_cnt over keys present on both sides
    (A3, A4), the largest pair count of one of its days, and the most elaborate
    way that one of its days needs (``day_path``)."""
    path = day_path(pair_cap, hot_rows)
    per_day = groups.groupBy(*by).agg(
        F.count(F.lit(1)).cast("bigint").alias("qdays_cnt"), F.max("d").alias("max_day_pairs"),
        F.max("n").alias("max_day_weighted_pairs"),
        F.max(F.when(path == 1, 1).otherwise(0)).alias("in_task"), F.max(F.when(path == 2, 1).otherwise(0)).alias("over_ranges"),
    )
    # the distinct-value counts keep this branch on the shared side-value
    # aggregations; a branch that only counted keys would be rewritten into its own pass
    per_prov = keys.groupBy(*by, "prov").agg(
        F.sum(_pairs("kd", "md")).alias("d"), F.sum(_pairs("k", "m")).alias("n")
    ).groupBy(*by).agg(
        F.count(F.lit(1)).cast("bigint").alias("providers_cnt"), F.max("d").alias("max_prov_pairs"),
        F.max("n").alias("max_prov_weighted_pairs"),
    )
    return per_day.join(per_prov, list(by))


def day_medians_from_values(
    bids_v: DataFrame,
    asks_v: DataFrame,
    groups: DataFrame,
    largest_day_pairs: int,
    alias: str = "median_of_tgs",
    *,
    largest_day_weighted_pairs: int | None = None,
    pair_cap: int = PAIR_CAP,
    thresholds: int = THRESHOLDS,
    partitions: int | None = None,
    hot_rows: int = HOT_DAY_ROWS,
    paths: tuple[bool, bool] | None = None,
    by: Sequence[str] = BY,
) -> DataFrame:
    """Day medians from side values and day stats (see ``pair_spread_medians``).

    ``largest_day_pairs``: most distinct value pairs of a day; ``largest_day_weighted_pairs``:
    most pairs of a day counting repeats (chooses long or decimal counts; unknown means
    decimal); ``paths``: whether some day is ranked in a task, and some over ranges (unknown:
    one small aggregation over the day stats).
    """
    kind = WIDE_COUNT if largest_day_weighted_pairs is None else count_type(largest_day_weighted_pairs)
    group = group_of(by)
    path = day_path(pair_cap, hot_rows, thresholds)
    if paths is None:
        paths = (False, False)
        if largest_day_pairs > min(pair_cap, 2 * LIST_FACTOR):  # no day has fewer than two values
            row = groups.agg(F.max(F.when(path == 1, 1)).alias("a"), F.max(F.when(path == 2, 1)).alias("b")).first()
            paths = (bool(row["a"]), bool(row["b"]))
    if not any(paths):
        return _light(bids_v, asks_v, alias, kind, by)
    # both sides drop the other days before the pair join, so a large day never
    # reaches that shuffle (anti join: broadcast when small, else skew-split)
    large = groups.where(path > 0).select(*group)
    out = _light(bids_v.join(large, group, "left_anti"), asks_v.join(large, group, "left_anti"), alias, kind, by)
    for over_ranges, found in enumerate(paths):
        if found:
            out = out.unionByName(_ranked(bids_v, asks_v, groups.where(path == over_ranges + 1), alias, pair_cap=pair_cap,
                                          thresholds=thresholds, parts=partitions, kind=kind, by=by, over_ranges=bool(over_ranges)))
    return out


def pair_spread_medians(
    bids: DataFrame,
    asks: DataFrame,
    alias: str = "median_of_tgs",
    *,
    pair_cap: int = PAIR_CAP,
    thresholds: int = THRESHOLDS,
    partitions: int | None = None,
    hot_rows: int = HOT_DAY_ROWS,
) -> DataFrame:
    """(bond, date, ``alias``) over all bid x ask pairs of each day.

    ``bids``: (bond, prov, date, bid), ``asks``: (bond, prov, date, ask),
    prices > 0 (OTC cleaning guarantees it). The side values are kept, so each side is
    read once whatever the number of rounds; one small job sizes the days.
    """
    bids_v, asks_v = materialize(side_values(bids, "bid")), materialize(side_values(asks, "ask"))
    groups = materialize(pair_stats(bids_v, asks_v)[1])
    path = day_path(pair_cap, hot_rows, thresholds)
    row = groups.agg(F.max("d").alias("d"), F.max("n").alias("n"), F.max(F.when(path == 1, 1)).alias("a"),
                     F.max(F.when(path == 2, 1)).alias("b")).first()
    return day_medians_from_values(bids_v, asks_v, groups, row["d"] or 0, alias,
                                   largest_day_weighted_pairs=row["n"] or 0, pair_cap=pair_cap, thresholds=thresholds,
                                   partitions=partitions, hot_rows=hot_rows, paths=(bool(row["a"]), bool(row["b"])))

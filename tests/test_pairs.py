"""OTC pairing: implicit pair medians against listing every pair."""

import math
import random

import pytest

from bondliq.functions.spread import relative_spread
from bondliq.operators.pair_median import pair_spread_medians
from bondliq.operators.pairing import pair_sides


def _spread(b, a):
    return (a - b) / ((a + b) / 2)


def _brute(bids, asks):
    by_key = {}
    for bond, prov, date, b in bids:
        by_key.setdefault((bond, prov, date), ([], []))[0].append(b)
    for bond, prov, date, a in asks:
        by_key.setdefault((bond, prov, date), ([], []))[1].append(a)
    groups = {}
    for (bond, prov, date), (bs, as_) in by_key.items():
        for b in bs:
            for a in as_:
                groups.setdefault((bond, date), []).append(_spread(b, a))
    out = {}
    for g, v in groups.items():
        v.sort()
        out[g] = v[math.ceil(len(v) / 2) - 1]
    return out


def _sides(seed, hot=True):
    rnd = random.Random(seed)
    bids, asks = [], []
    for bond in range(1, 40):
        for date in ("2020-01-01", "2020-01-02"):
            for prov in range(rnd.randint(1, 3)):
                for _ in range(rnd.randint(0, 4)):
                    bids.append((bond, prov, date, round(rnd.uniform(90, 100), 2)))
                for _ in range(rnd.randint(0, 4)):
                    asks.append((bond, prov, date, round(rnd.uniform(95, 110), 2)))
    if hot:
        # one hot key: many bids and asks, with repeated prices (ties)
        for _ in range(400):
            bids.append((7, 0, "2020-01-01", float(rnd.choice([99, 99.5, rnd.uniform(90, 100)]))))
        for _ in range(300):
            asks.append((7, 0, "2020-01-01", float(rnd.choice([101, 100.5, rnd.uniform(99, 112)]))))
        # a second provider the same day
        for _ in range(50):
            bids.append((7, 1, "2020-01-01", rnd.uniform(80, 100)))
            asks.append((7, 1, "2020-01-01", rnd.uniform(100, 120)))
        # all pairs share one ratio: unsplittable bracket
        for _ in range(60):
            bids.append((8, 0, "2020-01-01", 100.0))
            asks.append((8, 0, "2020-01-01", 102.0))
    return bids, asks


def _frames(spark, bids, asks):
    b = spark.createDataFrame(bids, "bond long, prov long, date string, bid double").selectExpr(
        "bond", "prov", "to_date(date) as date", "bid").repartition(5)
    a = spark.createDataFrame(asks, "bond long, prov long, date string, ask double").selectExpr(
        "bond", "prov", "to_date(date) as date", "ask").repartition(5)
    return b, a


@pytest.mark.parametrize("pair_cap", [1_000_000, 500, 40])
def test_pair_medians_match_listing_every_pair(spark, pair_cap):
    bids, asks = _sides(3)
    b, a = _frames(spark, bids, asks)
    got = {(r["bond"], str(r["date"])): r["m"]
           for r in pair_spread_medians(b, a, "m", pair_cap=pair_cap, partitions=7).collect()}
    exp = _brute(bids, asks)
    assert set(got) == set(exp)
    for k in exp:
        assert got[k] == exp[k], k


def test_literal_pairs_list_every_key(spark):
    bids, asks = _sides(4)
    b, a = _frames(spark, bids, asks)
    assert pair_sides(b, a).count() == len(_brute_pairs(bids, asks))


@pytest.mark.parametrize("cap", [5, 500])
def test_bracket_equals_listing_bit_for_bit(spark, cap):
    """Days on which many pairs share a ratio up to rounding, and random prices."""
    import random

    rng = random.Random(cap)
    bids, asks = [], []
    for bond, kind in enumerate(["margin", "two margins", "random", "margin", "two margins"]):
        for prov in range(20):
            for _ in range(1 if bond < 2 else 6):
                b = round(rng.uniform(1, 200), 2) if kind != "random" else rng.uniform(1e-3, 1e3)
                bids.append((bond, prov, "2020-01-01", b))
                asks += [(bond, prov, "2020-01-01", b * x) for x in
                         {"margin": [1.02], "two margins": [1.02, 1.0200000001], "random": [rng.uniform(0.1, 10)]}[kind]]
    b, a = _frames(spark, bids, asks)
    got = {(r["bond"], str(r["date"])): r["m"] for r in pair_spread_medians(b, a, "m", pair_cap=cap, partitions=4).collect()}
    assert got == _brute(bids, asks)


def _brute_pairs(bids, asks):
    out = []
    for bond, prov, date, b in bids:
        for bond2, prov2, date2, a in asks:
            if (bond, prov, date) == (bond2, prov2, date2):
                out.append((bond, prov, date, b, a))
    return out


def test_unsplittable_bracket_of_equal_ratios(spark):
    # bids 100 * 2^i, asks 102 * 2^i: 441 distinct pairs, the median rank falls
    # on the 21 pairs of ratio exactly 1.02, more than the cap of 10
    bids = [(8, 0, "2020-01-01", 100.0 * 2 ** i) for i in range(21)]
    asks = [(8, 0, "2020-01-01", 102.0 * 2 ** i) for i in range(21)]
    b, a = _frames(spark, bids, asks)
    got = pair_spread_medians(b, a, "m", pair_cap=10, partitions=4).collect()
    assert len(got) == 1
    assert got[0]["m"] == _brute(bids, asks)[(8, "2020-01-01")] == 2 / 101


def test_hot_keys_on_table_data_against_duckdb(spark):
    """Two keys holding every lineitem row of sf0.001 (about 6.6 million bid x
    ask pairs): the bracket path, compared with DuckDB listing every pair."""
    import duckdb
    from pyspark.sql import functions as F

    from tests.conftest import SF001

    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    base = li.select(
        F.lit(1).cast("long").alias("bond"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("long").alias("prov"),
        F.lit("2020-01-01").cast("date").alias("date"), "l_extendedprice", "l_discount", "l_tax", "l_linenumber",
    )
    bids = base.where(F.col("l_linenumber") % 2 == 0).select(
        "bond", "prov", "date", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("bid"))
    asks = base.where(F.col("l_linenumber") % 2 == 1).select(
        "bond", "prov", "date", (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("ask"))
    got = pair_spread_medians(bids, asks, "m", pair_cap=10_000).collect()
    exp = duckdb.sql(f"""
        WITH base AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS prov, l_extendedprice,
                        l_discount, l_tax, l_linenumber FROM read_parquet('{SF001}/lineitem.parquet')),
        b AS (SELECT prov, l_extendedprice * (1 - l_discount) AS bid FROM base WHERE l_linenumber % 2 = 0),
        a AS (SELECT prov, l_extendedprice * (1 + l_tax) AS ask FROM base WHERE l_linenumber % 2 = 1)
        SELECT quantile_disc((ask - bid) / ((ask + bid) / 2), 0.5) FROM b JOIN a USING (prov)""").fetchall()[0][0]
    assert len(got) == 1 and got[0]["m"] == exp


def test_split_median_on_table_data(spark):
    """Every dense-view spread of sf0.01 in one group: split plan = window plan."""
    from pyspark.sql import functions as F

    from bondliq.functions.spread import relative_spread
    from bondliq.operators.median import median_split, median_window
    from bondliq.sources.fixtures import exchange_quotes_dense
    from tests.conftest import SF01

    q = exchange_quotes_dense(spark, SF01).select(F.lit(1).alias("g"), relative_spread("bid", "ask").alias("v"))
    a = median_split(q, ["g"], "v", "m").collect()
    b = median_window(q, ["g"], "v", "m").collect()
    assert a == b and len(a) == 1


def test_wide_counts_path_equals_long_path(spark):
    from bondliq.operators import pair_median as pm

    assert pm.count_type(2**62 - 1) == "bigint" and pm.count_type(2**63) == pm.WIDE_COUNT
    bids, asks = _sides(5)
    b, a = _frames(spark, bids, asks)
    bv, av = pm.side_values(b, "bid"), pm.side_values(a, "ask")
    _, groups = pm.pair_stats(bv, av)
    exp = _brute(bids, asks)
    for cap in (1_000_000, 200):
        largest = groups.agg({"d": "max"}).first()[0]
        got = pm.day_medians_from_values(bv, av, groups, largest, "m", largest_day_weighted_pairs=None,
                                         pair_cap=cap, partitions=4).collect()
        assert {(r["bond"], str(r["date"])): r["m"] for r in got} == exp


def test_several_hot_days_on_table_data_against_duckdb(spark):
    """Three hot days (lineitem of sf0.001 split by return flag, three
    providers each) settle in different rounds; each equals DuckDB listing
    every pair."""
    import duckdb
    from pyspark.sql import functions as F

    from tests.conftest import SF001

    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    day = (F.when(F.col("l_returnflag") == "R", "2020-01-01").when(F.col("l_returnflag") == "A", "2020-01-02")
           .otherwise("2020-01-03"))
    base = li.select(F.lit(1).cast("long").alias("bond"), (F.col("l_suppkey") % 3).alias("prov"),
                     day.cast("date").alias("date"), "l_extendedprice", "l_discount", "l_tax", "l_linenumber")
    bids = base.where(F.col("l_linenumber") % 2 == 0).select(
        "bond", "prov", "date", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("bid"))
    asks = base.where(F.col("l_linenumber") % 2 == 1).select(
        "bond", "prov", "date", (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("ask"))
    got = {str(r["date"]): r["m"] for r in pair_spread_medians(bids, asks, "m", pair_cap=5000).collect()}
    exp = dict(duckdb.sql(f"""
        WITH base AS (SELECT CASE WHEN l_returnflag = 'R' THEN '2020-01-01' WHEN l_returnflag = 'A' THEN '2020-01-02'
                        ELSE '2020-01-03' END AS d, l_suppkey % 3 AS prov, l_extendedprice, l_discount, l_tax,
                        l_linenumber FROM read_parquet('{SF001}/lineitem.parquet')),
        b AS (SELECT d, prov, l_extendedprice * (1 - l_discount) AS bid FROM base WHERE l_linenumber % 2 = 0),
        a AS (SELECT d, prov, l_extendedprice * (1 + l_tax) AS ask FROM base WHERE l_linenumber % 2 = 1)
        SELECT d, quantile_disc((ask - bid) / ((ask + bid) / 2), 0.5) FROM b JOIN a USING (d, prov) GROUP BY d
        """).fetchall())
    assert got == exp and len(got) == 3


@pytest.mark.parametrize("key_values", [20_000, 60, 1])
def test_hot_day_is_counted_key_by_key(spark, monkeypatch, key_values):
    """A day too large for a task: no key that fits a row goes through a range split."""
    from bondliq.operators import pair_median as pm

    split = []
    original = pm.cumulative_within
    monkeypatch.setattr(pm, "cumulative_within", lambda df, *a, **kw: (split.append(1), original(df, *a, **kw))[1])
    monkeypatch.setattr(pm, "KEY_VALUES", key_values)
    rnd = random.Random(9)
    bids, asks = [], []
    for prov in range(12):  # one key of more than 60 values
        for _ in range(80 if prov == 3 else rnd.randint(0, 25)):
            bids.append((7, prov, "2020-01-01", round(rnd.uniform(90, 100), 1)))
            asks.append((7, prov, "2020-01-01", round(rnd.uniform(95, 110), 1)))
    b, a = _frames(spark, bids, asks)
    got = pair_spread_medians(b, a, "m", pair_cap=50, partitions=3, hot_rows=1).collect()
    assert {(r["bond"], str(r["date"])): r["m"] for r in got} == _brute(bids, asks)
    assert bool(split) == (key_values < 20_000)

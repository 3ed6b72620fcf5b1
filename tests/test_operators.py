"""Operators against brute force on small hand-made inputs (hot groups,
ties, nulls), and their properties."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bondliq.functions.spread import relative_spread
from bondliq.operators.dedupe import dedupe_by_key
from bondliq.operators.median import lower_median, median_aggregate, median_split, median_window
from bondliq.operators.position import global_position
from tests.single_partition import window_position


def lower_median_py(values):
    v = sorted(x for x in values if x is not None)
    if not v:
        return None
    return v[math.ceil(len(v) / 2) - 1]


def _groups_frame(spark, seed=7):
    rnd = random.Random(seed)
    rows = []
    # one hot group with a third of all rows, heavy ties
    for _ in range(3000):
        rows.append((1, "d1", float(rnd.choice([0.01, 0.02, 0.02, 0.03, rnd.random()]))))
    for g in range(2, 300):
        for _ in range(rnd.randint(1, 20)):
            v = None if rnd.random() < 0.1 else round(rnd.uniform(-0.5, 2.0), 3)
            rows.append((g, f"d{g % 3}", v))
    rows.append((999, "d0", None))  # all-null group
    schema = T.StructType([T.StructField("g", T.LongType()), T.StructField("d", T.StringType()),
                           T.StructField("v", T.DoubleType())])
    return rows, spark.createDataFrame(rows, schema).repartition(6)


def _expected(rows):
    groups = {}
    for g, d, v in rows:
        groups.setdefault((g, d), []).append(v)
    return {k: lower_median_py(v) for k, v in groups.items()}


@pytest.mark.parametrize("method", ["window", "aggregate", "split", "exact"])
def test_lower_median_matches_brute_force(spark, method):
    rows, df = _groups_frame(spark)
    got = {(r["g"], r["d"]): r["m"] for r in lower_median(df, ["g", "d"], "v", "m", method=method).collect()}
    assert got == _expected(rows)


def test_split_median_with_many_segments(spark):
    rows, df = _groups_frame(spark, seed=11)
    out = median_split(df, ["g", "d"], "v", "m", partitions=37)
    got = {(r["g"], r["d"]): r["m"] for r in out.collect()}
    assert got == _expected(rows)


def test_exact_switches_to_split_for_hot_groups(spark):
    rows, df = _groups_frame(spark, seed=3)
    got = {(r["g"], r["d"]): r["m"] for r in lower_median(df, ["g", "d"], "v", "m", hot_rows=50).collect()}
    assert got == _expected(rows)


def test_even_count_takes_lower_element(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 3.0), (1, 4.0)], "g long, v double")
    for fn in (median_window, median_aggregate, median_split):
        assert fn(df, ["g"], "v", "m").first()["m"] == 2.0


def test_spread_sign_and_zero_mid(spark):
    df = spark.createDataFrame([(99.0, 101.0), (101.0, 99.0), (-1.0, 1.0)], "bid double, ask double")
    a = [r[0] for r in df.select(relative_spread("bid", "ask")).collect()]
    b = [r[0] for r in df.select(relative_spread("ask", "bid")).collect()]
    assert a[0] == pytest.approx(0.02) and a[1] == -a[0]
    assert a[2] is None and b[2] is None
    assert b[0] == -a[0]


def _pos_frame(spark, n=5000, seed=5):
    rnd = random.Random(seed)
    rows = [(i, None if rnd.random() < 0.05 else float(rnd.choice([1, 2, 2, 2, 3, rnd.random()])))
            for i in range(1, n + 1)]
    return spark.createDataFrame(rows, "id long, x double").repartition(7)


@pytest.mark.parametrize("order", [
    lambda: [F.col("x").desc_nulls_last(), F.col("id").asc()],
    lambda: [F.col("x").asc_nulls_first(), F.col("id").asc()],
])
def test_global_position_equals_window(spark, order):
    df = _pos_frame(spark)
    a = {r["id"]: r["p"] for r in global_position(df, order(), "p", partitions=13).collect()}
    b = {r["id"]: r["p"] for r in window_position(df, order(), "p").collect()}
    assert a == b
    assert sorted(a.values()) == list(range(1, len(a) + 1))




def test_dedupe_keeps_smallest_under_order(spark):
    rows = [(1, 5.0, "a"), (1, 3.0, "b"), (1, 3.0, "c"), (2, None, "z"), (2, 1.0, "y")]
    df = spark.createDataFrame(rows, "k long, o double, p string")
    got = {r["k"]: (r["o"], r["p"]) for r in dedupe_by_key(df, ["k"], ["o"]).collect()}
    assert got == {1: (3.0, "b"), 2: (None, "z")}


def test_approx_median_within_rank_error(spark):
    rnd = random.Random(1)
    rows = [(g, rnd.random()) for g in range(3) for _ in range(5000)]
    df = spark.createDataFrame(rows, "g long, v double")
    accuracy = 100
    got = {r["g"]: r["m"] for r in lower_median(df, ["g"], "v", "m", method="approx", accuracy=accuracy).collect()}
    for g in range(3):
        vals = sorted(v for gg, v in rows if gg == g)
        n = len(vals)
        rank = vals.index(got[g]) + 1
        assert abs(rank - math.ceil(n / 2)) <= n / accuracy


def test_approx_counts_within_error(spark):
    from bondliq.operators.counts import quote_counts

    rows = [(b, p, f"2020-01-{d:02d}") for b in range(3) for p in range(40 * (b + 1)) for d in range(1, 1 + 10 * (b + 1))]
    df = spark.createDataFrame(rows, "bond long, prov long, date string")
    exact = {r["bond"]: (r["providers_cnt"], r["qdays_cnt"]) for r in quote_counts(df).collect()}
    assert exact == {b: (40 * (b + 1), 10 * (b + 1)) for b in range(3)}
    approx = {r["bond"]: (r["providers_cnt"], r["qdays_cnt"]) for r in quote_counts(df, approx_rsd=0.02).collect()}
    for b, (p, d) in exact.items():
        assert abs(approx[b][0] - p) <= 0.1 * p and abs(approx[b][1] - d) <= 0.1 * d

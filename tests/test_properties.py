"""Generated inputs (hypothesis): every exact plan equals brute force."""

import math

from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bondliq.operators.median import median_aggregate, median_split, median_window
from bondliq.operators.pair_median import pair_spread_medians
from bondliq.operators.position import global_position
from tests.single_partition import window_position

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

values = st.one_of(st.none(), st.sampled_from([0.01, 0.02, 0.5]), st.floats(-2, 2, allow_nan=False))
groups = st.lists(st.tuples(st.integers(0, 4), values), min_size=1, max_size=120)


def _lower(vs):
    v = sorted(x for x in vs if x is not None)
    return v[math.ceil(len(v) / 2) - 1] if v else None


@SETTINGS
@given(rows=groups)
def test_median_plans_equal_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "g long, v double")
    exp = {}
    for g, v in rows:
        exp.setdefault(g, []).append(v)
    exp = {g: _lower(v) for g, v in exp.items()}
    for fn in (median_window, median_aggregate):
        assert {r["g"]: r["m"] for r in fn(df, ["g"], "v", "m").collect()} == exp
    assert {r["g"]: r["m"] for r in median_split(df, ["g"], "v", "m", partitions=5).collect()} == exp


@SETTINGS
@given(xs=st.lists(st.one_of(st.none(), st.integers(0, 5)), min_size=1, max_size=150))
def test_global_position_is_row_number(spark, xs):
    df = spark.createDataFrame(list(enumerate(xs)), "id long, x long")
    order = [F.col("x").desc_nulls_last(), F.col("id").asc()]
    a = {r["id"]: r["p"] for r in global_position(df, order, "p", partitions=6).collect()}
    b = {r["id"]: r["p"] for r in window_position(df, order, "p").collect()}
    assert a == b


prices = st.integers(90, 110).map(float)
sides = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 1), prices), min_size=1, max_size=40)


@settings(max_examples=30, deadline=None, suppress_health_check=list(HealthCheck))
@given(bids=sides, asks=sides, cap=st.sampled_from([3, 10, 10_000]))
@example(  # a day settled in round 1 while another day still needs rounds
    bids=[(0, 0, 98.0), (2, 0, 101.0), (0, 1, 101.0), (2, 0, 92.0), (0, 0, 110.0)],
    asks=[(0, 0, 108.0), (0, 0, 101.0), (0, 0, 102.0), (0, 0, 103.0), (0, 0, 95.0), (0, 0, 102.0),
          (2, 0, 99.0), (0, 0, 90.0), (0, 0, 90.0), (0, 0, 90.0), (0, 0, 90.0), (2, 0, 90.0)],
    cap=3,
)
def test_pair_medians_equal_listing(spark, bids, asks, cap):
    b = spark.createDataFrame(bids, "bond long, prov long, bid double").withColumn("date", F.current_date())
    a = spark.createDataFrame(asks, "bond long, prov long, ask double").withColumn("date", F.current_date())
    spreads = {}
    for bb, bp, bid in bids:
        for ab, ap, ask in asks:
            if (bb, bp) == (ab, ap):
                spreads.setdefault(bb, []).append((ask - bid) / ((ask + bid) / 2))
    exp = {k: _lower(v) for k, v in spreads.items()}
    got = {r["bond"]: r["m"] for r in pair_spread_medians(b, a, "m", pair_cap=cap, partitions=4).collect()}
    assert got == exp


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 30), st.integers(0, 5)), min_size=1, max_size=150,
                     unique_by=lambda r: (r[0], r[1])),
       parts=st.sampled_from([None, 1, 3, 7]))
def test_cumulative_within_equals_running_sums(spark, rows, parts):
    from bondliq.operators.cumulative import cumulative_within

    df = spark.createDataFrame(rows, "g long, o long, w long")
    got = {(r["g"], r["o"]): r["cum_w"] for r in cumulative_within(df, ["g"], ["o"], ["w"], partitions=parts).collect()}
    exp = {}
    for g in {r[0] for r in rows}:
        total = 0
        for _, o, w in sorted(r for r in rows if r[0] == g):
            total += w
            exp[(g, o)] = total
    assert got == exp


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 3)), st.text("ab", max_size=2)),
                     min_size=1, max_size=60))
def test_dedupe_keeps_first_under_order(spark, rows):
    from bondliq.operators.dedupe import dedupe_by_key

    df = spark.createDataFrame(rows, "k long, o long, p string")
    got = {r["k"]: (r["o"], r["p"]) for r in dedupe_by_key(df, ["k"], ["o"]).collect()}
    exp = {}
    for k, o, p in rows:
        key = (o is not None, o if o is not None else 0, p)  # nulls first, then order, then the rest
        if k not in exp or key < exp[k][0]:
            exp[k] = (key, (o, p))
    assert got == {k: v for k, (_, v) in exp.items()}

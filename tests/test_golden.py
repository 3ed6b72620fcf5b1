"""The golden case end to end (metrics of both markets and the 33 columns)."""

import math

import pytest

from bondliq import schemas
from bondliq.operators.clean import strict_bonds
from bondliq.plans.liquidity import liquidity_table
from bondliq.plans.metrics import exchange_metrics, otc_metrics
from tests import golden
from tests.single_partition import window_liquidity


def _run(spark, bond7_days=19, **kw):
    bonds_raw, ex_raw, otc_raw = golden.frames(spark, bond7_days)
    bonds = strict_bonds(bonds_raw)
    tsq = exchange_metrics(ex_raw, bonds, **kw)
    otc = otc_metrics(otc_raw, bonds, **kw)
    return bonds, tsq, otc


def _by_id(df):
    return {r["id"]: r.asDict() for r in df.collect()}


@pytest.mark.parametrize("method", ["exact", "window", "aggregate", "split", "approx"])
def test_market_metrics(spark, method):
    _, tsq, otc = _run(spark, median_method=method)
    t, o = _by_id(tsq), _by_id(otc)
    assert sorted(t) == [1, 2, 7]
    assert sorted(o) == [2, 3]
    exp_t = {1: (0.02, 4, 20), 2: (0.1, 1, 2), 7: (0.04, 1, 19)}
    exp_o = {2: (0.10945273631840796, 1, 1), 3: (0.04, 2, 2)}
    for exp, got in ((exp_t, t), (exp_o, o)):
        for i, (m, p, d) in exp.items():
            row = got[i]
            assert row["bid_ask_spread_relative_median"] == pytest.approx(m, rel=0, abs=1e-15)
            assert (row["providers_cnt"], row["qdays_cnt"]) == (p, d)


def test_strict_bonds_drops_null_keys(spark):
    bonds_raw, _, _ = golden.frames(spark)
    ids = sorted(r["id"] for r in strict_bonds(bonds_raw).collect())
    assert ids == [1, 2, 3, 4, 7]


@pytest.mark.parametrize("positions", ["distributed", "window"])
def test_liquidity_table(spark, positions):
    bonds, tsq, otc = _run(spark)
    make = liquidity_table if positions == "distributed" else window_liquidity
    lt = make(tsq, otc, bonds, golden.WEIGHTS, golden.ANCHOR)
    assert lt.columns == schemas.LIQUIDITY_COLUMNS
    assert [f.dataType for f in lt.schema.fields] == [f.dataType for f in schemas.LIQUIDITY.fields]
    rows = _by_id(lt)
    assert sorted(rows) == [1, 2, 3, 7]
    for r in rows.values():
        assert (r["total_bonds"], r["max_providers_cnt"], r["max_qdays_cnt"]) == (4, 4, 20)
        assert str(r["anchor_date"]) == golden.ANCHOR
    exp = {
        # id: spread, pos spread, providers, qdays, pos volume, ranks, index, since issue, to maturity
        1: (0.02, 4, 4, 20, 4, (1, 1, 1, 1, 1), 1.0, 381, 3272),
        2: (0.10472636815920398, 1, 2, 2, 1, (.25, .5, .25, 0, 1), 0.0, 609, 3044),
        3: (0.04, 2, 2, 2, 3, (.5, .5, .75, 0, .5), 0.0, 30, None),
        7: (0.04, 3, 1, 19, 2, (.75, .25, .5, .95, 1), 0.640374873, 0, -1),
    }
    rank_cols = ("baspread_rel_rank", "providers_cnt_rank", "usd_volume_rank", "qdays_cnt_rank",
                 "exchange_indicator_rank")
    for i, (spread, ps, prov, qd, pv, ranks, idx, since, to_mat) in exp.items():
        r = rows[i]
        assert r["baspread_rel_median"] == pytest.approx(spread, abs=1e-15)
        assert (r["pos_by_baspread_rel_median"], r["providers_cnt"], r["qdays_cnt"], r["pos_by_usd_volume"]) == (
            ps, prov, qd, pv)
        assert tuple(r[c] for c in rank_cols) == pytest.approx(ranks)
        assert r["liq_index"] == pytest.approx(idx, abs=1e-9)
        assert (r["days_since_issue"], r["days_to_maturity"]) == (since, to_mat)
    assert rows[2]["exchange_indicator_rank"] == 1.0 and rows[3]["exchange_indicator_rank"] == 0.5
    assert rows[2]["tsq_providers_cnt"] == 1 and rows[2]["otc_providers_cnt"] == 1


def test_index_zero_under_19_days(spark):
    bonds, tsq, otc = _run(spark, bond7_days=18)
    rows = _by_id(liquidity_table(tsq, otc, bonds, golden.WEIGHTS, golden.ANCHOR))
    assert rows[7]["qdays_cnt"] == 18
    assert rows[7]["qdays_cnt_rank"] == 0.0
    assert rows[7]["liq_index"] == 0.0


def test_index_scale_invariant_and_bounded(spark):
    bonds, tsq, otc = _run(spark)
    a = _by_id(liquidity_table(tsq, otc, bonds, golden.WEIGHTS, golden.ANCHOR))
    scaled = {k: 3.0 * v for k, v in golden.WEIGHTS.items()}
    b = _by_id(liquidity_table(tsq, otc, bonds, scaled, golden.ANCHOR))
    for i in a:
        assert 0.0 <= a[i]["liq_index"] <= 1.0
        assert math.isclose(a[i]["liq_index"], b[i]["liq_index"], rel_tol=1e-12, abs_tol=1e-15)


@pytest.mark.parametrize("listing", ["early", "late", "join"])
def test_listing_plans_agree(spark, listing):
    bonds_raw, ex_raw, otc_raw = golden.frames(spark)
    # repeat bond 2 in the list: fan-out must be the same whichever way J1 runs
    extra = spark.createDataFrame([(2, "XS02B", None, None, None)], golden.BONDS_SCHEMA)
    bonds = strict_bonds(bonds_raw.unionByName(extra))
    t = exchange_metrics(ex_raw, bonds, listing=listing)
    o = otc_metrics(otc_raw, bonds, listing=listing)
    rows = sorted(tuple(r) for r in t.unionByName(o).collect())
    ref_t = exchange_metrics(ex_raw, bonds, listing="join")
    ref_o = otc_metrics(otc_raw, bonds, listing="join")
    assert rows == sorted(tuple(r) for r in ref_t.unionByName(ref_o).collect())
    assert sum(1 for r in rows if r[0] == 2) == 4  # two list rows x two markets


def test_profile_bounds_switch_to_split_plan(spark):
    """With a tiny hot-group bound the observed profile sizes send both median
    levels of both markets to the range-split plan; results are unchanged."""
    _, tsq, otc = _run(spark, median_method="exact", hot_rows=2)
    _, tsq_w, otc_w = _run(spark, median_method="window")
    assert sorted(map(tuple, tsq.collect())) == sorted(map(tuple, tsq_w.collect()))
    assert sorted(map(tuple, otc.collect())) == sorted(map(tuple, otc_w.collect()))


def test_empty_inputs_give_empty_tables(spark):
    bonds_raw, ex_raw, otc_raw = golden.frames(spark)
    bonds = strict_bonds(bonds_raw)
    none_ex, none_otc = ex_raw.limit(0), otc_raw.limit(0)
    tsq = exchange_metrics(none_ex, bonds)
    otc = otc_metrics(none_otc, bonds)
    assert tsq.count() == 0 and otc.count() == 0
    lt = liquidity_table(tsq, otc, bonds, golden.WEIGHTS, golden.ANCHOR)
    assert lt.count() == 0 and lt.columns == schemas.LIQUIDITY_COLUMNS
    no_bonds = strict_bonds(bonds_raw.limit(0))
    assert exchange_metrics(ex_raw, no_bonds).count() == 0


def test_bond_without_median_fails_or_is_rejected(spark):
    """Every mid of bond 9 is zero (ask = -bid): no median. The production
    schema says non-null, so the job fails by default; reject drops the bond."""
    from pyspark.errors import PySparkException

    import datetime as dt

    bonds_raw, ex_raw, _ = golden.frames(spark)
    extra_bond = spark.createDataFrame([(9, "XS09", 1.0, None, None)], golden.BONDS_SCHEMA)
    extra_quotes = spark.createDataFrame([(9, 10, dt.date(2020, 1, 2), 5.0, -5.0)], golden.EXCH_SCHEMA)
    bonds = strict_bonds(bonds_raw.unionByName(extra_bond))
    quotes = ex_raw.unionByName(extra_quotes)
    with pytest.raises(PySparkException):
        exchange_metrics(quotes, bonds).collect()
    kept = {r["id"] for r in exchange_metrics(quotes, bonds, on_null="reject").collect()}
    assert kept == {1, 2, 7}

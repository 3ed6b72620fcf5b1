"""Sources, sinks, the daily run and its streaming trigger on the golden case."""

import datetime as dt
import os
import tempfile

import pytest

from bondliq import schemas
from bondliq.plans import daily
from bondliq.sinks import tables as sinks
from bondliq.sources import csv as csvsrc
from bondliq.sources.paths import day_inputs
from bondliq.streaming import daily_trigger
from tests import golden


def _stage(spark, root, anchor, bond7_days=19):
    """Write the golden case as the dated CSV archive of ``anchor``."""
    bonds, ex, otc = golden.frames(spark, bond7_days)
    paths = day_inputs(root, anchor)
    bonds.coalesce(1).write.mode("overwrite").option("header", "true").csv(paths.bonds)
    ex.coalesce(1).write.mode("overwrite").option("header", "true").csv(paths.exchange)
    otc.coalesce(1).write.mode("overwrite").option("header", "true").csv(paths.otc)
    return paths


def test_day_inputs_names():
    assert day_inputs("/data/archive", "2020-01-31") == day_inputs("/data/archive", "20200131")
    p = day_inputs("/data/archive", "20200131")
    assert p.exchange == "/data/archive_20200131/quotes_20200131.csv"
    assert p.otc == "/data/archive_20200131/quotes_mp_month_raw_20200131.csv"
    assert p.bonds == "/data/archive_20200131/bonds_20200131.csv"


def test_csv_reader_keeps_malformed_rows(spark):
    d = tempfile.mkdtemp(prefix="bondliq-csv-")
    path = os.path.join(d, "bonds.csv")
    with open(path, "w") as f:
        f.write("id,isin_code,usd_volume,date_of_end_placing,maturity_date\n")
        f.write("1,XS01,500.0,2019-01-15,2029-01-15\n")
        f.write("oops,XS02,abc,2018-06-01,2028-06-01\n")
    rows = csvsrc.read_bonds(spark, path, keep_corrupt=True).collect()
    assert rows[0]["id"] == 1 and rows[0]["_corrupt_record"] is None
    assert rows[1]["id"] is None and rows[1]["_corrupt_record"].startswith("oops")


def test_run_day_and_replace_date(spark):
    base = tempfile.mkdtemp(prefix="bondliq-day-")
    root, out = f"{base}/archive", f"{base}/out"
    a = _stage(spark, root, "20200131")
    b = _stage(spark, root, "20200130", bond7_days=18)
    o = daily.run_days(spark, root, ["2020-01-31", "20200130"], golden.WEIGHTS, out)
    first = {r["id"]: r["liq_index"] for r in o.read(spark, o.liquidity, ["20200131"]).collect()}
    # rerun of the first date: replaced, not duplicated; the other date untouched
    daily.run_day(spark, a, golden.WEIGHTS, out)
    table = o.read(spark, o.liquidity)
    counts = {str(r["anchor_date"]): r["count"] for r in table.groupBy("anchor_date").count().collect()}
    assert counts == {"2020-01-31": 4, "2020-01-30": 4}
    again = {r["id"]: r["liq_index"] for r in o.read(spark, o.liquidity)
             .where("anchor_date = DATE'2020-01-31'").collect()}
    assert again == first and first[7] == pytest.approx(0.640374873, abs=1e-9)
    older = {r["id"]: r["liq_index"] for r in table.where("anchor_date = DATE'2020-01-30'").collect()}
    assert older[7] == 0.0
    tsq = o.read(spark, o.tsq_metrics)
    assert tsq.columns == [f.name for f in schemas.MARKET_METRICS.fields] + ["upsert_time"]
    assert sorted(r["id"] for r in o.read(spark, o.otc_metrics).collect()) == [2, 3]


def test_streaming_trigger_runs_each_new_date_once(spark):
    base = tempfile.mkdtemp(prefix="bondliq-stream-")
    root, out, ckpt = f"{base}/archive", f"{base}/out", f"{base}/ckpt"
    _stage(spark, root, "20200131")
    q = daily_trigger.start(spark, root, golden.WEIGHTS, out, ckpt)
    q.awaitTermination(600)
    _stage(spark, root, "20200130", bond7_days=18)
    q = daily_trigger.start(spark, root, golden.WEIGHTS, out, ckpt)
    q.awaitTermination(600)
    table = daily.outputs(out).read(spark, daily.outputs(out).liquidity)
    counts = {str(r["anchor_date"]): r["count"] for r in table.groupBy("anchor_date").count().collect()}
    assert counts == {"2020-01-31": 4, "2020-01-30": 4}


def test_export_csv_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="bondliq-exp-") + "/m"
    df = spark.createDataFrame([(1, "XS01", 0.02, 4, 20)], schemas.MARKET_METRICS)
    sinks.write_export(df, d, "csv")
    back = spark.read.option("header", "true").schema(schemas.MARKET_METRICS).csv(d).collect()
    assert back[0].asDict() == df.collect()[0].asDict()


def test_run_day_repeated_bond_id_keeps_one_row_per_key(spark):
    from pyspark.sql import Row

    from bondliq.operators.dedupe import duplicate_keys

    base = tempfile.mkdtemp(prefix="bondliq-dup-")
    root, out = f"{base}/archive", f"{base}/out"
    paths = _stage(spark, root, "20200131")
    # the bond list repeats id 1 under another isin
    bonds, _, _ = golden.frames(spark)
    extra = spark.createDataFrame([(1, "XS01B", 500.0, dt.date(2019, 1, 15), dt.date(2029, 1, 15))],
                                  golden.BONDS_SCHEMA)
    bonds.unionByName(extra).coalesce(1).write.mode("overwrite").option("header", "true").csv(paths.bonds)
    raw = csvsrc.read_bonds(spark, paths.bonds)
    assert duplicate_keys(raw.where("id is not null"), ["id"]).collect() == [Row(id=1, rows=2)]
    o = daily.run_day(spark, paths, golden.WEIGHTS, out)
    tsq = {r["id"]: r["isin"] for r in o.read(spark, o.tsq_metrics).collect()}
    assert tsq[1] == "XS01" and len(tsq) == 3
    lt = o.read(spark, o.liquidity)
    assert lt.count() == lt.select("id", "anchor_date").distinct().count() == 4
    # the fan-out is kept in the aggregates, as in production: 5 bond rows covered
    assert {r["total_bonds"] for r in lt.collect()} == {5}


def test_csv_reader_takes_columns_by_name(spark):
    d = tempfile.mkdtemp(prefix="bondliq-csv-")
    path = os.path.join(d, "quotes.csv")
    with open(path, "w") as f:
        f.write("ask,extra,date,bond,bid,tg\n")
        f.write("101.0,x,2020-01-01 15:30:00,7,99.0,10\n")
    row = csvsrc.read_exchange_quotes(spark, path).first()
    assert (row["bond"], row["tg"], row["bid"], row["ask"]) == (7, 10, 99.0, 101.0)
    assert row["date"] == dt.datetime(2020, 1, 1, 15, 30)
    with pytest.raises(ValueError, match="missing"):
        csvsrc.read_bonds(spark, path)


def test_backfill_in_one_plan_equals_single_runs(spark):
    base = tempfile.mkdtemp(prefix="bondliq-fill-")
    root = f"{base}/archive"
    for anchor, days in (("20200131", 19), ("20200130", 18), ("20200129", 5)):
        _stage(spark, root, anchor, bond7_days=days)
    both = daily.run_days(spark, root, ["2020-01-29", "2020-01-31", "20200130"], golden.WEIGHTS, f"{base}/both")
    for anchor in ("20200129", "20200131", "20200130"):
        single = daily.run_day(spark, day_inputs(root, anchor), golden.WEIGHTS, f"{base}/single")

    def rows(out, table):
        return sorted(str(r) for r in out.read(spark, table).drop("upsert_time").collect())

    for table in (both.liquidity, both.tsq_metrics, both.otc_metrics):
        assert rows(both, table) == rows(single, table), table
    assert len(rows(both, both.liquidity)) == 12
    assert len(both.read(spark, both.liquidity, ["2020-01-30"]).collect()) == 4


def test_trigger_waits_for_late_files_and_takes_an_empty_bond_list(spark):
    import shutil

    base = tempfile.mkdtemp(prefix="bondliq-late-")
    root, out, ckpt = f"{base}/archive", f"{base}/out", f"{base}/ckpt"
    full = _stage(spark, f"{base}/made", "20200131")

    def arrive(kind):
        target = getattr(day_inputs(root, "20200131"), kind)
        shutil.copytree(getattr(full, kind), target)

    def trigger():
        daily_trigger.start(spark, root, golden.WEIGHTS, out, ckpt).awaitTermination(600)
        return daily.outputs(out).read(spark, daily.outputs(out).liquidity).count()

    os.makedirs(f"{root}_20200131")
    arrive("bonds")
    assert trigger() == 0  # the quotes are not there yet
    arrive("otc")
    assert trigger() == 0
    arrive("exchange")
    assert trigger() == 4
    # a date whose bond list has no rows is run as well: it clears the date's old rows
    empty = day_inputs(root, "20200130")
    _stage(spark, root, "20200130")
    assert trigger() == 8
    shutil.rmtree(empty.bonds)
    os.makedirs(empty.bonds)
    with open(f"{empty.bonds}/part-1.csv", "w") as f:
        f.write("id,isin_code,usd_volume,date_of_end_placing,maturity_date\n")
    assert trigger() == 4


def test_staged_inputs_are_removed(spark):
    from bondliq.session import shared_dir

    base = tempfile.mkdtemp(prefix="bondliq-scratch-")
    paths = _stage(spark, f"{base}/archive", "20200131")
    folder = f"{shared_dir(spark)}/staged".removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    daily.run_day(spark, paths, golden.WEIGHTS, f"{base}/out")
    assert set(os.listdir(folder)) <= before

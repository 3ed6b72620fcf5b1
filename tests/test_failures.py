"""Bad deliveries, empty reruns, failing writes and sessions without a shared folder."""

import tempfile
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from bondliq import session
from bondliq.plans import daily
from bondliq.sinks import tables as sinks
from bondliq.sources.paths import day_inputs
from tests import golden


def _stage(spark, root, spoil=None):
    bonds, ex, otc = golden.frames(spark, 19)
    paths = day_inputs(root, "20200131")
    frames = {"bonds": bonds, "exchange": ex, "otc": otc}
    for name, df in frames.items():
        df = df.select([F.col(c).cast("string").alias(c) for c in df.columns])
        if spoil and name == spoil[0]:
            df = df.withColumn(spoil[1], F.lit(spoil[2]))
        df.coalesce(1).write.mode("overwrite").option("header", "true").csv(getattr(paths, name))
    return paths, frames


@pytest.mark.parametrize("spoil", [("exchange", "bid", "9x9"), ("otc", "date", "31.01.2020")])
def test_rows_that_do_not_convert_fail_the_run(spark, spoil):
    base = tempfile.mkdtemp(prefix="bondliq-bad-")
    paths, frames = _stage(spark, f"{base}/archive", spoil)
    with pytest.raises(ValueError, match="do not convert"):
        daily.run_day(spark, paths, golden.WEIGHTS, f"{base}/out")
    out = daily.outputs(f"{base}/out")
    rejects = out.read(spark, out.rejects)
    assert rejects.count() == frames[spoil[0]].count() and {r["input"] for r in rejects.collect()} == {spoil[0]}
    daily.run_day(spark, paths, golden.WEIGHTS, f"{base}/out", on_corrupt="reject")
    assert out.read(spark, out.liquidity).count() > 0


def test_empty_rerun_clears_the_date(spark):
    path = tempfile.mkdtemp(prefix="bondliq-k2-") + "/t"
    rows = spark.createDataFrame([(1, "2020-01-31"), (2, "2020-01-30")], "id long, anchor_date string").withColumn(
        "anchor_date", F.to_date("anchor_date"))
    sinks.write_replace_date(rows, path)
    sinks.write_replace_date(rows.where("id = 99"), path, date="20200131")
    assert [r["id"] for r in sinks.Store(spark, path).read(sinks.TABLE).collect()] == [2]


def test_failed_refresh_keeps_the_old_table(spark):
    path = tempfile.mkdtemp(prefix="bondliq-k1-") + "/t"
    columns = [f"{1.0 if 'median' in c else 1} AS {c}" for c in sinks.METRICS_COLUMNS]
    good = spark.range(3).selectExpr(*columns)
    sinks.write_full_refresh(good, path)
    first = sinks.METRICS_COLUMNS[0]
    with pytest.raises(Exception):
        sinks.write_full_refresh(good.withColumn(first, F.raise_error(F.lit("broken"))), path)
    assert sinks.read_table(spark, path).count() == 3
    sinks.write_full_refresh(good.limit(2), path)
    assert sinks.read_table(spark, path).count() == 2


def test_other_masters_must_name_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(SimpleNamespace(sparkContext=context, conf=Conf()))


def test_reader_sees_a_full_table_when_the_job_dies_before_or_while_publishing(spark, monkeypatch):
    from bondliq.sinks.store import Store

    path = tempfile.mkdtemp(prefix="bondliq-k1-") + "/t"
    good = spark.range(3).selectExpr(*[f"{1.0 if 'median' in c else 1} AS {c}" for c in sinks.METRICS_COLUMNS])
    sinks.write_full_refresh(good, path)
    publish = Store._publish

    def dies(self, number, tables):
        raise KeyboardInterrupt

    def dies_half_way(self, number, tables):
        publish(self, number, tables)
        file = self._file(number)
        with open(file) as f:
            text = f.read()
        with open(file, "w") as f:
            f.write(text[:len(text) // 2])
        self.fs.delete(self._path(f"{self.root}/_manifests/.{number:012d}.json.crc"), False)
        raise KeyboardInterrupt

    for death in (dies, dies_half_way):
        monkeypatch.setattr(Store, "_publish", death)
        with pytest.raises(KeyboardInterrupt):
            sinks.write_full_refresh(good.limit(1), path)
        assert sinks.read_table(spark, path).count() == 3
    monkeypatch.setattr(Store, "_publish", publish)
    sinks.write_full_refresh(good.limit(2), path)
    assert sinks.read_table(spark, path).count() == 2
    store = Store(spark, path)
    assert store.vacuum(keep=1, older_than_s=-1) == 3  # two that died, one that was replaced
    assert sinks.read_table(spark, path).count() == 2 and len(store._numbers()) == 1


def test_two_commits_at_a_time_keep_both_changes(spark):
    from bondliq.sinks.store import CommitConflict, Store

    root = tempfile.mkdtemp(prefix="bondliq-store-")
    a, b = Store(spark, root), Store(spark, root)
    one, two = a.write(spark.range(1), "one"), b.write(spark.range(2), "two")
    stale = (b.current()[0], b._numbers())
    a.commit({"one": one})
    with pytest.raises(CommitConflict):
        b._publish(stale[0] + 1, {"two": two})
    b.commit({"two": two})
    assert a.read("one").count() == 1 and a.read("two").count() == 2
    assert a.read("none", spark.range(1).schema).count() == 0
    with pytest.raises(ValueError):
        a.read("none")


@pytest.mark.parametrize("broken", ["liquidity_table", "dedupe_by_key", "commit"])
def test_a_run_that_fails_late_leaves_all_tables_at_the_old_run(spark, monkeypatch, broken):
    base = tempfile.mkdtemp(prefix="bondliq-late-")
    paths, _ = _stage(spark, f"{base}/archive")
    out = daily.run_day(spark, paths, golden.WEIGHTS, f"{base}/out")

    def state():
        return {t: sorted(map(str, out.read(spark, t).collect())) for t in (out.tsq_metrics, out.otc_metrics, out.liquidity, out.rejects)}

    before = state()
    bonds, ex, otc = golden.frames(spark, 3)  # other quotes: every table would change
    ex.coalesce(1).write.mode("overwrite").option("header", "true").csv(paths.exchange)
    otc.where("bond = 2").coalesce(1).write.mode("overwrite").option("header", "true").csv(paths.otc)

    def fails(*a, **k):
        raise RuntimeError("late")

    monkeypatch.setattr(*((daily.Store, "commit") if broken == "commit" else (daily, broken)), fails)
    with pytest.raises(RuntimeError, match="late"):
        daily.run_day(spark, paths, golden.WEIGHTS, f"{base}/out")
    assert state() == before
    monkeypatch.undo()
    daily.run_day(spark, paths, golden.WEIGHTS, f"{base}/out")
    after = state()
    assert all(after[t] != before[t] for t in (out.tsq_metrics, out.otc_metrics, out.liquidity))


def test_rejected_lines_and_bonds_can_be_had_back(spark):
    base = tempfile.mkdtemp(prefix="bondliq-rej-")
    paths, _ = _stage(spark, f"{base}/archive")
    import os

    lines = ['1,10,2020-01-02,"9,9",101.0', "1,10,2020-01-03,,abc", "1,10", '8,10,2020-01-03,-5.0,5.0', ""]
    with open(os.path.join(paths.exchange, "part-99999.csv"), "w") as f:
        f.write("\n".join(["bond,tg,date,bid,ask", *lines]) + "\n")
    with open(os.path.join(paths.bonds, "part-99999.csv"), "w") as f:
        f.write("id,isin_code,usd_volume,date_of_end_placing,maturity_date\n8,XS08,,,\n")
    with pytest.raises(ValueError, match="3 input rows"):
        daily.run_day(spark, paths, golden.WEIGHTS, f"{base}/out", on_null="reject")
    with pytest.raises(Exception, match="null in non-nullable"):
        daily.run_day(spark, paths, golden.WEIGHTS, f"{base}/out", on_corrupt="reject")
    out = daily.run_day(spark, paths, golden.WEIGHTS, f"{base}/out", on_corrupt="reject", on_null="reject")
    got = {(r["anchor"], r["input"], r["raw"]) for r in out.read(spark, out.rejects).collect()}
    assert {r for r in got if not r[2].startswith("{")} == {("20200131", "exchange", x) for x in lines[:3]}
    (bond,) = [r for r in got if r[2].startswith("{")]
    assert bond[1] == "exchange" and '"id":8' in bond[2]
    assert 8 not in {r["id"] for r in out.read(spark, out.liquidity).collect()}

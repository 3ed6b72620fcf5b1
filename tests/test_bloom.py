"""J1 above the broadcast bound, positions within groups, and verbatim rejects."""

import os
import tempfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bondliq.operators import bloom, clean
from bondliq.operators.position import Ranking, global_positions, with_row_key
from bondliq.plans import metrics as met
from bondliq.session import materialize
from bondliq.sources import csv as csvsrc
from bondliq.sources import fixtures as fx
from tests.conftest import SF001


def test_bloom_keeps_every_listed_key_and_few_others(spark):
    ids = spark.range(0, 200_000, 2).select(F.col("id").alias("bond"))
    found = bloom.bloom_filter(ids, ["bond"], 100_000)
    assert found.count() <= found.blocks <= bloom.BLOCKS
    kept = bloom.maybe_in(spark.range(400_000).select(F.col("id").alias("bond"), F.lit(1).alias("x")), ["bond"], found)
    row = kept.agg(F.count(F.when((F.col("bond") % 2 == 0) & (F.col("bond") < 200_000), 1)).alias("listed"), F.count("*").alias("n")).first()
    assert row["listed"] == 100_000 and row["n"] - row["listed"] < 0.02 * 300_000


def test_bloom_listing_gives_the_same_metrics_and_drops_quotes_before_the_shuffle(spark):
    bonds = clean.strict_bonds(fx.bonds_raw(spark, SF001)).where("id % 4 = 0")
    exchange, otc = fx.exchange_quotes_raw(spark, SF001), fx.otc_quotes_raw(spark, SF001)
    assert clean.listing_plan(bonds, max_rows=10) == "bloom" and clean.listing_plan(bonds, 10, 20) == "late"
    for run, raw in ((met.exchange_metrics, exchange), (met.otc_metrics, otc)):
        want = sorted(map(tuple, run(raw, bonds, listing="join").collect()))
        assert sorted(map(tuple, run(raw, bonds, listing="bloom").collect())) == want and want
    all_rows = met.exchange_quotes(exchange, bonds, "late").count()
    exact, kept = (met.exchange_quotes(exchange, bonds, p).count() for p in ("join", "bloom"))
    assert exact <= kept < 0.5 * all_rows


@pytest.mark.parametrize("partitions", [1, 7])
def test_positions_in_groups_equal_row_number(spark, partitions):
    df = spark.range(3000).select(
        (F.col("id") % 1700).alias("id"), F.when(F.col("id") % 5 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 4).cast("string"))).alias("g"),
        F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 13 == 0, F.lit(float("nan"))).otherwise((F.col("id") * 7 % 19).cast("double")).alias("x"),
        F.when(F.col("id") % 17 != 0, -(F.col("id") % 23).cast("double")).alias("y"))
    kept = materialize(with_row_key(df.repartition(5)))
    rankings = [Ranking("x", "px", True, False), Ranking("y", "py", False, True)]
    got = global_positions(kept, rankings, "_row", "id", within=["g"], partitions=partitions)
    w = Window.partitionBy("g")
    want = kept.withColumn("px", F.row_number().over(w.orderBy(F.col("x").desc_nulls_last(), "id", "_row")).cast("bigint")).withColumn(
        "py", F.row_number().over(w.orderBy(F.col("y").asc_nulls_first(), "id", "_row")).cast("bigint"))
    columns = ["_row", "px", "py"]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))
    assert global_positions(kept.where("id < 0"), rankings, "_row", "id").count() == 0


def test_rejected_lines_are_kept_as_they_stand_in_the_file(spark):
    d = tempfile.mkdtemp(prefix="bondliq-raw-")
    path = os.path.join(d, "quotes.csv")
    bad = ['7, "x" ,2020-01-01,"1,5",101.0,', '"7",10,"not a ""date""",99.0,101.0,e', "7,10,2020-01-01", "7,10,2020-01-01,1,2,e,too many"]
    good = ['"7",10,2020-01-01,"99.0",101.0,"a,b"', "8,,2020-01-02,,,", '9,10,"2020-01-03 10:00:00",1e2,"101",""']
    with open(path, "w", newline="") as f:
        f.write("﻿bond,tg,date,bid,ask,extra\r\n" + "\r\n".join([good[0], bad[0], "", good[1], *bad[1:], good[2]]) + "\r\n")
    rows = csvsrc.read_exchange_quotes(spark, path, keep_corrupt=True).collect()
    assert sorted(r[csvsrc.CORRUPT] for r in rows if r[csvsrc.CORRUPT] is not None) == sorted(bad)
    fine = {r["bond"]: (r["tg"], r["bid"], r["ask"]) for r in rows if r[csvsrc.CORRUPT] is None}
    assert fine == {7: (10, 99.0, 101.0), 8: (None, None, None), 9: (10, 100.0, 101.0)}
    got = csvsrc.stage_csv(spark, csvsrc.read_exchange_quotes, {"a": path, "b": path}, "quotes")
    assert (got.rejected, got.good.count()) == (8, 6)
    assert sorted((r["anchor"], r["raw"]) for r in got.rejects.collect()) == sorted((k, x) for k in "ab" for x in bad)
    got.unstage()

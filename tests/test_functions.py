"""Column functions: dates, schema enforcement, weights."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from bondliq import schemas
from bondliq.functions.dates import anchor_compact, anchor_compact_str, business_date, clamp_far_date, days_between
from bondliq.operators.enforce import enforce, split_rejects
from bondliq.operators.weights import weights_dict, weights_row


def test_business_date_cutoff(spark):
    rows = [(dt.datetime(2024, 1, 10, 6, 59, 59),), (dt.datetime(2024, 1, 10, 7, 0, 0),),
            (dt.datetime(2024, 1, 10, 23, 30, 0),), (dt.datetime(2024, 1, 11, 7, 0, 0),)]
    df = spark.createDataFrame(rows, "ts timestamp")
    got = [r[0] for r in df.select(business_date("ts")).collect()]
    # 23:30 UTC is 02:30 in Moscow the next day, still before the cutoff
    assert got == [dt.date(2024, 1, 9), dt.date(2024, 1, 10), dt.date(2024, 1, 10), dt.date(2024, 1, 11)]


def test_anchor_compact(spark):
    df = spark.createDataFrame([("2020-01-31",), ("0",), (None,)], "a string")
    fallback = F.lit("2021-05-06").cast("date")
    got = [r[0] for r in df.select(anchor_compact("a", fallback)).collect()]
    assert got == ["20200131", "20210506", "20210506"]
    assert anchor_compact_str("2020-01-31") == "20200131"
    now = dt.datetime(2024, 1, 10, 6, 59, 59, tzinfo=dt.timezone.utc)
    assert anchor_compact_str("0", now) == "20240109"
    assert anchor_compact_str(None, now.replace(hour=7, minute=0, second=0)) == "20240110"


def test_days_between_signed_and_null(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 31), dt.date(2020, 1, 30)), (dt.date(2020, 1, 31), None)],
                               "a date, b date")
    got = [r[0] for r in df.select(days_between("b", "a")).collect()]
    assert got == [-1, None]


def test_clamp(spark):
    df = spark.createDataFrame([(dt.date(2040, 1, 1),), (dt.date(2037, 12, 30),)], "d date")
    assert [r[0] for r in df.select(clamp_far_date("d")).collect()] == [dt.date(1970, 1, 1), dt.date(2037, 12, 30)]


def test_enforce_raises_and_rejects(spark):
    df = spark.createDataFrame([(1, "a", None, None, None), (None, "b", None, None, None)],
                               "id long, isin string, usd_volume double, date_of_end_placing date, maturity_date date")
    with pytest.raises(PySparkException):
        enforce(df, schemas.STRICT_BONDS).collect()
    good, bad = split_rejects(df, schemas.STRICT_BONDS)
    assert [r["id"] for r in good.collect()] == [1]
    assert [r["isin"] for r in bad.collect()] == ["b"]


def test_weights_validation(spark):
    names = schemas.WEIGHT_NAMES
    ok = spark.createDataFrame([(n, 0.2) for n in names], schemas.WEIGHTS)
    assert weights_dict(ok) == {n: 0.2 for n in names}
    assert weights_row(ok).count() == 1
    missing = spark.createDataFrame([(n, 0.2) for n in names[:-1]], schemas.WEIGHTS)
    with pytest.raises(ValueError, match="missing"):
        weights_dict(missing)
    twice = spark.createDataFrame([(n, 0.2) for n in names] + [(names[0], 0.3)], schemas.WEIGHTS)
    with pytest.raises(ValueError, match="2 times"):
        weights_dict(twice)


def test_business_date_ignores_session_zone(spark):
    from tests.conftest import SF001

    events = spark.read.parquet(f"{SF001}/events.parquet")
    expr = business_date("ts", source_zone="UTC").alias("d")
    utc = events.select("event_id", expr).collect()
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        ny = events.select("event_id", expr).collect()
        inst = spark.createDataFrame([(dt.datetime(2024, 1, 10, 7, 0, 0),)], "ts timestamp_ntz").select(
            business_date(F.to_utc_timestamp("ts", "UTC")).alias("d")).first()["d"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert utc == ny
    assert inst == dt.date(2024, 1, 10)


def test_select_weights_projects_any_source(spark):
    from bondliq.sources.jdbc import select_weights

    raw = spark.createDataFrame([(1, "baspread_rel_rank_w", "0.3", "x")], "n long, rank string, weight string, note string")
    out = select_weights(raw)
    assert out.columns == ["rank", "weight"] and out.first()["weight"] == 0.3


def test_anchor_zero_uses_todays_business_date(spark):
    got = spark.range(1).select(anchor_compact(F.lit("0")).alias("a")).first()["a"]
    assert len(got) == 8 and got.isdigit()

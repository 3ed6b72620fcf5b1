"""Hand-checkable golden case: 5 usable bonds (expected values computed by hand)."""

import datetime as dt

from pyspark.sql import types as T

D = dt.date
ANCHOR = "2020-01-31"
WEIGHTS = {
    "baspread_rel_rank_w": 0.30,
    "providers_cnt_rank_w": 0.20,
    "usd_volume_rank_w": 0.10,
    "qdays_cnt_rank_w": 0.25,
    "exchange_indicator_rank_w": 0.15,
}

BONDS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("isin_code", T.StringType()),
    T.StructField("usd_volume", T.DoubleType()), T.StructField("date_of_end_placing", T.DateType()),
    T.StructField("maturity_date", T.DateType()),
])
EXCH_SCHEMA = T.StructType([
    T.StructField("bond", T.LongType()), T.StructField("tg", T.LongType()), T.StructField("date", T.DateType()),
    T.StructField("bid", T.DoubleType()), T.StructField("ask", T.DoubleType()),
])
OTC_SCHEMA = T.StructType([
    T.StructField("bond", T.LongType()), T.StructField("org", T.LongType()), T.StructField("date", T.DateType()),
    T.StructField("quote_type", T.IntegerType()), T.StructField("price", T.DoubleType()),
])


def bonds_rows():
    return [
        (1, "XS01", 500.0, D(2019, 1, 15), D(2029, 1, 15)),
        (2, "XS02", None, D(2018, 6, 1), D(2028, 6, 1)),
        (3, "XS03", 300.0, D(2020, 1, 1), None),
        (4, "XS04", 100.0, None, D(2025, 12, 31)),
        (5, None, 50.0, None, None),
        (None, "XS06", 50.0, None, None),
        (7, "XS07", 200.0, D(2020, 1, 31), D(2020, 1, 30)),
    ]


def exchange_rows(bond7_days=19):
    rows = [(1, 10, D(2020, 1, d), 99.0, 101.0) for d in range(1, 21)]
    rows += [(1, 11, D(2020, 1, 1), 98.0, 102.0), (1, 12, D(2020, 1, 1), 97.0, 103.0),
             (1, 13, D(2020, 1, 1), 96.0, 104.0)]
    rows += [(2, 10, D(2020, 1, 5), 90.0, 110.0), (2, 10, D(2020, 1, 6), 95.0, 105.0)]
    rows += [(7, 10, D(2020, 1, d), 98.0, 102.0) for d in range(1, bond7_days + 1)]
    # to be removed
    rows += [(1, 327, D(2020, 1, 1), 50.0, 150.0), (1, 381, D(2020, 1, 25), 50.0, 150.0),
             (1, 10, D(2020, 1, 26), 99.0, None), (1, None, D(2020, 1, 26), 99.0, 101.0),
             (99, 10, D(2020, 1, 1), 99.0, 101.0)]
    return rows


def otc_rows():
    return [
        (2, 7, D(2020, 1, 5), 1, 95.0), (2, 7, D(2020, 1, 5), 1, 94.0),
        (2, 7, D(2020, 1, 5), 2, 105.0), (2, 7, D(2020, 1, 5), 2, 106.0),
        (3, 7, D(2020, 1, 5), 1, 98.0), (3, 7, D(2020, 1, 5), 2, 102.0),
        (3, 9, D(2020, 1, 6), 1, 97.0), (3, 9, D(2020, 1, 6), 2, 103.0),
        # to be removed
        (2, 8, D(2020, 1, 6), 1, 90.0), (3, 7, D(2020, 1, 5), 3, 100.0),
        (3, 7, D(2020, 1, 7), 1, 0.0), (3, 7, D(2020, 1, 7), 2, None),
    ]


def frames(spark, bond7_days=19):
    return (
        spark.createDataFrame(bonds_rows(), BONDS_SCHEMA),
        spark.createDataFrame(exchange_rows(bond7_days), EXCH_SCHEMA),
        spark.createDataFrame(otc_rows(), OTC_SCHEMA),
    )

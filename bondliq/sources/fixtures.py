"""Input views over the driver's test tables.

The test tables are not quotes, so bonds, exchange quotes and OTC quotes are
derived from ``part`` and ``lineitem``. The modulo conditions below are part of
the fixture definition, not sampling: they plant null keys and prices, the
excluded trading grounds, quote types of neither side, quotes of unlisted bonds
(whose bond has a negative id) and one-market bonds, so that every cleaning rule
and merge branch has rows to act on. Every row of the tables is a row of the views.

The same derivations, as SQL text, are in ``FIXTURE_SQL`` for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Anchor date and weights used with these views (fixed values of the test case)
ANCHOR_DATE = "2001-11-30"
WEIGHTS = {
    "baspread_rel_rank_w": 0.30,
    "providers_cnt_rank_w": 0.20,
    "usd_volume_rank_w": 0.10,
    "qdays_cnt_rank_w": 0.25,
    "exchange_indicator_rank_w": 0.15,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def bonds_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    return p.select(
        _null_when(key % 101 == 100, F.when(key % 7 == 3, -key).otherwise(key)).alias("id"),
        _null_when(key % 89 == 88, F.concat(F.lit("XS"), F.lpad(key.cast("string"), 10, "0"))).alias("isin_code"),
        _null_when(key % 11 == 10, F.col("p_retailprice")).alias("usd_volume"),
        _null_when(size == 50, F.concat(F.lit("19"), (70 + size % 25).cast("string"), F.lit("-06-15")).cast("date"))
        .alias("date_of_end_placing"),
        _null_when(size == 49, F.concat(F.lit("20"), (10 + size).cast("string"), F.lit("-06-15")).cast("date"))
        .alias("maturity_date"),
    )


def exchange_quotes_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    ok, price = F.col("l_orderkey"), F.col("l_extendedprice")
    ground = F.when(F.col("l_partkey") % 10 == 0, F.lit(327)).otherwise(300 + F.col("l_suppkey"))
    return li.select(
        F.col("l_partkey").alias("bond"),
        _null_when(ok % 97 == 1, ground).alias("tg"),
        F.col("l_shipdate").cast("date").alias("date"),
        _null_when(ok % 83 == 2, price * (1 - F.col("l_discount"))).alias("bid"),
        _null_when(ok % 79 == 3, price * (1 + F.col("l_tax"))).alias("ask"),
    )


def otc_quotes_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    price = (
        F.when(ok % 73 == 4, F.lit(None))
        .when(ok % 71 == 5, F.lit(0.0))
        .when(ln % 2 == 0, unit * (1 - F.col("l_discount")))
        .otherwise(unit * (1 + F.col("l_tax")))
    )
    return li.select(
        F.col("l_partkey").alias("bond"),
        (F.col("l_suppkey") % 5).alias("org"),
        F.date_trunc("month", F.col("l_shipdate")).cast("date").alias("date"),
        F.when(F.col("l_partkey") % 10 == 9, F.lit(3)).otherwise(1 + ln % 2).alias("quote_type"),
        price.alias("price"),
    )


def exchange_quotes_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bigger per-day groups (7 rows on average) to exercise the median."""
    li = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice")
    return li.select(
        F.col("l_suppkey").alias("bond"),
        F.col("l_linenumber").cast("long").alias("prov"),
        F.date_trunc("month", F.col("l_shipdate")).cast("date").alias("date"),
        (price * (1 - F.col("l_discount"))).alias("bid"),
        (price * (1 + F.col("l_tax"))).alias("ask"),
    )


def hot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as a quote value of one bond and day, by supplier and side."""
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        F.lit(1).cast("long").alias("bond"), F.col("l_suppkey").alias("prov"), F.lit("2001-01-31").cast("date").alias("date"),
        (F.col("l_linenumber") % 2).alias("side"), (unit * (1 - F.col("l_discount"))).alias("bid"),
        (unit * (1 + F.col("l_tax"))).alias("ask"),
    )


# The same views as SQL text for DuckDB (CTE bodies).
FIXTURE_SQL = {
    "bonds_raw": """
SELECT CASE WHEN p_partkey % 101 = 100 THEN NULL WHEN p_partkey % 7 = 3 THEN -p_partkey ELSE p_partkey END AS id,
  CASE WHEN p_partkey % 89 = 88 THEN NULL ELSE concat('XS', lpad(CAST(p_partkey AS VARCHAR), 10, '0')) END AS isin_code,
  CASE WHEN p_partkey % 11 = 10 THEN NULL ELSE p_retailprice END AS usd_volume,
  CASE WHEN p_size = 50 THEN NULL ELSE CAST(concat('19', CAST(70 + p_size % 25 AS VARCHAR), '-06-15') AS DATE) END AS date_of_end_placing,
  CASE WHEN p_size = 49 THEN NULL ELSE CAST(concat('20', CAST(10 + p_size AS VARCHAR), '-06-15') AS DATE) END AS maturity_date
FROM part""",
    "exchange_quotes_raw": """
SELECT l_partkey AS bond, CASE WHEN l_orderkey % 97 = 1 THEN NULL WHEN l_partkey % 10 = 0 THEN 327 ELSE 300 + l_suppkey END AS tg,
  CAST(l_shipdate AS DATE) AS date,
  CASE WHEN l_orderkey % 83 = 2 THEN NULL ELSE l_extendedprice * (1 - l_discount) END AS bid,
  CASE WHEN l_orderkey % 79 = 3 THEN NULL ELSE l_extendedprice * (1 + l_tax) END AS ask
FROM lineitem""",
    "otc_quotes_raw": """
SELECT l_partkey AS bond, l_suppkey % 5 AS org, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
  CASE WHEN l_partkey % 10 = 9 THEN 3 ELSE 1 + l_linenumber % 2 END AS quote_type,
  CASE WHEN l_orderkey % 73 = 4 THEN NULL WHEN l_orderkey % 71 = 5 THEN 0.0E0
       WHEN l_linenumber % 2 = 0 THEN l_extendedprice / l_quantity * (1 - l_discount)
       ELSE l_extendedprice / l_quantity * (1 + l_tax) END AS price
FROM lineitem""",
    "hot_rows": """
SELECT CAST(1 AS BIGINT) AS bond, l_suppkey AS prov, DATE '2001-01-31' AS date, l_linenumber % 2 AS side,
  l_extendedprice / l_quantity * (1 - l_discount) AS bid, l_extendedprice / l_quantity * (1 + l_tax) AS ask
FROM lineitem""",
    "exchange_quotes_dense": """
SELECT l_suppkey AS bond, CAST(l_linenumber AS BIGINT) AS prov, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
  l_extendedprice * (1 - l_discount) AS bid, l_extendedprice * (1 + l_tax) AS ask
FROM lineitem""",
}

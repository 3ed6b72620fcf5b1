"""The weights table over JDBC (or any table with rank/weight columns)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_weights_jdbc(
    spark: SparkSession, url: str, table: str = "weights", properties: Mapping[str, str] | None = None
) -> DataFrame:
    """(rank string, weight double) from a JDBC table; credentials and driver
    come from the caller's ``properties``."""
    df = spark.read.jdbc(url, table, properties=dict(properties or {}))
    return select_weights(df)


def select_weights(df: DataFrame) -> DataFrame:
    """Project and cast the two weight columns of any source."""
    return df.select(F.col("rank").cast("string").alias("rank"), F.col("weight").cast("double").alias("weight"))

"""The dated CSV inputs, read by header name with fixed types.

Type inference costs an extra pass over each file and is fragile (one bad
value turns a column to string). A positional schema is fragile in another
way: a file with the same columns in another order would silently shift
values. So the files are read as lines, each line is split once into text columns
(``from_csv``; the header gives the names, no inference pass), and each expected column is
taken by name and converted with ``try_cast``; other columns are ignored. A value that does
not convert becomes null; with ``keep_corrupt`` such rows (and rows the CSV parser could
not split) carry their line, as it stands in the file, in ``_corrupt_record``.

``stage_csv`` parses an input once and for all: one job writes good rows and rejected lines
into a staged table, which all later readers use.

Every part file of an input carries the same header line; a different one is a line that
does not convert. Blank lines are skipped.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bondliq import schemas
from bondliq.session import staged, unstage

CORRUPT = "_corrupt_record"
BOM = "﻿"


def header_of(spark: SparkSession, path: str | list[str]) -> str:
    """The first line (one row to the driver)."""
    first = spark.read.text(path).first()
    return first["value"] if first else ""


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, *, keep_corrupt: bool = False
) -> DataFrame:
    header = header_of(spark, path)
    names = next(csv.reader([header.removeprefix(BOM)]), [])
    missing = [f.name for f in schema.fields if f.name not in names]
    if missing or len(set(names)) < len(names):
        raise ValueError(f"{path}: missing columns {missing}" if missing else f"{path}: repeated columns in {names}")
    line = F.col("value")
    lines = spark.read.text(path).where((F.trim(line) != "") & ~line.isin(header, header.removeprefix(BOM)))
    text = ", ".join(f"`{n.replace('`', '``')}` string" for n in [*names, CORRUPT])
    rows = lines.select("value", F.from_csv(line, text, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r"))
    given = {f.name: F.col("r").getField(f.name) for f in schema.fields}
    typed = [given[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields]
    if not keep_corrupt:
        return rows.select(*typed)
    failed = F.col("r").getField(CORRUPT).isNotNull()
    for f in schema.fields:
        failed = failed | (given[f.name].isNotNull() & given[f.name].try_cast(f.dataType).isNull())
    return rows.select(*typed, F.when(failed, line).alias(CORRUPT))


def read_bonds(spark: SparkSession, path: str | list[str], **kw) -> DataFrame:
    """Id, isin_code, usd_volume, date_of_end_placing, maturity_date."""
    return read_csv(spark, path, schemas.BONDS_CSV, **kw)


def read_exchange_quotes(spark: SparkSession, path: str | list[str], **kw) -> DataFrame:
    """Bond, tg, date, bid, ask (date may carry a time; P8 truncates it)."""
    return read_csv(spark, path, schemas.EXCHANGE_CSV, **kw)


def read_otc_quotes(spark: SparkSession, path: str | list[str], **kw) -> DataFrame:
    """S3: bond, org, date, quote_type, price."""
    return read_csv(spark, path, schemas.OTC_CSV, **kw)


@dataclass(frozen=True)
class StagedInput:
    """A parsed input: ``good`` rows, ``rejects`` (key columns and the ``raw`` line), and how
    many of them there are."""

    table: DataFrame
    good: DataFrame
    rejects: DataFrame
    rejected: int

    def unstage(self) -> None:
        unstage(self.table)


def stage_csv(
    spark: SparkSession, reader: Callable[..., DataFrame], paths: Mapping[str, str], name: str, key: str = "anchor"
) -> StagedInput:
    """Parse ``paths`` (key -> path, such as anchor date -> file), each once, in one job that
    splits rows that convert from those that do not. Both keep their key."""
    rows = None
    for value, path in paths.items():
        one = reader(spark, path, keep_corrupt=True).select(F.lit(value).alias(key), "*")
        rows = one if rows is None else rows.unionByName(one)
    seen = Observation("rejected lines")
    bad = F.col(CORRUPT).isNotNull()
    split = rows.withColumn("rejected", bad).observe(seen, F.count(F.when(bad, F.lit(1))).alias("n"))
    table = staged(split, name, by=["rejected"])
    return StagedInput(table, table.where("not rejected").drop("rejected", CORRUPT),
                       table.where("rejected").select(key, F.col(CORRUPT).alias("raw")), int(seen.get["n"] or 0))

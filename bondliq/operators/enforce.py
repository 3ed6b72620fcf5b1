"""Enforce a fixed schema (names, types, non-null columns).

``df.to(schema)`` cannot be used: it rejects every nullable input column at
analysis time, even after an ``isNotNull`` filter. Instead each column is cast
and every non-nullable column is checked per row, either failing the job
(``raise``) or splitting the offending rows off (``reject``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _cast(df: DataFrame, field: T.StructField) -> Column:
    return F.col(field.name).try_cast(field.dataType)


def enforce(df: DataFrame, schema: T.StructType, name: str = "frame", also: Sequence[str] = ()) -> DataFrame:
    """Cast to ``schema``; a null in a non-nullable column fails the job. Columns ``also``
    are kept in front as they are."""
    cols = [F.col(c) for c in also]
    for f in schema.fields:
        c = _cast(df, f)
        if not f.nullable:
            msg = f"{name}: null in non-nullable column {f.name}"
            c = F.when(c.isNull(), F.raise_error(F.lit(msg))).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def violation(schema: T.StructType) -> Column:
    """True where any non-nullable column of ``schema`` is null after the cast."""
    cond = F.lit(False)
    for f in schema.fields:
        if not f.nullable:
            cond = cond | F.col(f.name).try_cast(f.dataType).isNull()
    return cond


def split_rejects(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Cast to ``schema`` and split into (good rows, rejected rows).

    Rejected rows keep the input columns so they can be inspected.
    """
    bad = violation(schema)
    good = df.where(~bad).select(*[_cast(df, f).alias(f.name) for f in schema.fields])
    rejected = df.where(bad)
    return good, rejected

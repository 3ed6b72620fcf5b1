"""Vectors that can take part in a search, in a compact form."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Not null, not empty, not zero, all components finite."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def dtype_of(df: DataFrame, vector: str) -> str:
    """How the components travel between tasks: in their own precision."""
    return "<f4" if "float" in df.schema[vector].dataType.simpleString() else "<f8"


def matrix(packed, dtype: str) -> np.ndarray:
    """Rows of packed bytes as a double matrix."""
    rows = list(packed)
    return np.frombuffer(b"".join(rows), dtype=dtype).reshape(len(rows), -1).astype(np.float64)

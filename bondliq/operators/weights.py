"""Look up the five named weights of the index.

The weights table is configuration (name, weight) of five rows. It is read
once, validated (each name exactly once, nothing else required) and turned
into literals, so Catalyst folds them into the index expression. The read is an
aggregate: one row reaches the driver, whatever the table's size.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondliq.schemas import WEIGHT_NAMES


def weights_row(weights: DataFrame) -> DataFrame:
    """The weights pivoted to one row, one column per name, plus the count of
    rows per name (for validation)."""
    aggs = []
    for name in WEIGHT_NAMES:
        hit = F.col("rank") == F.lit(name)
        aggs.append(F.max(F.when(hit, F.col("weight").cast("double"))).alias(name))
        aggs.append(F.count(F.when(hit, F.lit(1))).alias(f"{name}__n"))
    return weights.agg(*aggs)


def weights_dict(weights: DataFrame | Mapping[str, float]) -> dict[str, float]:
    """Validated {name: weight}; raises naming the missing or repeated weight."""
    if isinstance(weights, Mapping):
        values = {k: float(v) for k, v in weights.items()}
        missing = [n for n in WEIGHT_NAMES if n not in values]
        if missing:
            raise ValueError(f"missing weights: {missing}")
        return {n: values[n] for n in WEIGHT_NAMES}
    row = weights_row(weights).first()
    out = {}
    for name in WEIGHT_NAMES:
        n = row[f"{name}__n"]
        if n == 0:
            raise ValueError(f"missing weight {name!r}")
        if n > 1:
            raise ValueError(f"weight {name!r} given {n} times")
        if row[name] is None:
            raise ValueError(f"weight {name!r} is null")
        out[name] = float(row[name])
    return out

"""Running sums within groups that stay balanced when one group is huge.

``sum(x) over (partition by g order by o)`` puts a whole group in one task.
Here rows are range-partitioned on (g, o) with sampled bounds, so a hot group
spans many partitions; the split is checkpointed to the shared folder (range
bounds are sampled, and every later branch must see the same split); running
sums are taken inside each (group, partition) segment, and per-segment totals
(a group has at most as many segments as there are partitions) are
prefix-summed and joined back as offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bondliq.session import materialize

_P = "_cw_p"


def cumulative_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    sums: Sequence[str],
    prefix: str = "cum_",
    partitions: int | None = None,
) -> DataFrame:
    """Add ``prefix + c`` = sum of ``c`` over the rows of the same ``keys`` up to
    and including this row in ``order`` (rows tied in ``order`` are summed in
    an arbitrary order, so give tied rows zero weight or a total order)."""
    keys, sums = list(keys), list(sums)
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    cols = [*[F.col(k) for k in keys], *order]
    split = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    r = materialize(split.withColumn(_P, F.spark_partition_id()))
    seg = Window.partitionBy(*keys, _P).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = r.select("*", *[F.sum(c).over(seg).alias(f"_run_{c}") for c in sums])
    seg_tot = r.groupBy(*keys, _P).agg(*[F.sum(c).alias(f"_seg_{c}") for c in sums])
    before = Window.partitionBy(*keys).orderBy(_P).rowsBetween(Window.unboundedPreceding, -1)
    offsets = seg_tot.select(
        *keys, _P, *[F.coalesce(F.sum(f"_seg_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sums]
    )
    out = run.join(offsets, [*keys, _P])
    return out.select(
        *df.columns, *[(F.col(f"_off_{c}") + F.col(f"_run_{c}")).alias(f"{prefix}{c}") for c in sums]
    )

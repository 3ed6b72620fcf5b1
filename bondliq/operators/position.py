"""Global position (row_number over the whole table) without a
single-partition window.

``row_number() over (order by ...)`` with no partition key moves every row to
one task. Here the rows are range-partitioned on the sort key (sampled bounds,
so even a heavily tied key is split by the tie-break columns), sorted inside
each partition and numbered locally; the per-partition row counts (one row
per partition, bounded by the partition count, not by the data) are
prefix-summed and broadcast as offsets. The split is checkpointed to the
shared folder so that the counts and the numbered rows come from the same
materialisation (range bounds are sampled, and a second evaluation could
draw other bounds).

``global_positions`` numbers a table in several orders at once without moving its rows: only
(row key, sort key, tie) tables are split by range, all orders in one split, and the
positions are joined back by row key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bondliq.session import materialize

_PID, _IDX, _OFF, _CNT = "_gp_pid", "_gp_idx", "_gp_off", "_gp_cnt"


def global_position(
    df: DataFrame, order: Sequence[Column], alias: str, partitions: int | None = None
) -> DataFrame:
    """Add ``alias`` = 1-based position of each row in ``order`` (bigint).

    ``order`` must be a total order (end it with a unique key) for the result
    to be repeatable; ties are otherwise numbered in an arbitrary order, as
    ``row_number`` does.
    """
    pid = F.spark_partition_id()
    # without an explicit count adaptive execution may merge neighbouring
    # ranges (order is kept); the index is read in the same materialised stage
    split = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    numbered = materialize(
        split
        .sortWithinPartitions(*order)
        .withColumn(_PID, pid)
        # monotonically_increasing_id = (partition index << 33) + row index in partition
        .withColumn(_IDX, F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33))
    )
    counts = numbered.groupBy(_PID).agg(F.count(F.lit(1)).alias(_CNT))
    # a window over one row per partition
    offsets = counts.select(
        _PID,
        F.coalesce(
            F.sum(_CNT).over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias(_OFF),
    )
    return (
        numbered.join(F.broadcast(offsets), _PID)
        .withColumn(alias, (F.col(_OFF) + F.col(_IDX) + 1).cast("bigint"))
        .drop(_PID, _IDX, _OFF)
    )


@dataclass(frozen=True)
class Ranking:
    """One order of a numeric column and the name of the position in it."""

    column: str
    alias: str
    descending: bool
    nulls_first: bool

    def place(self) -> Column:
        """Where nulls and, in a descending order, NaN stand (numbers: 2)."""
        null = F.when(F.col(self.column).isNull(), F.lit(0 if self.nulls_first else 3))
        return (null.when(F.isnan(self.column), F.lit(1)) if self.descending else null).otherwise(F.lit(2))

    def value(self) -> Column:
        v = F.col(self.column).cast("double")
        return -v if self.descending else v


def with_row_key(df: DataFrame, name: str = "_row") -> DataFrame:
    """A unique key per row; it is fixed once the frame is kept (checkpointed)."""
    return df.withColumn(name, F.monotonically_increasing_id())


def global_positions(
    df: DataFrame, rankings: Sequence[Ranking], row_key: str, tie: str, within: Sequence[str] = (), partitions: int | None = None
) -> DataFrame:
    """Add each ranking's 1-based position (bigint), ties to the smaller ``tie``.

    ``row_key`` is a unique column of the (kept) ``df``, at the end of every order; positions
    start anew in each group of the columns ``within``. What is shuffled, sorted and kept are
    rows of (row key, which ranking, sort key, tie); a hot group or a heavily tied key is split
    like any other. The offsets have one row per partition, group and ranking that it holds.
    """
    within = list(within)
    entry = F.explode(F.array(*[F.struct(F.lit(i).alias("_which"), r.place().alias("_place"), r.value().alias("_value"))
                                for i, r in enumerate(rankings)])).alias("_e")
    entries = df.select(F.col(row_key).alias("_row"), F.col(tie).alias("_tie"), *within, entry).select("_row", "_tie", *within, "_e.*")
    section = ["_which", *within]
    order = [*section, "_place", "_value", "_tie", "_row"]
    split = entries.repartitionByRange(partitions, *order) if partitions else entries.repartitionByRange(*order)
    pid = F.spark_partition_id()
    numbered = materialize(split.sortWithinPartitions(*order).select(
        "_row", *section, pid.alias(_PID), (F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)).alias(_IDX)))
    counts = numbered.groupBy(_PID, *section).agg(F.count(F.lit(1)).alias(_CNT))
    # rows of the section in earlier partitions, less those of earlier sections in this one
    earlier = Window.partitionBy(*section).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy(_PID).orderBy(*section).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, *section, (F.coalesce(F.sum(_CNT).over(earlier), F.lit(0))
                                             - F.coalesce(F.sum(_CNT).over(above), F.lit(0))).alias(_OFF))
    placed = numbered.join(offsets, [_PID, *section]).select("_row", "_which", (F.col(_OFF) + F.col(_IDX) + 1).alias("_pos"))
    wide = placed.groupBy("_row").agg(*[F.max(F.when(F.col("_which") == i, F.col("_pos"))).cast("bigint").alias(r.alias)
                                        for i, r in enumerate(rankings)])
    return df.join(wide.withColumnRenamed("_row", row_key), row_key)

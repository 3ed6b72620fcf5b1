"""A1 / A2: lower median per group, exact and safe for hot groups.

The production rule is the *lower* median: for n values the element at
position ceil(n / 2) in ascending order (nulls ignored), as ``percentile_disc
(0.5)`` and DuckDB's ``quantile_disc(x, 0.5)`` define it. ``percentile`` /
``median`` interpolate and are wrong here.

Three exact plans:

* ``window``: ``row_number`` and ``count`` over each group, keep the row at
  rank ceil(n/2). One shuffle and a sort (codegen, spills), but a group sits
  in one task, so it is only used when every group is known to be bounded.
* ``aggregate``: ``percentile_disc`` in one aggregation (map-side partial
  aggregation; the buffer of a group holds its distinct values). Same bound;
  about 2x slower than ``window`` on many small groups.
* ``split``: a hot group is cut into value ranges. Values are pre-aggregated
  to (group, value, count), range-partitioned on (group, value) so a hot
  group spreads over many partitions, the split is checkpointed to the shared
  folder (so every later branch sees the same split and a lost executor
  recomputes nothing else), running counts are taken inside each
  (group, range) segment, and a small per-segment table locates the segment and
  offset of the ceil(n/2)-th element. No task ever holds a whole group.

``lower_median`` picks ``window`` when the largest group is below
``hot_rows`` and ``split`` otherwise; the size check is one aggregation job
unless the caller passes a known bound. ``approx`` is the
``percentile_approx`` form (a bounded, mergeable sketch).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bondliq.session import materialize

# Largest group (rows) one task ranks in the window plan.
HOT_GROUP_ROWS = 1_000_000


def max_group_size(df: DataFrame, keys: Sequence[str], value: str) -> int:
    """Largest number of rows in one group, nulls included: the window plan
    ranks every row of a group in one task (one small job)."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    row = sizes.agg(F.max("_n").alias("m")).first()
    return int(row["m"] or 0)


def median_window(df: DataFrame, keys: Sequence[str], value: str, alias: str, count: str | None = None) -> DataFrame:
    """Exact lower median by ranking inside each group (groups must be bounded).

    Nulls sort last and are not counted; a group without values keeps its
    first row, whose value is null. ``count`` names a column with the number of times that a
    row's value occurs (a histogram: each group has a value, null too, in one row).
    """
    keys = list(keys)
    v = F.col(value)
    grp = Window.partitionBy(*keys)
    place = F.row_number().over(grp.orderBy(v.asc_nulls_last())).alias("_rn")
    if count is None:
        ranked = df.select(*keys, v.alias("_v"), place, F.count(v).over(grp).alias("_n"))
        target = F.greatest(F.floor((F.col("_n") + 1) / 2), F.lit(1))
        return ranked.where(F.col("_rn") == target).select(*keys, F.col("_v").alias(alias))
    weighed = df.select(*keys, v.alias("_v"), F.when(v.isNotNull(), F.col(count)).otherwise(0).cast("long").alias("_c"))
    v = F.col("_v")
    run = grp.orderBy(v.asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = weighed.select(*keys, "_v", "_c", F.sum("_c").over(run).alias("_cum"), F.sum("_c").over(grp).alias("_n"),
                            F.row_number().over(grp.orderBy(v.asc_nulls_last())).alias("_rn"))
    target = F.shiftright(F.col("_n") + 1, 1)  # long division stays exact past 2^53
    hit = (F.col("_cum") >= target) & (F.col("_cum") - F.col("_c") < target)
    return ranked.where(F.when(F.col("_n") == 0, F.col("_rn") == 1).otherwise(hit)).select(*keys, v.alias(alias))


def median_aggregate(df: DataFrame, keys: Sequence[str], value: str, alias: str) -> DataFrame:
    """Exact lower median with one aggregation (groups must be bounded)."""
    return df.groupBy(*keys).agg(
        F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{value}`)").alias(alias)
    )


def median_split(
    df: DataFrame, keys: Sequence[str], value: str, alias: str, partitions: int | None = None, count: str | None = None
) -> DataFrame:
    """Exact lower median that splits hot groups into value ranges (``count`` as for
    ``median_window``). The input is read once: a null stays in the split with weight 0."""
    keys = list(keys)
    if count is None:  # ties collapse map-side, every (group, value) is one row
        w = df.groupBy(*keys, F.col(value).alias("_v")).agg(F.count(value).alias("_c"))
    else:
        w = df.select(*keys, F.col(value).alias("_v"), F.when(F.col(value).isNotNull(), F.col(count)).otherwise(0).cast("long").alias("_c"))
    # range split on (group, value); the checkpoint fixes the split
    cols = [*[F.col(k) for k in keys], F.col("_v")]
    split = w.repartitionByRange(partitions, *cols) if partitions else w.repartitionByRange(*cols)
    r = materialize(split.withColumn("_p", F.spark_partition_id()))
    seg = Window.partitionBy(*keys, "_p")
    run = r.withColumn(
        "_run", F.sum("_c").over(seg.orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    # one row per segment: a group has at most one segment per partition
    segs = r.groupBy(*keys, "_p").agg(F.sum("_c").alias("_seg"))
    grp = Window.partitionBy(*keys)
    before = F.coalesce(
        F.sum("_seg").over(grp.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    target = (
        segs.withColumn("_before", before)
        .withColumn("_k", F.shiftright(F.sum("_seg").over(grp) + 1, 1))
        .where((F.col("_before") < F.col("_k")) & (F.col("_before") + F.col("_seg") >= F.col("_k")))
        .select(*keys, "_p", (F.col("_k") - F.col("_before")).alias("_local_k"))
    )
    hit = (F.col("_run") >= F.col("_local_k")) & (F.col("_run") - F.col("_c") < F.col("_local_k"))
    found = run.join(target, [*keys, "_p"]).where(hit).select(*keys, F.col("_v").alias(alias))
    # groups whose values are all null keep a null median, as an aggregate gives
    empty = (
        r.groupBy(*keys)
        .agg(F.sum("_c").alias("_n"))
        .where(F.col("_n") == 0)
        .select(*keys, F.lit(None).cast(df.schema[value].dataType).alias(alias))
    )
    return found.unionByName(empty)


def median_approx(df: DataFrame, keys: Sequence[str], value: str, alias: str, accuracy: int = 10000) -> DataFrame:
    """``percentile_approx`` lower median: a sketch of bounded size per group."""
    return df.groupBy(*keys).agg(F.percentile_approx(F.col(value), 0.5, accuracy).alias(alias))


def lower_median(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    alias: str,
    *,
    method: str = "exact",
    max_group_rows: int | None = None,
    hot_rows: int = HOT_GROUP_ROWS,
    accuracy: int = 10000,
    count: str | None = None,
) -> DataFrame:
    """Lower median of ``value`` per ``keys``; one row per group, null when the
    group has no non-null value.

    ``method``: ``exact`` (window or split by group size), ``window``,
    ``aggregate``, ``split``, ``approx``. ``max_group_rows`` is a known bound of the largest group;
    when omitted, ``exact`` measures it. ``count`` names a histogram's counts
    (``exact``, ``window`` and ``split``; see ``median_window``).
    """
    if count is not None and method not in ("exact", "window", "split"):
        raise ValueError(f"median method {method!r} takes single rows, not counts")
    if method == "approx":
        return median_approx(df, keys, value, alias, accuracy)
    if method == "window":
        return median_window(df, keys, value, alias, count)
    if method == "aggregate":
        return median_aggregate(df, keys, value, alias)
    if method == "split":
        return median_split(df, keys, value, alias, count=count)
    if method != "exact":
        raise ValueError(f"unknown median method {method!r}")
    if max_group_rows is None:
        max_group_rows = max_group_size(df, keys, value)
    if max_group_rows <= hot_rows:
        return median_window(df, keys, value, alias, count)
    return median_split(df, keys, value, alias, count=count)

"""Connected components of an edge table, by alternating star contractions.

Edges point from the larger id ``a`` to the smaller ``b``. A large-star step moves each
edge's lower end to that end's smallest neighbour; a small-star step links all lower
neighbours of ``a`` to the smallest of them. Both are an aggregation (combined before
the shuffle) and a join whose one side has unique keys, so a hub's edges can be split
over tasks. Rounds are written to the shared folder; they end when nothing changes, as
every edge then leads to its component's smallest id. When no more than ``TASK`` edges
are left, one task ends the work, as rounds of so few cost more than their edges do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondliq.llm.common import let_go, written

#: edges, of two numbers each, that one task takes
TASK = 1_000_000


def lowest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of the edges (a, b), for each node that has a smaller one in its component."""
    known, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[:len(a)], place[len(a):]
    label = np.arange(len(known))
    while True:
        before = label.copy()
        least = np.minimum(label[x], label[y])
        for end in (x, y, before[x], before[y]):
            np.minimum.at(label, end, least)
        label = label[label]
        if (label == before).all():
            break
    smaller = np.flatnonzero(label != np.arange(len(known)))
    return known[smaller], known[label[smaller]]


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = [(x["a"].to_numpy(), x["b"].to_numpy()) for x in batches]
    if found:
        a, b = lowest(*(np.concatenate(x) for x in zip(*found)))
        yield pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _down(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) -> (node, root) for every node that has a smaller one in
    its component; ``root`` is the smallest id reachable. The tables of earlier rounds are
    deleted as soon as the next one is written; ``let_go`` of the result deletes the last."""
    spark = edges.sparkSession
    now = written(_down(edges), "edges")
    state = _state(now)
    while state["n"] > TASK:
        low = now.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("low"))
        large = _down(now.join(low, F.col("b") == F.col("k"), "left").select("a", F.coalesce("low", "b").alias("b")))
        large = written(large, "edges")
        let_go(spark, now)
        low = large.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("low"))
        met = large.join(low, F.col("a") == F.col("k")).select("a", "b", "low")
        ends = F.explode(F.array(F.col("a"), F.col("b")))
        now = written(_down(met.select(ends.alias("a"), F.col("low").alias("b"))), "edges")
        let_go(spark, large)
        before, state = state, _state(now)
        if tuple(state) == tuple(before):
            break
    if 0 < state["n"] <= TASK:
        done = written(now.coalesce(1).mapInArrow(_ended, "a long, b long"), "edges")
        let_go(spark, now)
        now = done
    out = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out.scratch = now.scratch
    return out

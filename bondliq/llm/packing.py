"""Vector best-fit packing of token pieces into sequences.

Every sequence has three capacities: tokens, pieces, and attention cost (the sum of
squared lengths). Pieces go in by falling length; a piece takes the open sequence that
fits under every constraint and whose residual vector after it has the smallest
weighted norm (or whose residual aligns best with the piece, ``rule="dot"``).

A piece's demand depends on its length alone, so the plan is made from the histogram of
lengths: at most ``tokens`` rows reach the driver, whatever the corpus. Sequences in the
same state are planned as one run. Spark then gives each piece its rank among the pieces
of its length, by prefix sums over partitions, and the rank leads to its sequence and
offset. The ranks start from a written table, so a lost executor changes nothing.

Defined results: null text is the empty text, one piece with the end id only; documents
longer than the capacity are cut into full pieces and a rest; repeated rows and rows
without id are packed as documents of their own; an empty table gives an empty table;
other columns are not kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bondliq.llm.common import written
from bondliq.llm.tokens import library_encoder

#: entries of a generation of the encoder's memo; the pipeline's workers hold it beside large heaps
ENTRIES = 300_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"


def pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int) -> DataFrame:
    """Token pieces of ``docs`` (doc_id, text), with their partition and their place
    among that partition's pieces of the same length; written."""
    shared = docs.sparkSession.sparkContext.broadcast(library_encoder(vocabulary, True, ENTRIES))  # its path alone is sent

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = shared.value
        end = np.array([end_id], dtype="<u4").tobytes()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        part = TaskContext.get().partitionId()
        for b in batches:
            out = []
            for doc, ids in zip(b["doc_id"], encoder.ids(b["text"].tolist())):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at:at + 4 * capacity]
                    length = len(cut) // 4
                    out.append((doc, k, at // 4, length, zlib.crc32(cut), part, int(seen[length])))
                    seen[length] += 1
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"]).astype({"doc_id": "Int64"})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return written(rows.mapInPandas(run, PIECES), "pieces")


def plan(lengths: np.ndarray, counts: np.ndarray, capacity: np.ndarray, weights: np.ndarray, rule: str = "norm") -> np.ndarray:
    """Runs (length, first rank, pieces per sequence, first sequence, offset) of a
    best-fit packing of ``counts`` pieces of each of ``lengths``.

    A run of sequences in one state holds ``n`` sequences from ``first`` on."""
    runs: list[tuple[int, int, int, int, int]] = []
    # open states: residual vector, offset, first sequence, number of sequences
    residual = np.empty((0, 3))
    offset = np.empty(0, dtype=np.int64)
    first = np.empty(0, dtype=np.int64)
    n = np.empty(0, dtype=np.int64)
    sequences = 0
    smallest = int(lengths.min()) if len(lengths) else 0
    order = np.argsort(-lengths)
    for length, left in zip(lengths[order].tolist(), counts[order].tolist()):
        demand = np.array([length, 1.0, float(length) ** 2])
        rank = 0
        while left:
            fits = np.flatnonzero((residual >= demand).all(1))
            if len(fits):
                after = residual[fits] - demand
                value = (weights * (after / capacity) ** 2).sum(1) if rule == "norm" else -(weights * demand / capacity * residual[fits] / capacity).sum(1)
                s = int(fits[np.argmin(value)])
                state = residual[s], int(offset[s]), int(first[s]), int(n[s])
            else:
                s, state = -1, (capacity.astype(float), 0, sequences, left)
            room, at, begin, many = state
            per = int(min((room // demand).min(), left))
            used = min(many, -(-left // per))
            full = left // per if left // per <= used else used  # sequences that take `per` pieces
            rest = 0 if full == used else left - full * per
            if s < 0:
                sequences += used
            new = []
            for count, take, start in ((full, per, begin), (used - full, rest, begin + full), (many - used if s >= 0 else 0, 0, begin + used)):
                if count and take:
                    runs.append((length, rank, take, start, at))
                    rank += count * take
                    left -= count * take
                if count and (room - take * demand)[0] >= smallest:
                    new.append((room - take * demand, at + take * length, start, count))
            if s >= 0:
                residual, offset, first, n = (np.delete(x, s, axis=0) for x in (residual, offset, first, n))
            if new:
                residual = np.vstack([residual, [x[0] for x in new]])
                offset, first, n = (np.append(x, [y[i] for y in new]) for i, x in ((1, offset), (2, first), (3, n)))
        keep = residual[:, 0] >= smallest
        residual, offset, first, n = residual[keep], offset[keep], first[keep], n[keep]
    return np.array(runs, dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, vocabulary: str, end_id: int, tokens: int = 4096, max_pieces: int | None = None,
         max_cost: float | None = None, weights: tuple[float, float, float] = (1.0, 1e-6, 1e-6), rule: str = "norm") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``max_pieces`` and ``max_cost`` are the other capacities of a sequence. Left out,
    they are what a sequence of ``tokens`` can reach at most, so they bind nothing and
    the packing has as few sequences as best fit finds for the tokens."""
    spark = docs.sparkSession
    found = pieces(docs, vocabulary, end_id, tokens)
    capacity = np.array([tokens, max_pieces or tokens, max_cost or float(tokens) ** 2])
    if capacity[2] < float(tokens) ** 2 and capacity[2] < 1:
        raise ValueError("max_cost must allow one piece")
    sizes = written(found.groupBy("part", "length").agg(F.count("*").alias("n")), "sizes")
    histogram = sizes.groupBy("length").agg(F.sum("n").alias("n")).orderBy("length").collect()  # `tokens` rows at most
    lengths, counts = (np.array([r[c] for r in histogram], dtype=np.int64) for c in ("length", "n"))
    if len(lengths) and float(lengths.max()) ** 2 > capacity[2]:
        raise ValueError("max_cost is below the cost of one piece")
    runs = plan(lengths, counts, capacity, np.array(weights), rule)
    # runs by (length, first rank); a run's pieces are ranks up to the next one
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    shared = spark.sparkContext.broadcast(runs)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = shared.value
        width = int(table[:, 1].max(initial=0)) + 2
        starts = table[:, 0].astype(object) * width + table[:, 1] if width > 1 << 40 else table[:, 0] * width + table[:, 1]
        for b in batches:
            rank = b["base"].to_numpy() + b["place"].to_numpy()
            length = b["length"].to_numpy()
            run = np.searchsorted(starts, length * width + np.minimum(rank, width - 1), side="right") - 1
            within = rank - table[run, 1]
            per = table[run, 2]
            yield b.drop(columns=["base", "place"]).assign(
                sequence_id=table[run, 3] + within // per, offset=table[run, 4] + within % per * length)

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = found.join(bases, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "place", "base")
    return ranked.mapInPandas(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")

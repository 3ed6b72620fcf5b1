"""Nearest neighbours by multi-index hashing of learned binary codes.

Codes: rotations learned on a bounded sample (alternating sign assignment and
orthogonal Procrustes) turn a centred vector into bits. Codes are cut into substrings;
each index block keeps, per substring, its rows sorted by value with an offset per
value. Two codes within Hamming distance r differ by at most r // substrings bits in
some substring, so probing all values that near to the query's retrieves every code
within r. Retrieved rows are reranked by exact distance.

Radius: the sample also gives the curve h(d), the Hamming distance that ``cover`` of
pairs at Euclidean distance up to d do not exceed. A query starts with a small radius
and widens it until h(distance of its k-th neighbour so far) is covered; with fewer
than k candidates the radius grows up to all bits, which retrieves everything.

Spark deals the rows to index blocks by a hash of the id, so no block is hot, and every
block of queries visits every index block; each visit returns k rows a query at most.

Defined results: a vector that is null, empty, zero, of another length than most, or
has null or non-finite components takes no part, nor do rows without id; rows with the
query's id are not its candidates; equal query rows are one query; ties go to the
smaller id; with fewer than k candidates all are returned; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bondliq.llm.common import written
from bondliq.llm.vectors import dtype_of, matrix, usable

SUBSTRING = 16
BLOCK_ROWS, QUERY_ROWS = 100_000, 20_000
_ONES = np.array([bin(i).count("1") for i in range(1 << SUBSTRING)], dtype=np.uint8)
#: all substring values by their number of set bits: a Hamming ball around 0
_BALL = np.argsort(_ONES, kind="stable").astype(np.uint16)
_BALL_SIZE = np.cumsum(np.bincount(_ONES, minlength=SUBSTRING + 1))


@dataclass
class Codes:
    centre: np.ndarray
    rotations: np.ndarray  # dimension x bits
    distances: np.ndarray  # the curve h
    radii: np.ndarray

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Codes as uint16 substrings."""
        bits = (x - self.centre) @ self.rotations > 0
        return np.packbits(bits, axis=1).view(">u2").astype(np.uint16)

    def radius(self, distance: float) -> int:
        return int(self.radii[min(np.searchsorted(self.distances, distance), len(self.radii) - 1)])


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _ONES[a ^ b].sum(-1, dtype=np.int64)


def learn(sample: np.ndarray, bits: int = 128, steps: int = 25, queries: int = 400, cover: float = 0.985, seed: int = 3) -> Codes:
    d = sample.shape[1]
    rng = np.random.default_rng(seed)
    centre = sample.mean(0)
    x = sample - centre
    found = []
    while sum(r.shape[1] for r in found) < bits:
        r = np.linalg.qr(rng.normal(size=(d, d)))[0]
        for _ in range(steps):
            u, _, v = np.linalg.svd(x.T @ np.where(x @ r > 0, 1.0, -1.0))
            r = u @ v
        found.append(r)
    codes = Codes(centre, np.hstack(found)[:, :bits], np.zeros(1), np.full(1, bits))
    q = rng.permutation(len(x))[:queries]
    own = codes.encode(sample)
    dist, ham = [], []
    for i in q:
        e = np.sqrt(((sample - sample[i]) ** 2).sum(1))
        e[i] = np.inf
        near = np.argsort(e)[:50]
        dist.append(e[near])
        ham.append(hamming(own[near], own[i]))
    dist, ham = np.concatenate(dist), np.concatenate(ham)
    order = np.argsort(dist)
    parts = np.array_split(order, max(1, min(40, len(order) // 200)))
    parts = [p for p in parts if len(p) and np.isfinite(dist[p[-1]])]
    if parts:
        codes.distances = np.array([dist[p[-1]] for p in parts])
        top = np.maximum.accumulate([int(np.ceil(np.quantile(ham[p], cover))) for p in parts])
        codes.radii = np.append(top, bits)  # beyond what the sample has seen: everything
    return codes


class Block:
    """The substring indexes of one block of rows."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, codes: Codes):
        self.ids, self.x, self.codes = ids, x, codes
        self.code = codes.encode(x)
        self.order = [np.argsort(c, kind="stable") for c in self.code.T]
        self.offset = [np.searchsorted(c[o], np.arange((1 << SUBSTRING) + 1)) for c, o in zip(self.code.T, self.order)]

    def within(self, code: np.ndarray, r: int) -> np.ndarray:
        """Rows whose codes are within Hamming distance ``r``."""
        s = len(code)
        ball = _BALL[:_BALL_SIZE[min(r // s, SUBSTRING)]]
        met = np.zeros(len(self.ids), dtype=bool)
        for k in range(s):
            values = (ball ^ code[k]).astype(np.int64)
            begin, end = self.offset[k][values], self.offset[k][values + 1]
            some = end > begin
            begin, size = begin[some], (end - begin)[some]
            at = np.arange(size.sum()) + np.repeat(begin - np.cumsum(size) + size, size)
            met[self.order[k][at]] = True
        rows = np.flatnonzero(met)
        return rows[hamming(self.code[rows], code) <= r]

    def search(self, query_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        code = self.codes.encode(q[None])[0]
        bits = SUBSTRING * len(code)
        others = int((self.ids != query_id).sum())
        r = len(code) - 1
        while True:
            rows = self.within(code, r)
            rows = rows[self.ids[rows] != query_id]
            d = np.sqrt(((self.x[rows] - q) ** 2).sum(1))
            best = np.lexsort((self.ids[rows], d))[:k]
            if r >= bits or len(rows) == others:
                break
            need = self.codes.radius(d[best[-1]]) if len(best) == k else min(bits, max(2 * r, bits // 4))
            if need <= r:
                break
            r = need
        return self.ids[rows[best]], d[best]


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, sample_rows: int = 20_000, bits: int = 128) -> DataFrame:
    """``vectors`` and ``queries`` (vec_id, embedding): per query its ``k`` nearest found:
    query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    dtype = dtype_of(vectors, "embedding")

    def packed(df: DataFrame) -> DataFrame:
        good = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v")).where(
            F.col("vec_id").isNotNull() & usable("v"))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield pd.DataFrame({"vec_id": b["vec_id"], "packed": [np.asarray(v, dtype=dtype).tobytes() for v in b["v"]]})

        return good.mapInPandas(run, "vec_id long, packed binary")

    rows = written(packed(vectors), "vectors")
    asked = written(packed(queries).distinct(), "queries")
    sizes = rows.groupBy(F.length("packed").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], schema)
    size, n = sizes[0]["size"], sizes[0]["count"]
    rows, asked = (df.where(F.length("packed") == size) for df in (rows, asked))
    share = min(1.0, sample_rows / n)
    sample = rows.where(F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(1 << 53)) < int(share * (1 << 53))).orderBy(
        F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(sample_rows).collect()  # bounded
    x = matrix((r["packed"] for r in sample), dtype) if sample else np.zeros((1, size // np.dtype(dtype).itemsize))
    bits = max(SUBSTRING, bits // SUBSTRING * SUBSTRING)
    shared = spark.sparkContext.broadcast(learn(x, bits))

    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // BLOCK_ROWS))
    parts = max(1, -(-asked.count() // QUERY_ROWS))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    part = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(parts)).cast("int")

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = rows.select(block.alias("block"), every(parts).alias("part"), "vec_id", "packed")
    right = asked.select(every(blocks).alias("block"), part.alias("part"), "vec_id", "packed")

    def visit(index: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(index) and len(asking):
            here = Block(index["vec_id"].to_numpy(), matrix(index["packed"], dtype), shared.value)
            for q, v in zip(asking["vec_id"].to_numpy(), matrix(asking["packed"], dtype)):
                ids, d = here.search(q, v, k)
                out.append(pd.DataFrame({"query_id": q, "vec_id": ids, "score": d}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    found = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInPandas(
        visit, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")

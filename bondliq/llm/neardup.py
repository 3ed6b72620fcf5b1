"""Embedding near-duplicates: random-hyperplane sign hashing, exact cosines, components.

Every vector is hashed in several tables by the signs of its products with random
hyperplanes; vectors that share a bucket in any table are compared exactly. Bits per
table follow the number of vectors (about ``BUCKET`` rows to a random bucket), and the
number of tables follows from the bits, so that a pair exactly at the threshold is
missed with probability ``miss`` at most, at every size.

Buckets are compared as matrix products. A large bucket is cut into chunks and its
chunk pairs are dealt to separate tasks; tasks return counts and each vector's lowest
partner, never pairs. A pair that meets in several tables counts in the first one.
Equal vectors are folded into one beforehand and counted by their number.

Defined results: a vector that is null, empty, zero or has null or non-finite
components links with nothing and is kept; vectors of different lengths do not link;
rows without id are left out; equal rows link with each other; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondliq.llm.common import written
from bondliq.llm.components import components
from bondliq.llm.vectors import dtype_of, matrix, usable

BUCKET, CHUNK = 256, 1500


def table_shape(rows: int, threshold: float, miss: float) -> tuple[int, int]:
    """Bits per table and number of tables for ``rows`` vectors."""
    bits = min(30, max(4, math.ceil(math.log2(max(rows, 2) / BUCKET))))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - meet))


def signatures(reps: DataFrame, bits: int, tables: int, dtype: str, seed: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes: dict[int, np.ndarray] = {}
        powers = 1 << np.arange(bits, dtype=np.int64)
        for b in batches:
            sigs, packed = [], []
            for v in b["vector"]:
                v = np.asarray(v, dtype=dtype)
                d = len(v)
                if d not in planes:
                    planes[d] = np.random.default_rng([seed, d]).normal(size=(d, bits * tables))
                sigs.append((((v.astype(float) @ planes[d]) > 0).reshape(tables, bits) @ powers).astype("int32"))
                packed.append(v.tobytes())
            yield b.drop(columns=["vector"]).assign(packed=packed, sigs=sigs)

    return reps.mapInPandas(run, "id long, copies long, packed binary, sigs array<int>")


def links(signed: DataFrame, threshold: float, dtype: str) -> DataFrame:
    """(id, links, low): new links found for a vector in one group of a bucket, and the
    smallest id it is connected with there."""
    rows = signed.select("id", "copies", "packed", "sigs", F.length("packed").alias("size"),
                         F.posexplode("sigs").alias("tab", "sig"))
    key = ["tab", "sig", "size"]
    counts = rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
    cut = rows.join(counts, key).withColumn("chunks", F.ceil(F.col("n") / CHUNK).cast("int"))
    own = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    dealt = cut.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "id", "copies", "packed", "sigs", *key, "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        pdf = pdf.sort_values(["own", "id"])
        lo, hi, t = first["lo"], first["hi"], first["tab"]
        ids, copies = pdf["id"].to_numpy(), pdf["copies"].to_numpy()
        x = matrix(pdf["packed"], dtype)
        x /= np.abs(x).max(1)[:, None]
        norm = np.sqrt((x * x).sum(1))
        close = (x @ x.T) / np.outer(norm, norm) >= threshold
        np.fill_diagonal(close, False)
        sigs = np.stack(pdf["sigs"].to_list())
        fresh = close.copy()
        if lo != hi:  # pairs inside a chunk belong to that chunk's own group
            side = pdf["own"].to_numpy()
            fresh &= side[:, None] != side[None, :]
        for k in range(t):
            if not fresh.any():
                break
            fresh &= sigs[:, k][:, None] != sigs[:, k][None, :]
        found = fresh @ copies
        low = ids.copy()
        linked = np.flatnonzero(close.any(1))
        sub, label = close[np.ix_(linked, linked)], ids[linked]
        while len(linked):
            down = np.minimum(label, np.where(sub, label[None, :], np.iinfo(np.int64).max).min(1))
            if (down == label).all():
                break
            label = down
        low[linked] = label
        keep = (found > 0) | (low != ids)
        return pd.DataFrame({"id": ids[keep], "links": found[keep], "low": low[keep]})

    return dealt.groupBy(*key, "lo", "hi").applyInPandas(verify, "id long, links long, low long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, miss: float = 1e-4, seed: int = 11,
                    vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector")).where("vec_id is not null")
    good = rows.where(usable("vector"))
    reps = written(good.groupBy("vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "vectors")
    dtype = dtype_of(rows, "vector")
    bits, tables = table_shape(reps.count(), threshold, miss)
    signed = written(signatures(reps.select("id", "copies", "vector"), bits, tables, dtype, seed), "signatures")
    found = written(links(signed, threshold, dtype), "links")
    roots = components(found.select(F.col("id").alias("a"), F.col("low").alias("b"))
                       .unionByName(rows.join(reps, "vector").select(F.col("vec_id").alias("a"), F.col("id").alias("b"))))
    sums = found.groupBy("id").agg(F.sum("links").alias("links"))
    per_rep = reps.join(sums, "id", "left").select("vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.join(per_rep, "vector", "left").join(roots, F.col("vec_id") == F.col("node"), "left")
    root = F.coalesce("root", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      root.alias("component_id"), (root == F.col("vec_id")).alias("kept"))

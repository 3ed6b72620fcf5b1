"""Token ids as flat binary files with 64-bit document offsets.

A corpus is a folder of parts in ascending document order. Part ``k`` has three files:
``ids`` (flat little-endian unsigned integers, 16 bits if the vocabulary fits, else
32), ``offsets`` (64-bit, one more than documents, counted inside the part) and
``docs`` (64-bit document ids; the smallest value stands for null). The manifest holds
each part's base, the prefix sum of the ids before it, so a document's global offset
is base + offset. Readers map the files into memory.

Recovery: a task writes under a name of its own and renames at the end, so a task
that is run again, or twice, leaves the same files. Folders are fresh per call.

Defined results: null text is the empty text and holds the end id only; equal ids are
ordered by their text's hash; null ids come first; an empty table gives no parts;
other columns are not kept.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bondliq.llm.common import fresh_path, let_workers_import, local_path
from bondliq.llm.tokens import library_encoder

NO_ID = np.iinfo(np.int64).min
PART_SCHEMA = "part long, n_docs long, n_tokens long, width int"


def _store(path: str):
    """Arrow's file system and the path in it; the plain local one for file paths."""
    from pyarrow import fs

    here = local_path(path)
    return (fs.LocalFileSystem(), here) if here else fs.FileSystem.from_uri(path)


def _mapped(path: str, dtype: str) -> np.ndarray:
    """A flat file as an array: mapped where the path is local, else read."""
    here = local_path(path)
    if here:
        return np.memmap(here, dtype=dtype, mode="r") if os.path.getsize(here) else np.empty(0, dtype)
    store, there = _store(path)
    with store.open_input_file(there) as f:
        return np.frombuffer(f.read(), dtype=dtype)


def write(df: DataFrame, path: str, vocabulary: str, end_id: int, parts: int | None = None) -> DataFrame:
    """Write ``df`` (doc_id, text) below ``path`` and return the manifest
    (part, n_docs, n_tokens, width, base)."""
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(library_encoder(vocabulary))  # its path alone is sent

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        encoder = shared.value
        width = 2 if max(encoder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        end = np.array([end_id], dtype="<u4").tobytes()
        store, there = _store(path)
        store.create_dir(there, recursive=True)
        names = {x: f"{there}/{x}-{part:06d}" for x in ("ids", "offsets", "docs")}
        own = {x: f"{n}.{attempt}" for x, n in names.items()}
        counts, docs = [np.zeros(1, dtype="<i8")], []
        with store.open_output_stream(own["ids"]) as out:
            for b in batches:
                ids = [x + end for x in encoder.ids(b["text"].tolist())]
                counts.append(np.array([len(x) // 4 for x in ids], dtype="<i8"))
                docs.append(b["doc_id"].to_numpy(dtype="<i8"))
                flat = b"".join(ids)
                out.write(np.frombuffer(flat, dtype="<u4").astype("<u2").tobytes() if width == 2 else flat)
        offsets = np.cumsum(np.concatenate(counts))
        for x, data in (("offsets", offsets), ("docs", np.concatenate([*docs, np.empty(0, "<i8")]))):
            with store.open_output_stream(own[x]) as out:
                out.write(data.astype("<i8").tobytes())
        for x, name in names.items():
            store.move(own[x], name)
        yield pd.DataFrame({"part": [part], "n_docs": [len(offsets) - 1], "n_tokens": [int(offsets[-1])], "width": [width]})

    rows = df.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_ID))).alias("doc_id"),
                     F.coalesce("text", F.lit("")).alias("text")).withColumn("_tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(parts, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
    sizes = rows.drop("_tie").mapInPandas(run, PART_SCHEMA)
    # one row per part; the manifest is written, so the parts are made once
    sizes.write.parquet(f"{path}/sizes")
    sizes = spark.read.schema(PART_SCHEMA).parquet(f"{path}/sizes")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    manifest = sizes.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    manifest.write.parquet(f"{path}/manifest")
    return open_manifest(spark, path)


def open_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PART_SCHEMA + ", base long").parquet(f"{path}/manifest")


def read(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """The documents of a corpus: doc_id, start, n_tokens and ``ids`` (binary,
    little-endian uint32) or, with ``digest``, their crc32 as ``ids_crc32``."""
    let_workers_import(spark)
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for m in b.itertuples():
                ids = _mapped(f"{path}/ids-{m.part:06d}", f"<u{m.width}")
                offsets = _mapped(f"{path}/offsets-{m.part:06d}", "<i8")
                docs = _mapped(f"{path}/docs-{m.part:06d}", "<i8")
                for k in range(0, m.n_docs, 1000):
                    at = offsets[k:k + 1001]
                    data = [ids[i:j].astype("<u4").tobytes() for i, j in zip(at[:-1], at[1:])]
                    doc = docs[k:k + 1000]
                    out = pd.DataFrame({"doc_id": pd.array(doc, dtype="Int64"), "start": m.base + at[:-1], "n_tokens": np.diff(at)})
                    out.loc[doc == NO_ID, "doc_id"] = pd.NA
                    yield out.assign(**({"ids_crc32": [zlib.crc32(x) for x in data]} if digest else {"ids": data}))

    manifest = open_manifest(spark, path)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids binary")
    return manifest.repartition(parts, "part").mapInPandas(run, schema)


def written_and_read(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    spark = docs.sparkSession
    path = fresh_path(spark, "tokens")
    write(docs, path, vocabulary, end_id)
    return read(spark, path, digest=True)

"""Product codes of vectors, learned by dual-tree Lloyd rounds in whole numbers.

A component x becomes floor(1024 x). Vectors are cut into consecutive parts, each with a
codebook of at most 256 entries that starts as that part of the smallest ids. A round
assigns every part to its nearest entry (squared Euclidean distance, ties to the lower
index) and moves each entry to the floor of its parts' mean.

Rows stay where Spark has put them: a task cuts its rows into blocks of ``BLOCK`` vectors
and builds, once for all rounds, a tree over each block's parts, whose nodes keep a box and
the cached sum of their parts. In a round a task walks this tree against a tree over the
entries: a node of entries goes when its box is farther from the parts' box than another
one's farthest corner, and a single entry goes when another one is nearer to every point of
the parts' box. A node with one entry left is assigned as a whole through its cached sum;
the parts of a leaf with several are decided by their own distances. Tasks return one sum
for each part and entry, so what is shuffled and sent to the driver is bounded by the size
of the codebooks and the number of tasks.

All numbers are whole. They are held in doubles where the largest component proves every
distance and sum below 2^53, else as Python integers. Sums leave the tasks in limbs of 32
bits, which cannot overflow.

Defined results: rows whose vector is null, empty, or holds null or non-finite components
are left out, and so are vectors of a less common length (of equally common ones the longer
stays); a length that 4 does not divide is cut at the whole number below each quarter; rows
without id come last among the ids, and equal ids are ordered by their vectors; equal rows
are rows of their own; with fewer rows than entries the codebook is as short as the rows; an
error beyond 64 bits is null, as is the sum of its label; an empty table gives an empty
table; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bondliq.llm.common import let_go, written

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
BLOCK, LEAF, ENTRY_LEAF = 2048, 24, 4
LIMB = 32
#: numbers of a tree's arrays, in the order in which they are stored
TREE = ("points", "order", "start", "end", "left", "right", "lo", "hi", "sums")


def floors(values: np.ndarray, exact: bool) -> np.ndarray:
    """floor(SCALE * x) as whole doubles, or as Python integers."""
    if exact:
        return np.floor(values.astype(np.float64) * SCALE)
    return np.array([[int(x) * SCALE if abs(x) > 2.0 ** 53 else int(np.floor(x * SCALE)) for x in row] for row in values.astype(np.float64).tolist()],
                    dtype=object).reshape(values.shape)


def cuts(size: int) -> list[int]:
    return [size * p // PARTS for p in range(PARTS + 1)]


def grow(x: np.ndarray, leaf: int) -> dict[str, np.ndarray]:
    """A tree over the rows of ``x``: nodes halve their rows on their widest side."""
    order = np.arange(len(x))
    start, end, left, right, lo, hi, sums = [0], [len(x)], [], [], [], [], []
    at = 0
    while at < len(start):
        own = order[start[at]:end[at]]
        rows = x[own]
        low, high = rows.min(0), rows.max(0)
        lo.append(low), hi.append(high), sums.append(rows.sum(0))
        wide = int(np.argmax(high - low)) if len(low) else 0
        if len(own) <= leaf or not len(low) or high[wide] == low[wide]:
            left.append(-1), right.append(-1)
        else:
            order[start[at]:end[at]] = own[np.argsort(rows[:, wide], kind="stable")]
            middle = (start[at] + end[at]) // 2
            left.append(len(start)), right.append(len(start) + 1)
            start += [start[at], middle]
            end += [middle, end[at]]
        at += 1
    shape = (len(start), x.shape[1])
    return {"points": x[order], "order": order, "start": np.array(start), "end": np.array(end), "left": np.array(left), "right": np.array(right),
            "lo": np.array(lo, dtype=x.dtype).reshape(shape), "hi": np.array(hi, dtype=x.dtype).reshape(shape),
            "sums": np.array(sums, dtype=x.dtype).reshape(shape)}


def packed(numbers: np.ndarray, width: int) -> bytes:
    if width == 8:
        return numbers.astype("<i8").tobytes()
    return b"".join(int(v).to_bytes(width, "little", signed=True) for v in numbers.ravel())


def unpacked(data: bytes, width: int) -> np.ndarray:
    if width == 8:
        return np.frombuffer(data, dtype="<i8")
    return np.array([int.from_bytes(data[i:i + width], "little", signed=True) for i in range(0, len(data), width)], dtype=object)


def stored(tree: dict[str, np.ndarray], width: int) -> dict[str, bytes]:
    return {k: packed(tree[k], width if k in ("points", "lo", "hi", "sums") else 8) for k in TREE}


def restored(row: dict[str, bytes], size: int, width: int) -> dict[str, np.ndarray]:
    out = {k: unpacked(row[k], 8) for k in ("order", "start", "end", "left", "right")}
    for k in ("points", "lo", "hi", "sums"):
        flat = unpacked(row[k], width)
        count = len(out["order"] if k == "points" else out["start"])
        out[k] = (flat.astype(np.float64) if width == 8 else flat).reshape(count, size)
    return out


def assigned(tree: dict[str, np.ndarray], entries: np.ndarray, add: Callable[[int, int, np.ndarray], None] | None = None) -> np.ndarray:
    """The nearest entry of every point, in the tree's order. ``add`` gets (entry, number,
    sum) of whole nodes from their cached sums, and of single points."""
    over = grow(entries, ENTRY_LEAF)
    squares = (entries * entries).sum(1)
    code = np.empty(len(tree["order"]), dtype=np.int64)
    todo: list[tuple[int, np.ndarray, bool]] = [(0, np.array([0]), True)]
    while todo:
        node, some, nodes = todo.pop()
        lo, hi, a, b = tree["lo"][node], tree["hi"][node], tree["start"][node], tree["end"][node]
        leaf = tree["left"][node] < 0
        while nodes:  # ``some`` are nodes of entries
            elo, ehi = over["lo"][some], over["hi"][some]
            gap = np.maximum(np.maximum(elo - hi, lo - ehi), 0)
            far = np.maximum(hi - elo, ehi - lo)
            some = some[(gap * gap).sum(1) <= (far * far).sum(1).min()]
            inner = over["left"][some] >= 0
            if not inner.any():
                some = np.sort(np.concatenate([over["order"][over["start"][e]:over["end"][e]] for e in some]))
                nodes = False
            else:
                some = np.concatenate([some[~inner], over["left"][some[inner]], over["right"][some[inner]]])
                if not leaf:
                    break
        if not nodes:  # ``some`` are entries, ascending
            two = 2 * entries[some] - (lo + hi)
            best = int(some[np.argmin((two * two).sum(1))])
            away = entries[some] - entries[best]
            reach = 2 * np.where(away > 0, hi * away, lo * away).sum(1)
            beaten = (reach < squares[some] - squares[best]) | ((reach == squares[some] - squares[best]) & (some > best))
            some = some[~beaten | (some == best)]
            if len(some) == 1:
                code[a:b] = best
                if add:
                    add(best, int(b - a), tree["sums"][node])
                continue
        if not leaf:
            todo += [(int(tree["left"][node]), some, nodes), (int(tree["right"][node]), some, nodes)]
            continue
        points = tree["points"][a:b]
        nearest = some[np.argmin(squares[some][None, :] - 2 * (points @ entries[some].T), axis=1)]
        code[a:b] = nearest
        if add:
            for e in np.unique(nearest):
                own = points[nearest == e]
                add(int(e), len(own), own.sum(0))
    return code


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column without nulls as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def blocks(kept: DataFrame, size: int, width: int) -> DataFrame:
    """One row per block: its ids and labels, and one stored tree per part."""
    at = cuts(size)
    tree_t = T.StructType([T.StructField(k, T.BinaryType()) for k in TREE])
    schema = T.StructType([T.StructField("ids", T.ArrayType(kept.schema["vec_id"].dataType)), T.StructField("labels", T.ArrayType(kept.schema["label"].dataType)),
                           T.StructField("trees", T.ArrayType(tree_t))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                cut = batch.slice(first, BLOCK)
                x = floors(_matrix(cut.column("vector")), width == 8)
                trees = [stored(grow(x[:, at[p]:at[p + 1]], LEAF), width) for p in range(PARTS)]
                own = [pa.ListArray.from_arrays(pa.array([0, cut.num_rows], pa.int32()), cut.column(k)) for k in ("vec_id", "label")]
                binary = pa.struct([(k, pa.binary()) for k in TREE])
                yield pa.RecordBatch.from_arrays([*own, pa.array([trees], pa.list_(binary))], names=["ids", "labels", "trees"])

    return kept.select("vec_id", "label", "vector").mapInArrow(run, schema)


def round_sums(held: DataFrame, books: list[np.ndarray], size: int, width: int, limbs: int) -> list[dict[int, tuple[int, list[int]]]]:
    """Per part: entry -> (number of its parts, their sum), all parts assigned to ``books``."""
    at = cuts(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = [np.zeros(len(b), dtype=np.int64) for b in books]
        sums = [np.zeros(b.shape, dtype=object if width != 8 else np.int64) for b in books]
        for batch in batches:
            for trees in batch.column("trees").to_pylist():
                for p in range(PARTS):
                    def add(e: int, n: int, s: np.ndarray) -> None:
                        numbers[p][e] += n
                        sums[p][e] += s if width != 8 else s.astype(np.int64)
                    assigned(restored(trees[p], at[p + 1] - at[p], width), books[p], add)
        out = []
        for p in range(PARTS):
            for e in np.flatnonzero(numbers[p]):
                rest, cells = sums[p][e], []
                for _ in range(limbs - 1):
                    cells.append(rest & ((1 << LIMB) - 1))
                    rest = rest >> LIMB
                cells.append(rest)
                flat = [int(v) for cell in zip(*cells) for v in cell]
                out.append((p, int(e), int(numbers[p][e]), flat))
        if out:
            part, entry, n, flat = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n, pa.int64()),
                                              pa.array(flat, pa.list_(pa.int64()))], names=["part", "entry", "n", "cells"])

    per_task = held.select("trees").mapInArrow(run, "part int, entry int, n long, cells array<long>")
    # at most PARTS x ENTRIES x part size x limbs rows, whatever the table holds
    totals = per_task.select("part", "entry", "n", F.posexplode("cells").alias("i", "cell")).groupBy("part", "entry", "i").agg(
        F.sum("n").alias("n"), F.sum("cell").alias("cell"))
    found: list[dict] = [{} for _ in range(PARTS)]
    for row in totals.toArrow().sort_by([("part", "ascending"), ("entry", "ascending"), ("i", "ascending")]).to_pylist():
        n, flat = found[row["part"]].setdefault(row["entry"], (row["n"], []))
        if row["i"] % limbs == 0:
            flat.append(0)
        flat[-1] += row["cell"] << (LIMB * (row["i"] % limbs))
    return found


def coded(held: DataFrame, books: list[np.ndarray], size: int, width: int, digest: str) -> DataFrame:
    """vec_id, label, code, error, codebooks_sha256 of every vector of the blocks."""
    at = cuts(size)
    ids, labels = held.schema["ids"].dataType.elementType, held.schema["labels"].dataType.elementType
    schema = T.StructType([T.StructField("vec_id", ids), T.StructField("label", labels), T.StructField("code", T.StringType()),
                           T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                trees = batch.column("trees")[i].as_py()
                n = len(unpacked(trees[0]["order"], 8))
                code, error = np.empty((n, PARTS), dtype=np.int64), np.zeros(n, dtype=object)
                for p in range(PARTS):
                    tree = restored(trees[p], at[p + 1] - at[p], width)
                    nearest = assigned(tree, books[p])
                    gap = tree["points"] - books[p][nearest]
                    code[tree["order"], p] = nearest
                    error[tree["order"]] += np.array([int(v) for v in (gap * gap).sum(1)], dtype=object)
                own = [batch.column(k).slice(i, 1).flatten() for k in ("ids", "labels")]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(["".join(f"{c:02x}" for c in row) for row in code.tolist()], pa.string()),
                     pa.array([e if e < 2**63 else None for e in error], pa.int64())], names=["vec_id", "label", "code", "error"])

    return held.mapInArrow(run, schema).withColumn("codebooks_sha256", F.lit(digest))


def learn(kept: DataFrame, held: DataFrame, size: int, width: int, rows: int, largest: int) -> list[np.ndarray]:
    """The codebooks after all rounds."""
    at = cuts(size)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector").limit(ENTRIES).toArrow()  # ENTRIES rows
    start = floors(_matrix(first.column("vector").combine_chunks()), width == 8)
    books = [start[:, at[p]:at[p + 1]].copy() for p in range(PARTS)]
    limbs = max(1, -(-((largest + 1) * rows).bit_length() // LIMB)) if (largest + 1) * rows >= 2**62 else 1
    for _ in range(ROUNDS):
        for p, found in enumerate(round_sums(held, books, size, width, limbs)):
            for e, (n, total) in found.items():
                books[p][e] = [v // n for v in total]
    return books


def vector_codes(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Per row: vec_id, code, error, label_error, codebooks_sha256."""
    spark = vectors.sparkSession
    v = F.col("vector")
    fit = F.coalesce((F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"), F.col(label).alias("label")).where(fit)
    lengths = rows.groupBy(F.size(v).alias("size")).agg(F.count("*").alias("n"), F.max(F.array_max(F.transform(v, lambda x: F.abs(x.cast("double"))))).alias("top"))
    most = lengths.orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    if not most:
        none = rows.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"),
                           F.lit("").alias("codebooks_sha256"))
        return none.where(F.lit(False))
    size, count, top = most[0]["size"], most[0]["n"], most[0]["top"]
    largest = int(top) * SCALE + SCALE
    exact = max(size, BLOCK, ENTRIES) * (4 * largest) ** 2 < 2**53
    width = 8 if exact else max(9, (largest * BLOCK).bit_length() // 8 + 1)  # 8 bytes stand for doubles
    kept = rows.where(F.size(v) == size)
    held = written(blocks(kept, size, width), "blocks")
    books = learn(kept, held, size, width, count, largest)
    digest = hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()
    codes = written(coded(held, books, size, width, digest), "codes")
    let_go(spark, held)
    per_label = codes.groupBy(F.col("label").alias("_label")).agg(
        F.when(F.count("error") == F.count("*"), F.try_sum("error")).alias("label_error"))
    return codes.join(per_label, F.col("label").eqNullSafe(F.col("_label"))).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def oracle() -> str:
    """DuckDB SQL for ``vector_codes`` over the view ``embeddings``, for vectors of one length."""
    steps, book = [], "book0"
    for r in range(ROUNDS + 1):
        steps.append(f"""
gaps{r} AS (SELECT x.row_no, x.part, b.entry, sum((x.v - b.v) * (x.v - b.v)) AS d FROM cells x JOIN {book} b ON x.part = b.part AND x.i = b.i
    GROUP BY x.row_no, x.part, b.entry),
near{r} AS (SELECT row_no, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM gaps{r} GROUP BY row_no, part)""")
        if r < ROUNDS:
            steps.append(f"""
book{r + 1} AS (SELECT o.part, o.entry, o.i, coalesce(m.v, o.v) AS v FROM {book} o LEFT JOIN (
    SELECT x.part, n.entry, x.i, (sum(x.v) - ((sum(x.v) % count(*)) + count(*)) % count(*)) // count(*) AS v
    FROM cells x JOIN near{r} n ON x.row_no = n.row_no AND x.part = n.part GROUP BY x.part, n.entry, x.i) m
    ON o.part = m.part AND o.entry = m.entry AND o.i = m.i)""")
            book = f"book{r + 1}"
    return f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS row_no, vec_id, label, embedding FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
flat AS (SELECT row_no, unnest(embedding) AS x, unnest(range(len(embedding))) AS k, len(embedding) // {PARTS} AS w FROM kept),
cells AS (SELECT row_no, k // w AS part, k % w AS i, CAST(floor(CAST({SCALE} AS DOUBLE) * x) AS HUGEINT) AS v FROM flat),
book0 AS (SELECT part, row_no AS entry, i, v FROM cells WHERE row_no < {ENTRIES}),{",".join(steps)},
codes AS (SELECT k.row_no, k.vec_id, k.label, string_agg(printf('%02x', n.entry), '' ORDER BY n.part) AS code, CAST(sum(n.d) AS BIGINT) AS error
    FROM kept k JOIN near{ROUNDS} n USING (row_no) GROUP BY k.row_no, k.vec_id, k.label),
books AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, i)) AS codebooks_sha256 FROM {book})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM codes, books"""

"""An n-gram language model in an Elias-Fano trie, trained and queried by Spark.

Texts. Each text is cut into words once. A block of texts is one flat file: the hashes of
its distinct words in order, and each token as its place among them. All later passes map
these files; what depends on a word alone is looked up once a block.

Counts. Words and the end of a text are tokens. Three passes count 1-, 2- and 3-grams of
the training texts. A task adds up what it has seen in order and sends each part of a
level one run of keys (as gaps) and counts; the part's task merges the runs. An n-gram
is kept if it occurs ``min_count`` times, and is only counted if its parts were kept;
by default, (1, 1, 1), every n-gram of the training texts is kept.

Levels. Level 1 holds word hashes in order; a word's id is its place. Level 2 holds the
pairs (a, b) in order as one rising sequence, and level 3 the triples. A triple's last
word is stored relative to its context: as the place of c among the successors of b,
which a rising sequence of pointers leads to. Every level is cut into parts by ranges of
its own order, so a frequent context spans parts; a sample of the tokens tells where to
cut, which bears on the parts' sizes alone. All are flat files in the shared folder,
mapped into memory by the tasks that query them.

Probabilities. Absolute discounting, interpolated with the shorter context down to the
smoothed word frequency (c + 0.1) / (N + 0.1 (V + 1)); the mass of pruned n-grams goes
to the shorter context. Logarithms and back-off weights are quantised to 16 bits. The
counts lie beside the model and go when it is trained.

Recovery: parts are written under a task's own name and renamed; blocks are named after
the task's attempt, and a written table lists those that count; folders are fresh per call.

Defined results: null, empty and blank texts consist of the end alone; repeated rows
count and are scored one by one; rows without id are scored but not learned from;
without training rows every token has probability 1; other columns are not kept; an
empty table gives an empty table. Counts take up to 64 bits. Word ids take up to 31 bits;
training on more distinct words than that raises ValueError.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondliq.llm.common import fold, fresh_path, let_go, local_path, written
from bondliq.llm.elias_fano import EliasFano
from bondliq.llm.token_files import _store
from bondliq.session import files

#: floors that keep all n-grams; callers that want a pruned model pass higher ones
EVERY = (1, 1, 1)
DISCOUNT, SMOOTH = 0.75, 0.1
END = np.uint64(xxhash.xxh64_intdigest(b"", seed=1))
#: tokens worked on at once, and the quantised range of log10
BLOCK_TOKENS, LOWEST, STEPS = 400_000, -14.0, 65_535
ID_BITS = 31
#: n-grams that a task gathers before it sends them, and that a part takes in all
PENDING, PART = 2_000_000, 3_000_000
#: entries of a part that are worked on at once, and texts that are read at once
CHUNK, TEXTS = 500_000, 500
#: blocks that a task reads
TOGETHER = 5
#: one token in so many is in the sample that tells where to cut a level
SAMPLE_EVERY = 1_024
TRAIN, HELD, NO_ID = 1, 2, 4


def quantised(log10: np.ndarray) -> np.ndarray:
    return np.rint((np.clip(log10, LOWEST, 0) / LOWEST) * STEPS).astype(np.uint16)


def restored(code: np.ndarray) -> np.ndarray:
    return code.astype(np.float64) * (LOWEST / STEPS)


#: the power of ten of each quantised logarithm
POWERS = 10 ** restored(np.arange(STEPS + 1))


def narrow(counts: np.ndarray) -> np.ndarray:
    """Counts in as few bits as all of a part fit in."""
    most = int(counts.max()) if len(counts) else 0
    return counts.astype(next((t for t in (np.uint8, np.uint16, np.uint32) if most <= np.iinfo(t).max), np.int64))


def check_ids(words: int) -> None:
    """Two word ids share a key of 62 bits; more words than that allows are an error, as
    pairs would else be taken for one another."""
    if words > 1 << ID_BITS:
        raise ValueError(f"{words} distinct words; word ids take {ID_BITS} bits")


# --- files --------------------------------------------------------------------


def save(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    store, there = _store(folder)
    store.create_dir(there, recursive=True)
    attempt = TaskContext.get().taskAttemptId()
    for field, a in arrays.items():
        data = io.BytesIO()
        np.save(data, a)
        own = f"{there}/{name}.{field}.{attempt}"
        with store.open_output_stream(own) as out:
            out.write(data.getbuffer())
        store.move(own, f"{there}/{name}.{field}.npy")


def delete(spark, folder: str) -> None:
    fs, make = files(spark, folder)
    fs.delete(make(folder), True)


def load(folder: str, name: str, field: str) -> np.ndarray:
    path = f"{folder}/{name}.{field}.npy"
    here = local_path(path)
    if here:
        return np.load(here, mmap_mode="r")
    store, there = _store(path)
    with store.open_input_file(there) as f:
        return np.load(io.BytesIO(f.read()))


# --- texts --------------------------------------------------------------------

BLOCK = "name string, n_words long, n_train long, sample2 binary, sample3 binary"


def _block(folder: str, name: str, doc_id: list, flags: list, length: list, found: list) -> pd.DataFrame:
    """Write a block and list it: ``found`` are the words of its texts (A-Z lowered), b"" the ends."""
    number = {w: i for i, w in enumerate(dict.fromkeys(found))}
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, number), dtype=np.uint64, count=len(number))
    hashes[number[b""]] = END
    words, place = np.unique(hashes.view(np.int64), return_inverse=True)
    codes = place[np.fromiter(map(number.__getitem__, found), dtype=np.int64, count=len(found))]
    flags, length = np.array(flags, dtype=np.uint8), np.array(length, dtype=np.int64)
    row = np.repeat(np.arange(len(length)), length)
    learned = (flags & TRAIN).astype(bool)[row]
    at = np.arange(0, len(codes), SAMPLE_EVERY)
    at = at[learned[at]]
    two = at[(at >= 1) & (row[at] == row[at - 1])]
    three = two[(two >= 2) & (row[two] == row[two - 2])]
    counts = np.bincount(codes[learned], minlength=len(words))
    kind = np.uint16 if len(words) <= 1 << 16 else np.uint32
    save(folder, name, {"text": np.frombuffer(b"".join(x.tobytes() for x in (
        np.array([len(length), len(words)]), np.array([0 if x is None else x for x in doc_id], dtype=np.int64), length, words,
        counts.astype(np.uint32), codes.astype(kind), flags)), np.uint8)})
    return pd.DataFrame({"name": [name], "n_words": [len(words)], "n_train": [int(learned.sum())],
                         "sample2": [words[codes[np.stack([two - 1, two], 1)]].tobytes()],
                         "sample3": [words[codes[np.stack([three - 2, three - 1, three], 1)]].tobytes()]})


class Blocks:
    """Texts in written blocks: their folder, and the table that lists them."""

    def __init__(self, docs: DataFrame):
        """Cut ``docs`` (doc_id long, flags int, text)."""
        spark = docs.sparkSession
        self.folder = folder = fresh_path(spark, "lm-blocks")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task, written_blocks = TaskContext.get().taskAttemptId(), 0
            doc_id, flags, length, found = [], [], [], []

            def block() -> pa.RecordBatch:
                return pa.RecordBatch.from_pandas(_block(folder, f"{task}-{written_blocks}", doc_id, flags, length, found), schema)

            for b in (b.slice(i, TEXTS) for b in batches for i in range(0, b.num_rows, TEXTS)):
                for d, f, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "flags", "text"))):
                    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
                    doc_id.append(d)
                    flags.append(f)
                    length.append(len(words) + 1)
                    found += words
                    found.append(b"")
                    if len(found) >= BLOCK_TOKENS:
                        yield block()
                        written_blocks += 1
                        doc_id, flags, length, found = [], [], [], []
            if found:
                yield block()

        schema = pa.schema([("name", pa.string()), ("n_words", pa.int64()), ("n_train", pa.int64()), ("sample2", pa.binary()), ("sample3", pa.binary())])
        self.written = written(docs.select("doc_id", "flags", "text").mapInArrow(run, BLOCK), "blocks")
        seen = self.written.agg(F.count("*").alias("n"), F.sum("n_words").alias("w"), F.sum("n_train").alias("t")).first()
        self.n_words, self.n_train = seen["w"] or 0, seen["t"] or 0
        # the list is short, the work is not: a few blocks a task
        self.names = self.written.select("name", "n_train").repartition(max(1, -(-seen["n"] // TOGETHER))).select("name", "n_train")

    def delete(self) -> None:
        delete(self.written.sparkSession, self.folder)
        let_go(self.written.sparkSession, self.written)


class Block:
    """A block, mapped."""

    def __init__(self, folder: str, name: str):
        data = load(folder, name, "text")
        self.n, n_words = data[:16].view(np.int64).tolist()
        at = 16 + 8 * np.cumsum([0, self.n, self.n, n_words])
        self.doc_id, self.length, self.words = (np.asarray(data[i:j]).view(np.int64) for i, j in zip(at[:-1], at[1:]))
        self.flags = np.asarray(data[len(data) - self.n:])
        self.counts = np.asarray(data[at[-1]:at[-1] + 4 * n_words]).view(np.uint32)
        self._codes = np.asarray(data[at[-1] + 4 * n_words:len(data) - self.n]).view(np.uint16 if n_words <= 1 << 16 else np.uint32)

    @cached_property
    def codes(self) -> np.ndarray:
        """Each token's word."""
        return self._codes.astype(np.int64)

    @cached_property
    def row(self) -> np.ndarray:
        """Each token's text."""
        return np.repeat(np.arange(self.n), self.length)

    @cached_property
    def follows(self) -> np.ndarray:
        """Whether the token before is in the same text."""
        out = np.ones(len(self._codes), dtype=bool)
        out[np.cumsum(self.length)[:-1]] = False
        out[0] = False
        return out

    @classmethod
    def of(cls, folder: str, batches: Iterator[pd.DataFrame]) -> Iterator[Block]:
        for b in batches:
            for name in b["name"]:
                yield cls(folder, name)

    def learned(self) -> np.ndarray:
        return np.repeat((self.flags & TRAIN).astype(bool), self.length)


# --- counting -----------------------------------------------------------------


def packed(x: np.ndarray) -> bytes:
    """Whole numbers >= 0 as their low bytes, then the next ones and so on, as far as any
    has them: those of small numbers are equal and take little room in a shuffle."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8)
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), dtype=np.uint8)
    planes = np.frombuffer(data, np.uint8).reshape(-1, n)
    out[:, :len(planes)] = planes.T
    return out.view("<u8").ravel()


def starts(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.empty(0, dtype=np.int64)


def added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts. May work in place."""
    low, bits = int(keys.min()), int(counts.max()).bit_length()
    if (int(keys.max()) - low).bit_length() + bits <= 63:  # sorted as one number
        keys -= low
        keys <<= bits
        keys |= counts
        keys.sort()
        np.bitwise_and(keys, (1 << bits) - 1, out=counts)
        keys >>= bits
        keys += low
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    at = starts(keys)
    return keys[at], np.add.reduceat(counts, at)


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``keys`` in order, sorted in place, and how often each is there."""
    keys.sort()
    at = starts(keys)
    return keys[at], np.diff(at, append=len(keys))


RUN = "part int, n long, first long, gaps binary, counts binary"


def runs(keys: np.ndarray, counts: np.ndarray, bounds: np.ndarray) -> pd.DataFrame:
    """Rising keys and their counts as one row a part; part i holds the keys from bound i - 1 on."""
    cuts = np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]])
    rows = []
    for i in np.flatnonzero(np.diff(cuts)).tolist():
        k, n = keys[cuts[i]:cuts[i + 1]], counts[cuts[i]:cuts[i + 1]]
        gaps = np.diff(k.view(np.uint64), prepend=k[:1].view(np.uint64))
        rows.append((i, len(k), int(k[0]), packed(gaps), packed(n)))
    return pd.DataFrame(rows, columns=[x.split()[0] for x in RUN.split(", ")])


def gathered(found: Iterator[np.ndarray], bounds: np.ndarray) -> Iterator[pd.DataFrame]:
    """Runs of the keys that ``found`` yields, many of them at a time."""
    some, size = [], 0
    for keys in found:
        some.append(keys)
        size += len(keys)
        if size >= PENDING:
            keys, some, size = np.concatenate(some), [], 0
            yield runs(*counted(keys), bounds)
    if size:
        keys, some = np.concatenate(some), []
        yield runs(*counted(keys), bounds)


MERGED = "part int, n long, first long, last long, total long, most long, head long, head_n long, tail long, tail_n long"


def merged(frame: DataFrame, floor: int, bits: int, write) -> list:
    """Merge the runs of each part, and let ``write(part, keys, counts)`` save those that
    occur ``floor`` times. Of each part that has any, in order, a few numbers: entries, first
    and last key, sum of the counts, and of the contexts (keys without their last ``bits``
    bits) the most successors, and those and the counts of the first and the last one."""
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        end = np.cumsum(pdf["n"].to_numpy())
        keys, counts = np.empty(end[-1], dtype=np.uint64), np.empty(end[-1], dtype=np.uint64)
        for e, n, first, g, c in zip(end.tolist(), *(pdf[x].tolist() for x in ("n", "first", "gaps", "counts"))):
            np.cumsum(unpacked(g, n), out=keys[e - n:e])
            keys[e - n:e] += np.uint64(first % (1 << 64))
            counts[e - n:e] = unpacked(c, n)
        keys, counts = added(keys.view(np.int64), counts.view(np.int64))
        if floor > 1:
            keys, counts = keys[counts >= floor], counts[counts >= floor]
        if not len(keys):
            return pd.DataFrame({c.split()[0]: [] for c in MERGED.split(", ")}, dtype=np.int64)
        write(int(key[0]), keys, counts)
        at = starts(keys >> bits)
        many, sums = np.diff(at, append=len(keys)), np.add.reduceat(counts, at)
        return pd.DataFrame([(key[0], len(keys), keys[0], keys[-1], counts.sum(), many.max(), many[0], sums[0], many[-1], sums[-1])],
                            columns=[c.split()[0] for c in MERGED.split(", ")])

    out = written(frame.groupBy("part").applyInPandas(run, MERGED), "parts")
    rows = out.orderBy("part").collect()
    let_go(frame.sparkSession, out)
    return rows


def bounds_of(sample: DataFrame, parts: int) -> np.ndarray:
    """Keys that cut a level into about ``parts`` parts, by a sample ``k``."""
    if parts < 2:
        return np.empty(0, dtype=np.int64)
    at = sample.agg(F.percentile_approx("k", [i / parts for i in range(1, parts)], F.lit(10_000)).alias("k")).first()["k"]
    return np.unique(np.array(at or [], dtype=np.int64))


class Contexts:
    """The contexts that the parts of a level have. A part owns those that begin in it, and
    the numbers up to the next part's; a context may go on in further parts."""

    def __init__(self, parts: list, bits: int, n: int):
        first, last = ([r[c] >> bits for r in parts] for c in ("first", "last"))
        self.whole: dict[int, list[int]] = {}  # successors and counts of those at the ends of parts
        for r, a, b in zip(parts, first, last):
            for c, many, sums in [(a, r["head"], r["head_n"])] + [(b, r["tail"], r["tail_n"])] * (a != b):
                have = self.whole.setdefault(c, [0, 0])
                have[0] += many
                have[1] += sums
        self.low = [0] + [a + (a == b) for a, b in zip(first[1:], last)] + [n]
        self.most = max([r["most"] for r in parts] + [x for x, _ in self.whole.values()])

    def left(self, context: np.ndarray, counts: np.ndarray, occurs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of a part's rising ``context`` and ``counts``: where each context begins, and the
        quantised mass that its successors leave; it occurs ``occurs(contexts)`` times."""
        at = starts(context)
        here = context[at]
        many, sums = np.diff(at, append=len(context)), np.add.reduceat(counts, at, dtype=np.int64)
        for i in {0, len(here) - 1}:
            many[i], sums[i] = self.whole[int(here[i])]
        rest = 1 - (sums - DISCOUNT * many) / occurs(here)
        return at, quantised(np.log10(np.maximum(rest, 1e-14)))

    def ranges(self) -> Ranges:
        own = np.diff(self.low).tolist()
        return Ranges([{"part": k, "n": n, "first": a} for k, (n, a) in enumerate(zip(own, self.low)) if n])


def chunked(at: np.ndarray, n: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Slices of a part's ``n`` entries, and the number of each entry's context; contexts begin ``at``."""
    for low in range(0, n, CHUNK):
        high = min(low + CHUNK, n)
        yield slice(low, high), np.searchsorted(at, np.arange(low, high), side="right") - 1


def for_parts(spark, parts: list, work) -> None:
    """``work(i)`` of each of ``parts``, in tasks of their own."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in b["id"].tolist():
                work(i)
            yield b

    let_go(spark, written(spark.range(0, len(parts), 1, len(parts)).mapInPandas(run, "id long"), "done"))


# --- levels -------------------------------------------------------------------


class Ranges:
    """Parts of a level: where each begins, and the number of entries before it."""

    def __init__(self, parts: list):
        self.parts = [r["part"] for r in parts]
        self.first = np.array([r["first"] for r in parts], dtype=np.int64)
        self.base = np.concatenate([[0], np.cumsum([r["n"] for r in parts])]).astype(np.int64)
        self.n = int(self.base[-1])

    def by_key(self, x: np.ndarray):
        """(number, part, selection) of the parts that may hold ``x`` (ascending)."""
        yield from self._cut(self.first, x)

    def by_place(self, i: np.ndarray):
        """The same of places in any order."""
        if len(i) and (i[1:] >= i[:-1]).all():
            yield from self._cut(self.base[:-1], i)
        else:
            of = np.searchsorted(self.base, i, side="right") - 1
            order = np.argsort(of.astype(np.uint16) if len(self.parts) < 1 << 16 else of, kind="stable")
            cuts = np.searchsorted(of[order], np.arange(len(self.parts) + 1))
            for k in np.flatnonzero(np.diff(cuts)).tolist():
                yield k, self.parts[k], order[cuts[k]:cuts[k + 1]]

    def _cut(self, begin: np.ndarray, x: np.ndarray):
        cuts = np.append(np.searchsorted(x, begin), len(x))
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            yield k, self.parts[k], slice(cuts[k], cuts[k + 1])


class Level:
    """One level's parts, opened when first met."""

    def __init__(self, folder: str, name: str, ranges: Ranges):
        self.folder, self.name, self.ranges, self.open = folder, name, ranges, {}

    def __getstate__(self):
        return self.__dict__ | {"open": {}}

    def field(self, part: int, field: str):
        key = (part, field)
        if key not in self.open:
            self.open[key] = load(self.folder, f"{self.name}-{part:06d}", field)
        return self.open[key]

    def sequence(self, part: int, prefix: str = "") -> EliasFano:
        key = (part, prefix, "EF")
        if key not in self.open:
            self.open[key] = EliasFano(*(self.field(part, prefix + f) for f in EliasFano.FIELDS))
        return self.open[key]

    def values(self, place: np.ndarray, field: str, default, dtype) -> np.ndarray:
        """Field values at global places; ``default`` where the place is negative."""
        out = np.full(len(place), default, dtype=dtype)
        some = np.flatnonzero(place >= 0)
        at = place[some]
        for k, part, sel in self.ranges.by_place(at):
            out[some[sel]] = self.field(part, field)[at[sel] - self.ranges.base[k]]
        return out

    def get(self, place: np.ndarray, prefix: str = "") -> np.ndarray:
        """Members of the sequence, counted from each part's first."""
        out = np.empty(len(place), dtype=np.int64)
        for k, part, sel in self.ranges.by_place(place):
            out[sel] = self.sequence(part, prefix).get(place[sel] - self.ranges.base[k]) + self.begin(k, part)
        return out

    def begin(self, k: int, part: int) -> int:
        return int(self.ranges.first[k])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Global places of ascending ``keys``, -1 where absent."""
        out = np.full(len(keys), -1, dtype=np.int64)
        for k, part, sel in self.ranges.by_key(keys):
            found = self.sequence(part).find(keys[sel] - self.ranges.first[k])
            out[sel] = np.where(found >= 0, found + self.ranges.base[k], -1)
        return out


class Words(Level):
    """Level 1: hashes as signed integers in order; exact counts."""

    def find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, dtype=np.int64)
        for k, part, sel in self.ranges.by_key(keys):
            have = self.field(part, "keys")
            at = np.minimum(np.searchsorted(have, keys[sel]), len(have) - 1)
            out[sel] = np.where(have[at] == keys[sel], at + self.ranges.base[k], -1)
        return out


class Firsts(Level):
    """Of each word as a first one: where its successors begin in level 2, and the mass that
    they leave."""

    def begin(self, k: int, part: int) -> int:
        return int(self.field(part, "begin")[0])


class Model:
    def __init__(self, folder: str, counts: str, words: Words, total: int):
        self.folder, self.counts, self.words, self.total = folder, counts, words, total
        self.firsts = self.pairs = self.rests = self.triples = None
        self.id_bits, self.rel_bits = max(1, (words.ranges.n - 1).bit_length()), 1
        self.floor = total + SMOOTH * (words.ranges.n + 1)

    def base(self, count: np.ndarray) -> np.ndarray:
        if not self.total:
            return np.zeros(len(count))
        return np.log10((count + SMOOTH) / self.floor)

    def last(self, key: np.ndarray) -> np.ndarray:
        """The second word of a pair's key."""
        return key & ((1 << self.id_bits) - 1)


def ordered(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The order of the pairs (high, low) of numbers >= 0."""
    n, bits = len(high), int(low.max()).bit_length() if len(low) else 0
    key, place = (high << bits) | low, n.bit_length()
    if n and int(high.max()).bit_length() + bits + place <= 63:  # sorted with their places as one number
        return np.sort((key << place) | np.arange(n)) & ((1 << place) - 1)
    return np.argsort(key, kind="stable")


class Pairs:
    """The pairs of a block, at the tokens ``at`` and those before: rank of each among the
    distinct ones, and their places in level 2 (-1: absent) and among the successors of
    their first word."""

    def __init__(self, model: Model, block: Block, at: np.ndarray, ids: np.ndarray):
        a, b = block.codes[at - 1], block.codes[at]
        ok = (ids[a] >= 0) & (ids[b] >= 0)
        at, a, b = at[ok], a[ok], b[ok]
        order = ordered(a, b)
        a, b = a[order], b[order]
        first = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.empty(0, dtype=bool)
        self.rank = np.full(len(block.codes), -1, dtype=np.int64)
        self.rank[at[order]] = np.cumsum(first) - 1
        a, b = ids[a[first]], ids[b[first]]
        self.place = model.pairs.find((a << model.id_bits) | b)
        have = starts(a)
        self.relative = self.place - np.repeat(model.firsts.get(a[have], "ptr_"), np.diff(have, append=len(a)))

    def of(self, x: np.ndarray, default) -> np.ndarray:
        """Values of distinct pairs as values of the tokens that end them."""
        return np.append(x, default)[self.rank]


def train(docs: DataFrame, parts: int | None = None, min_count: tuple[int, int, int] = EVERY) -> Model:
    """Train on ``docs`` (text)."""
    cut = Blocks(docs.select(F.lit(None).cast("long").alias("doc_id"), F.lit(TRAIN | NO_ID).alias("flags"), "text"))
    model = trained(cut, parts, min_count)
    cut.delete()
    return model


def trained(cut: Blocks, parts: int | None = None, min_count: tuple[int, int, int] = EVERY) -> Model:
    """Train on the training texts of written blocks. Levels have ``parts`` parts, by
    default one for every ``PART`` n-grams that are counted."""
    spark, texts, total = cut.written.sparkSession, cut.folder, cut.n_train
    folder, counts_folder = fresh_path(spark, "lm"), fresh_path(spark, "lm-counts")
    learned = cut.names.where("n_train > 0")

    # level 1
    n = parts or -(-cut.n_words // PART)
    even = np.array([(i << 64) // n - (1 << 63) for i in range(1, n)], dtype=np.int64)

    def count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        some, size = [], 0
        for block in Block.of(texts, batches):
            has = block.counts > 0  # words of training texts
            some.append((block.words[has], block.counts[has].astype(np.int64)))
            size += len(block.words)
            if size >= PENDING:
                yield runs(*added(*map(np.concatenate, zip(*some))), even)
                some, size = [], 0
        if some:
            yield runs(*added(*map(np.concatenate, zip(*some))), even)

    def write_words(part: int, keys: np.ndarray, counts: np.ndarray) -> None:
        save(folder, f"words-{part:06d}", {"keys": keys, "counts": narrow(counts)})

    ranges = Ranges(merged(learned.mapInPandas(count_words, RUN), 1, 0, write_words) if total else [])
    check_ids(ranges.n)
    model = Model(folder, counts_folder, Words(folder, "words", ranges), total)
    if not total:
        return model
    n = parts or -(-total // PART)

    # level 2
    def sampled(data: bytes, width: int) -> np.ndarray:
        """Word ids of sampled tokens and those before."""
        have, where = np.unique(np.frombuffer(data, np.int64), return_inverse=True)
        return model.words.find(have)[where].reshape(-1, width)

    def sample_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids = sampled(b"".join(b["sample2"]), 2)
            yield pd.DataFrame({"k": (ids[:, 0] << model.id_bits) | ids[:, 1]})

    bounds2 = bounds_of(cut.written.select("sample2").mapInPandas(sample_pairs, "k long"), n)

    def pairs_of(block: Block) -> np.ndarray:
        """Where pairs end that are counted."""
        at = np.flatnonzero(block.follows & block.learned())
        if min_count[1] > 1:
            often = model.words.values(model.words.find(block.words), "counts", 0, np.int64) >= min_count[1]
            at = at[often[block.codes[at]] & often[block.codes[at - 1]]]
        return at

    def count_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def found() -> Iterator[np.ndarray]:
            for block in Block.of(texts, batches):
                ids, at = model.words.find(block.words), pairs_of(block)
                yield (ids[block.codes[at - 1]] << model.id_bits) | ids[block.codes[at]]
        yield from gathered(found(), bounds2)

    def write_pairs(part: int, keys: np.ndarray, counts: np.ndarray) -> None:
        save(folder, f"pairs-{part:06d}", EliasFano.build(keys - keys[0]).arrays())
        save(counts_folder, f"pairs-{part:06d}", {"counts": narrow(counts)})

    found = merged(learned.mapInPandas(count_pairs, RUN), min_count[1], model.id_bits, write_pairs)
    two = Ranges(found)
    model.pairs, model.triples = Level(folder, "pairs", two), Level(folder, "triples", Ranges([]))
    if not two.n:
        delete(spark, counts_folder)
        return model
    # of each first word: its successors, and the mass that they leave
    firsts = Contexts(found, model.id_bits, ranges.n)
    model.rel_bits = max(1, int(firsts.most).bit_length())

    def finish_pairs(i: int) -> None:
        name = f"pairs-{two.parts[i]:06d}"
        a = model.pairs.sequence(two.parts[i]).all()
        a += two.first[i]
        b = model.last(a)
        a >>= model.id_bits
        counts = load(counts_folder, name, "counts")
        at, rest = firsts.left(a, counts, lambda x: model.words.values(x, "counts", 1, np.int64))
        context, prob = model.words.values(a[at], "counts", 1, np.int64), np.empty(len(a), dtype=np.uint16)
        for some, of in chunked(at, len(a)):
            p = (counts[some] - DISCOUNT) / context[of] + POWERS[rest[of]] * 10 ** model.base(model.words.values(b[some], "counts", 0, np.int64))
            prob[some] = quantised(np.log10(p))
        save(folder, name, {"prob": prob})
        low, high = firsts.low[i], firsts.low[i + 1]
        if high > low:
            own = a[at] >= low
            rests = np.zeros(high - low, dtype=np.uint16)
            rests[a[at][own] - low] = rest[own]
            place = np.searchsorted(a, np.arange(low, high))
            save(folder, f"firsts-{i:06d}", {f"ptr_{f}": x for f, x in EliasFano.build(place).arrays().items()} | {
                "begin": two.base[i:i + 1], "rest": rests})

    for_parts(spark, found, finish_pairs)
    model.firsts = Firsts(folder, "firsts", firsts.ranges())
    if two.n.bit_length() + model.rel_bits > 62:
        raise ValueError("level 2 is too large for 62-bit keys")

    # level 3
    pair_counts = Level(counts_folder, "pairs", two)

    def sample_triples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids = sampled(b"".join(b["sample3"]), 3)
            both = (ids[:, :-1] << model.id_bits) | ids[:, 1:]
            have, where = np.unique(both, return_inverse=True)
            place = model.pairs.find(have)[where].reshape(-1, 2)
            place, second = place[(place >= 0).all(axis=1)], ids[(place >= 0).all(axis=1), 1]
            yield pd.DataFrame({"k": (place[:, 0] << model.rel_bits) | (place[:, 1] - model.firsts.get(second, "ptr_"))})

    bounds3 = bounds_of(cut.written.select("sample3").mapInPandas(sample_triples, "k long"), n)

    def count_triples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def found() -> Iterator[np.ndarray]:
            for block in Block.of(texts, batches):
                pairs = Pairs(model, block, pairs_of(block), model.words.find(block.words))
                often = pairs.place >= 0
                if min_count[2] > 1:
                    often &= pair_counts.values(pairs.place, "counts", 0, np.int64) >= min_count[2]
                often = pairs.of(often, False)
                at = np.flatnonzero(often[1:] & often[:-1] & block.follows[1:]) + 1
                yield (pairs.place[pairs.rank[at - 1]] << model.rel_bits) | pairs.relative[pairs.rank[at]]
        yield from gathered(found(), bounds3)

    def write_triples(part: int, keys: np.ndarray, counts: np.ndarray) -> None:
        save(folder, f"triples-{part:06d}", EliasFano.build(keys - keys[0]).arrays())
        save(counts_folder, f"triples-{part:06d}", {"counts": narrow(counts)})

    found = merged(learned.mapInPandas(count_triples, RUN), min_count[2], model.rel_bits, write_triples)
    three = Ranges(found)
    model.triples = Level(folder, "triples", three)
    if not three.n:
        delete(spark, counts_folder)
        return model
    contexts = Contexts(found, model.rel_bits, two.n)

    def finish_triples(i: int) -> None:
        name = f"triples-{three.parts[i]:06d}"
        pair = model.triples.sequence(three.parts[i]).all()
        pair += three.first[i]
        rel = pair & ((1 << model.rel_bits) - 1)
        pair >>= model.rel_bits
        counts = load(counts_folder, name, "counts")
        at, rest = contexts.left(pair, counts, lambda x: pair_counts.values(x, "counts", 1, np.int64))
        context, prob = pair_counts.values(pair[at], "counts", 1, np.int64), np.empty(len(pair), dtype=np.uint16)
        for some, of in chunked(at, len(pair)):
            low, high = of[0], of[-1] + 1
            second = model.last(model.pairs.get(pair[at[low:high]]))
            place = model.firsts.get(second, "ptr_")[of - low] + rel[some]  # among the successors of the second word
            p = (counts[some] - DISCOUNT) / context[of] + POWERS[rest[of]] * POWERS[model.pairs.values(place, "prob", 0, np.uint16)]
            prob[some] = quantised(np.log10(p))
        save(folder, name, {"prob": prob})
        low, high = contexts.low[i], contexts.low[i + 1]
        if high > low:
            own = pair[at] >= low
            rests = np.zeros(high - low, dtype=np.uint16)
            rests[pair[at][own] - low] = rest[own]
            save(folder, f"rests-{i:06d}", {"rest": rests})

    for_parts(spark, found, finish_triples)
    model.rests = Level(folder, "rests", contexts.ranges())
    delete(spark, counts_folder)
    return model


def token_scores(model: Model, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each token: training count, base log10 probability, and the model's."""
    ids = model.words.find(block.words)
    word_counts = model.words.values(ids, "counts", 0, np.int64)
    counts, base = word_counts[block.codes], model.base(word_counts)[block.codes]
    if model.pairs is None or not model.pairs.ranges.n:
        return counts, base, base
    at = np.flatnonzero(block.follows)
    pairs = Pairs(model, block, at, ids)
    score = base.copy()
    score[at] += restored(model.firsts.values(ids, "rest", 0, np.uint16))[block.codes[at - 1]]
    has = np.flatnonzero(pairs.of(pairs.place >= 0, False))
    score[has] = restored(model.pairs.values(pairs.place, "prob", 0, np.uint16))[pairs.rank[has]]
    if not model.triples.ranges.n:
        return counts, base, score
    rest = restored(model.rests.values(pairs.place, "rest", 0, np.uint16))
    known = pairs.of(pairs.place >= 0, False)
    last = np.flatnonzero(known[:-1] & block.follows[1:]) + 1  # a pair of the model before this token
    score[last] += rest[pairs.rank[last - 1]]
    both = last[known[last]]
    both = both[ordered(pairs.rank[both - 1], block.codes[both])]
    found = model.triples.find((pairs.place[pairs.rank[both - 1]] << model.rel_bits) | pairs.relative[pairs.rank[both]])
    got = found >= 0
    score[both[got]] = restored(model.triples.values(found[got], "prob", 0, np.uint16))
    return counts, base, score


def score(docs: DataFrame, modulus: int = 10, min_count: tuple[int, int, int] = EVERY, parts: int | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score; learned from the rows whose id's crc32 is not
    divisible by ``modulus``. Written; the model is deleted."""
    spark = docs.sparkSession
    left, doc_id = fold("doc_id", modulus), F.col("doc_id").cast("long")
    flags = F.when(left != 0, TRAIN).when(left == 0, HELD).otherwise(0) + F.when(doc_id.isNull(), NO_ID).otherwise(0)
    cut = Blocks(docs.select(doc_id.alias("doc_id"), flags.alias("flags"), "text"))
    model = trained(cut, parts, min_count)
    texts = cut.folder
    shared = spark.sparkContext.broadcast(model)  # file names and part bounds

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for block in Block.of(texts, batches):
            counts, base, own = token_scores(m, block)
            n, row = block.n, block.row
            yield pd.DataFrame({
                "doc_id": pd.arrays.IntegerArray(block.doc_id.copy(), (block.flags & NO_ID) > 0), "held_out": (block.flags & HELD) > 0,
                "n_tokens": block.length.copy(), "n_known": np.bincount(row, counts > 0, minlength=n).astype(np.int64),
                "train_tokens": m.total, "base_score": np.bincount(row, base, minlength=n), "score": np.bincount(row, own, minlength=n)})

    out = written(cut.names.mapInPandas(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"), "scores")
    delete(spark, model.folder)
    cut.delete()
    return out

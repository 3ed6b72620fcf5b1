"""Groups of spelling variants by Bloom-guided neighbourhoods.

Words are counted over all texts. Two words are near if one inserted, deleted or replaced
code point turns one into the other. Instead of comparing words, every word generates its
deletions and replacements, and each of these probes a blocked Bloom filter of the whole
vocabulary; only the positive ones are shuffled, to an exact join with the vocabulary that
removes the false positives. A pair is generated once: by its longer word, or for a
replacement by the word with the smaller code point; the join's result is then read in both
directions.

The filter is sharded by word length: blocks of 512 bits, 16 bits a word, eight probed bits
in one block. The shards lie one after another in one address space that is cut into windows
of ``WINDOW`` blocks. One window is broadcast at a time, and a pass over the vocabulary
probes the edits that fall into it; so what is broadcast, and sent to the driver, is 32 MB
at most however large the vocabulary grows, and more words mean more passes. Edits are
hashed from prefix sums without building their strings, in batches of bounded size.

A word's form is its near word of largest count, if that is at least twice its own. Counts
at least double along a chain of forms, so its length is bounded by the logarithm of the
largest count, and that many pointer jumps, by joins, lead every word to its root.

Defined results: null texts have no words; a null id is an empty one; repeated rows count
as often as they occur; ties go to the smaller word in code-point order; words of any length
are treated alike; a table without words gives an empty table; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondliq.llm.common import let_go, written

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMAGE = 97  # one run in so many loses a code point
LENGTH, COUNT, RATIO = 5, 3, 2
BITS, LANES = 16, 8  # filter bits a word; 64-bit lanes of a block, one probed bit in each
WINDOW = 500_000  # blocks broadcast at once
LONGEST = 64  # longer words share a shard
EDITS = 1 << 20  # edits hashed at once
STEP, SALT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def vocabulary(docs: DataFrame, length: int = LENGTH, count: int = COUNT, damage: int = DAMAGE) -> DataFrame:
    """(word, length, n): the distinct words of at least ``length`` code points that occur
    at least ``count`` times."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
                       F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(RUN), F.lit(0))).alias("run"))
    ascii_only = F.octet_length("run") == F.char_length("run")
    low = runs.select("doc", F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", UPPER, LOWER)).alias("run"))
    hashed = low.select("run", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = hashed.select(F.when(F.col("h") % damage == 0, shorter).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.char_length("word") >= length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= count)
    return counted.select("word", F.char_length("word").alias("length"), "n")


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _points(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of code points."""
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).reshape(len(words), -1)


def _powers(length: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(length, STEP)]), dtype=np.uint64)


def _values(points: np.ndarray) -> np.ndarray:
    """What each code point adds to a word's hash, before its position's power."""
    return _mixed(points.astype(np.uint64) + SALT)


class Shards:
    """Where the words of each length lie in the filter's address space."""

    def __init__(self, counts: dict[int, int]):
        self.size = np.zeros(LONGEST + 1, dtype=np.uint64)
        for length, n in counts.items():
            self.size[min(length, LONGEST)] += np.uint64(n)
        self.size = (self.size * np.uint64(BITS) + np.uint64(64 * LANES - 1)) // np.uint64(64 * LANES)
        self.start = np.concatenate([[np.uint64(0)], np.cumsum(self.size)])
        self.blocks = int(self.start[-1])

    def address(self, h: np.ndarray, length: int) -> np.ndarray:
        """Block of hashed words of ``length`` (none if no word has that length)."""
        shard = min(length, LONGEST)
        return self.start[shard] + (((h >> np.uint64(32)) * self.size[shard]) >> np.uint64(32))

    def known(self, length: int) -> bool:
        return self.size[min(length, LONGEST)] > 0


def _bits(h: np.ndarray) -> np.ndarray:
    return _mixed(h + SALT)


def filter_blocks(vocab: DataFrame, shards: Shards) -> DataFrame:
    """(address, m0 .. m7): the blocks of the filter, lanes joined by bitwise or."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for length, own in b.groupby("length"):
                h = _mixed((_values(_points(own["word"].tolist())) * _powers(length)[:-1]).sum(1, dtype=np.uint64))
                bits = _bits(h)
                lanes = {f"m{k}": (np.uint64(1) << ((bits >> np.uint64(6 * k)) & np.uint64(63))).view(np.int64) for k in range(LANES)}
                yield pd.DataFrame({"address": shards.address(h, length).astype(np.int64)} | lanes)

    names = [f"m{k}" for k in range(LANES)]
    marks = vocab.select("word", "length").mapInPandas(run, "address long, " + ", ".join(f"{m} long" for m in names))
    return marks.groupBy("address").agg(*[F.bit_or(m).alias(m) for m in names])


class Window:
    """A broadcast stretch of the filter."""

    def __init__(self, first: int, lanes: np.ndarray):
        self.first, self.lanes = np.uint64(first), lanes

    def positive(self, h: np.ndarray, address: np.ndarray) -> np.ndarray:
        """Indexes of the edits in this window that the filter cannot rule out."""
        at = address - self.first  # wraps round for lower addresses
        some = np.flatnonzero(at < np.uint64(len(self.lanes)))
        bits, at = _bits(h[some]), at[some].astype(np.int64)
        for k in range(LANES):
            hit = (self.lanes[at, k] >> ((bits >> np.uint64(6 * k)) & np.uint64(63))) & np.uint64(1) != 0
            some, bits, at = some[hit], bits[hit], at[hit]
        return some


def _edits(words: list[str], alphabet: np.ndarray, shortest: int, shards: Shards, window: Window) -> Iterator[tuple[int, str]]:
    """(index of the word, edit) for the positive deletions and replacements of words of one length."""
    length = len(words[0])
    points, power = _points(words), _powers(length)
    values, letters = _values(points), _values(alphabet)
    share = values * power[:-1]
    if length - 1 >= shortest and shards.known(length - 1):
        before = np.cumsum(share, axis=1, dtype=np.uint64) - share
        moved = np.zeros_like(values)
        moved[:, 1:] = values[:, 1:] * power[:length - 1]
        after = moved.sum(1, dtype=np.uint64)[:, None] - np.cumsum(moved, axis=1, dtype=np.uint64)
        # of equal neighbours, deleting the last stands for all
        row, at = np.nonzero(np.concatenate([points[:, 1:] != points[:, :-1], np.ones((len(words), 1), dtype=bool)], axis=1))
        h = _mixed((before + after)[row, at])
        for i in window.positive(h, shards.address(h, length - 1)):
            w, k = words[row[i]], at[i]
            yield int(row[i]), w[:k] + w[k + 1:]
    whole = share.sum(1, dtype=np.uint64)
    cells, step = points.size, max(1, EDITS // max(1, len(alphabet)))
    for first in range(0, cells, step):  # cells: a word and a position
        cell = np.arange(first, min(cells, first + step))
        row, at = np.divmod(cell, length)
        pick, letter = np.nonzero(alphabet[None, :] > points[row, at][:, None])
        h = _mixed(whole[row[pick]] + (letters[letter] - values[row, at][pick]) * power[at[pick]])
        for i in window.positive(h, shards.address(h, length)):
            w, k = words[row[pick[i]]], at[pick[i]]
            yield int(row[pick[i]]), w[:k] + chr(alphabet[letter[i]]) + w[k + 1:]


def candidates(vocab: DataFrame, shards: Shards, alphabet: np.ndarray, shortest: int) -> DataFrame:
    """(word, n, near): edits that are in the filter, each unordered pair once."""
    spark = vocab.sparkSession
    held = written(filter_blocks(vocab, shards), "filter")
    out = []
    for first in range(0, shards.blocks, WINDOW):
        size = min(WINDOW, shards.blocks - first)
        rows = held.where(F.col("address").between(first, first + size - 1)).toArrow()  # WINDOW rows
        lanes = np.zeros((size, LANES), dtype=np.uint64)
        for k in range(LANES):
            lanes[rows["address"].to_numpy() - first, k] = rows[f"m{k}"].to_numpy().view(np.uint64)
        shared = spark.sparkContext.broadcast(Window(first, lanes))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for length, own in b.groupby("length"):
                    words, counts = own["word"].tolist(), own["n"].to_numpy()
                    step = max(1, EDITS // int(length))
                    for k in range(0, len(words), step):
                        found = list(_edits(words[k:k + step], alphabet, shortest, shards, shared.value))
                        if found:
                            row, near = zip(*found)
                            row = np.array(row) + k
                            yield pd.DataFrame({"word": [words[i] for i in row], "n": counts[row], "near": near})

        out.append(written(vocab.mapInPandas(run, "word string, n long, near string"), "edits"))
        shared.destroy()
    let_go(spark, held)
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


def near_pairs(vocab: DataFrame) -> DataFrame:
    """(word, near, near_n) for every ordered pair of near words of the (written) vocabulary."""
    counts = {r["length"]: r["n"] for r in vocab.groupBy(F.least("length", F.lit(LONGEST)).alias("length")).agg(F.count("*").alias("n")).collect()}
    letters = vocab.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct().collect()  # of RUN's 90
    alphabet = np.array(sorted(ord(r["c"]) for r in letters), dtype=np.uint32)
    shards = Shards(counts)
    if not shards.blocks:
        return vocab.select("word", F.col("word").alias("near"), F.col("n").alias("near_n")).where(F.lit(False))
    guess = candidates(vocab, shards, alphabet, min(counts))
    true = guess.join(vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    ways = F.array(F.struct("word", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    return true.select(F.inline(ways))


def roots(forms: DataFrame, largest: int) -> DataFrame:
    """(word, root) for every word with a form: pointer jumping. ``largest`` count bounds the chains."""
    spark = forms.sparkSession
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    longest = int(math.log(max(largest, 1), RATIO)) + 1
    for _ in range(math.ceil(math.log2(longest + 1))):
        on = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        jumped = written(now.join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), "roots")
        let_go(spark, now)
        now = jumped
    return now


def variants(docs: DataFrame, length: int = LENGTH, count: int = COUNT, damage: int = DAMAGE) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    spark = docs.sparkSession
    vocab = written(vocabulary(docs, length, count, damage), "vocabulary")
    pairs = near_pairs(vocab)
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("top"))
    enough = -F.col("top.less") >= RATIO * F.col("n")
    words = written(vocab.join(best, "word", "left").select(
        "word", F.when(enough, F.col("top.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, -F.col("top.less")).alias("form_n")), "words")
    let_go(spark, vocab)
    largest = words.agg(F.max("n").alias("n")).first()["n"] or 0
    chain = roots(words.where("form is not null"), largest)
    return words.join(chain, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def oracle() -> str:
    """DuckDB SQL for ``variants`` over the view ``documents``: every neighbourhood in full."""
    return f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
low AS (SELECT doc, translate(run, '{UPPER}', '{LOWER}') AS run, count(*) AS k FROM runs GROUP BY ALL),
bytes AS (SELECT run, k, hex(encode(concat(doc, ':', run))) AS x FROM low),
hashed AS (SELECT run, k, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(len(x) // 2), lambda i:
    (strpos('0123456789ABCDEF', x[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', x[2 * i + 2]) - 1)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h FROM bytes, crc),
words AS (SELECT CASE WHEN h % {DAMAGE} = 0 THEN concat(substr(run, 1, h % len(run)), substr(run, h % len(run) + 2)) ELSE run END AS word, k FROM hashed),
vocab AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM words WHERE len(word) >= {LENGTH} GROUP BY word HAVING sum(k) >= {COUNT}),
places AS (SELECT word, n, unnest(range(len(word))) AS i FROM vocab),
cut AS (SELECT word, n, i, concat(substr(word, 1, i), substr(word, i + 2)) AS rest FROM places),
near AS (SELECT DISTINCT c.word, v.word AS near, v.n AS near_n FROM cut c JOIN vocab v ON c.rest = v.word
    UNION SELECT DISTINCT v.word, c.word AS near, c.n AS near_n FROM cut c JOIN vocab v ON c.rest = v.word
    UNION SELECT DISTINCT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word),
top AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM near GROUP BY word),
formed AS (SELECT v.word, v.n, coalesce(t.n_near, 0) AS n_near, CASE WHEN t.near_n >= {RATIO} * v.n THEN t.near END AS form,
    CASE WHEN t.near_n >= {RATIO} * v.n THEN t.near_n END AS form_n FROM vocab v LEFT JOIN top t USING (word)),
walk AS (SELECT word, word AS at FROM formed UNION ALL SELECT w.word, f.form FROM walk w JOIN formed f ON w.at = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT w.word, w.at AS root FROM walk w JOIN formed f ON w.at = f.word WHERE f.form IS NULL)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM formed f JOIN ends e USING (word)"""

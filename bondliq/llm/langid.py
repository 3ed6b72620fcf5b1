"""Language identification by word-first backoff.

A word that the training texts know scores by its log frequency in each language. An
unseen word falls back to its character n-grams, longest first: the first length of
which the model knows any n-gram scores the word by their mean log frequencies. A
text's language has the highest mean score over all its words; its score is that
language's share after a softmax of the means.

Training reads a bounded sample of rows, whole texts, chosen by a hash of id and text:
about ``train_rows`` documents, shared out evenly among the languages. A language with
fewer rows than its share gives all of them and leaves the rest to the others; no share
is below ``least`` rows. The model keeps every word and n-gram of the sample, so its size
follows the sample, not the corpus, and is broadcast; words are held as 64-bit hashes.

Defined results: text that is null or has no letter is ``und`` with score 0, as is
every text if nothing was learned; ties go to the first language in order; repeated
rows are classified one by one; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondliq.llm.common import fold, written
from bondliq.llm.tokens import Memo

LONGEST = 4
WORD = re.compile(r"[^\W\d_]+")
SHARPNESS = 4.0
#: words of a generation of a model's memo, of which each worker has one
MEMO_WORDS = 100_000


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters."""
    return [w for w in WORD.findall(text.lower()) if w.isalpha()] if text else []


def grams(word: str, n: int) -> list[str]:
    padded = f" {word} " if n > 1 else word
    return [padded[i:i + n] for i in range(len(padded) - n + 1)]


def hashed(word: str) -> int:
    """Spark's xxhash64 of a word, as an unsigned number."""
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), seed=42)


class Model:
    def __init__(self, langs: list[str], words: tuple[np.ndarray, np.ndarray], by_length: list[dict], totals: np.ndarray):
        """``words``: rising hashes, and a row of counts per language for each;
        ``by_length[n]``: n-gram -> counts per language; ``totals``: rows of counts per
        language for words (0) and n-grams (1..LONGEST)."""
        self.langs = langs
        self.hashes, counts = words
        self.words = self._logs(counts, totals[0])
        # n-gram -> its row in the logs of its length: numbers in arrays, as a worker holds all of them
        self.grams = [{}] + [{g: i for i, g in enumerate(t)} for t in by_length[1:]]
        self.logs = [None] + [self._logs(np.array(list(t.values())).reshape(len(t), len(langs)), totals[n])
                              for n, t in enumerate(by_length[1:], 1)]
        self.memo = Memo(self._word, MEMO_WORDS)
        self.unknown = np.zeros(len(langs)).tobytes()

    @staticmethod
    def _logs(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Half an occurrence is added to the largest language's counts, and as large a
        frequency to those of the others, so a small one gains nothing by unseen keys."""
        least = 0.5 / max(total.max(initial=0), 1)
        return np.log((counts / np.maximum(total, 1) + least) / (1 + least * (len(counts) + 1)))

    def known(self, word: str) -> int:
        """The word's row, or -1."""
        h = np.uint64(hashed(word))
        at = int(self.hashes.searchsorted(h))
        return at if at < len(self.hashes) and self.hashes[at] == h else -1

    def _word(self, word: str) -> bytes:
        """The word's score in each language, as the bytes of an array."""
        at = self.known(word)
        if at >= 0:
            return self.words[at].tobytes()
        for n in range(LONGEST, 0, -1):
            found = [x for g in grams(word, n) if (x := self.grams[n].get(g)) is not None]
            if found:
                return np.array([sum(x) / len(found) for x in zip(*self.logs[n][found].tolist())]).tobytes()
        return self.unknown

    def classify(self, text: str | None) -> tuple[str, float]:
        found = Counter(words_of(text))
        if not found or not self.langs:
            return "und", 0.0
        scores = np.frombuffer(b"".join([self.memo[w] for w in found])).reshape(len(found), -1)
        weights = np.fromiter(found.values(), float, len(found))
        mean = SHARPNESS * (weights @ scores) / weights.sum()
        share = np.exp(mean - mean.max())
        best = int(np.argmax(mean))
        return self.langs[best], float(share[best] / share.sum())


def shares(rows: dict[str, int], train_rows: int, least: int) -> dict[str, float]:
    """The share of each language's rows that goes into the sample: smallest languages
    first, each at most an equal part of what is left, and no part below ``least``."""
    out, left = {}, train_rows
    for i, (lang, n) in enumerate(sorted(rows.items(), key=lambda x: (x[1], x[0]))):
        take = min(n, max(left // (len(rows) - i), least))
        out[lang] = take / n
        left = max(left - take, 0)
    return out


def fit(docs: DataFrame, train_rows: int = 20_000, least: int = 200) -> Model:
    """Fit on ``docs`` (doc_id, text, lang) with non-null lang."""
    sample = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    by_lang = {r["lang"]: r["count"] for r in sample.groupBy("lang").count().collect()}  # a row per language
    scale = 1 << 53
    below = [(lang, int(x * scale)) for lang, x in shares(by_lang, train_rows, least).items() if x < 1]
    if below:
        limit = F.create_map(*[F.lit(x) for pair in below for x in pair])[F.col("lang")]
        sample = sample.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(scale)) < F.coalesce(limit, F.lit(scale)))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:  # a map-side combine
            found: dict[str, Counter] = {}
            for lang, text in zip(b["lang"], b["text"]):
                found.setdefault(lang, Counter()).update(words_of(text))
            out = [(lang, 0, w, k) for lang, words in found.items() for w, k in words.items()]
            yield pd.DataFrame(out, columns=["lang", "size", "key", "n"])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found: Counter = Counter()
            for lang, w, k in zip(b["lang"], b["key"], b["n"]):
                for size in range(1, LONGEST + 1):
                    for g in grams(w, size):
                        found[lang, size, g] += k
            yield pd.DataFrame([(*x, k) for x, k in found.items()], columns=["lang", "size", "key", "n"])

    schema = "lang string, size int, key string, n long"
    words = sample.select("lang", "text").mapInPandas(counted, schema).groupBy("size", "key", "lang").agg(F.sum("n").alias("n"))
    words = written(words.select("lang", "size", "key", "n"), "words")
    # each distinct word is cut into n-grams once
    spread = written(words.unionByName(words.mapInPandas(cut, schema)).groupBy("size", "key", "lang").agg(F.sum("n").alias("n")), "grams")
    totals = spread.groupBy("size", "lang").agg(F.sum("n").alias("n"))
    all_totals = totals.collect()
    langs = sorted({r["lang"] for r in all_totals})
    place = {x: i for i, x in enumerate(langs)}
    sums = np.zeros((LONGEST + 1, len(langs)))
    for r in all_totals:
        sums[r["size"], place[r["lang"]]] = r["n"]

    def entries(size: int, key) -> tuple[list, np.ndarray, np.ndarray]:
        """Key, language and count of all entries of a size: as many as the sample holds."""
        got = spread.where(F.col("size") == size).select(key.alias("key"), "lang", "n").toArrow()
        return got["key"], np.array([place[x] for x in got["lang"].to_pylist()], dtype=np.int64), got["n"].to_numpy()

    keys, lang, n = entries(0, F.xxhash64("key"))
    hashes, row = np.unique(keys.to_numpy().astype(np.int64).view(np.uint64), return_inverse=True)
    counts = np.zeros((len(hashes), len(langs)))
    np.add.at(counts, (row, lang), n)
    tables: list[dict] = [{} for _ in range(LONGEST + 1)]
    for size in range(1, LONGEST + 1):
        keys, lang, n = entries(size, F.col("key"))
        for g, x, k in zip(keys.to_pylist(), lang.tolist(), n.tolist()):
            tables[size].setdefault(g, [0] * len(langs))[x] += k
    return Model(langs, (hashes, counts), tables, sums)


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """Each row of ``docs`` without its text, with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for b in batches:
            found = [m.classify(x) for x in b["_text"]]
            yield b.drop(columns=["_text"]).assign(lang_pred=[x[0] for x in found], score=[x[1] for x in found])

    kept = docs.drop("lang_pred", "score").withColumnRenamed("text", "_text")
    schema = kept.drop("_text").schema.add("lang_pred", "string").add("score", "double")
    return kept.mapInPandas(run, schema)


def kept(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a language whose score is ``threshold`` or more, with
    all their columns; learned from the rows that ``predict`` learns from."""
    model = fit(docs.where(fold("doc_id", 3) != 1).select("doc_id", "text", "lang"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            found = [m.classify(x) for x in b.column(b.schema.get_field_index("text")).to_pylist()]
            yield b.filter(pa.array([lang != "und" and s >= threshold for lang, s in found], type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def predict(docs: DataFrame, modulus: int = 3, held: int = 1) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score; learned from the rows whose id's
    crc32 leaves another remainder than ``held``."""
    rest = fold("doc_id", modulus)
    model = fit(docs.where(rest != held).select("doc_id", "text", "lang"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(rest == held, F.lit(False)).alias("held_out"), "text")
    return classify(rows, model)

"""Quality classifier: a kernel ridge fit by random Fourier features.

Statistics of the whole text (shares of character classes, repetition of words and
lines, lengths) are standardised and mapped to random cosines whose inner products
approximate a Gaussian kernel. Ridge weights solve the normal equations, which every
partition sums for itself. Scores are calibrated by isotonic regression on scores of
rows that the scoring weights have not seen (two folds, each scored by the other's).

Sizes: the matrices have ``features`` + statistics + 1 columns, the calibration uses a
fixed number of score bins; neither grows with the data.

Defined results: null text is the empty text; empty texts have a score like any other;
repeated rows are scored one by one, repeated labels of a document count once (the
highest); null labels are left out; without labelled rows every score is 0.5; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bondliq.llm.common import fold, written

STATISTICS = (
    "log_chars", "log_words", "mean_word", "upper", "digit", "space", "sentence_marks", "exclaim", "bar", "symbol",
    "other_ascii", "non_ascii", "distinct_words", "top_word", "upper_words", "symbol_words", "distinct_lines",
    "log_line", "log_sentence", "distinct_pairs",
)
_CLASS = np.zeros((256, 9))
for _b in range(256):
    _c = chr(_b)
    _k = (0 if "A" <= _c <= "Z" else 1 if "0" <= _c <= "9" else 2 if _c in " \t\n\r" else 3 if _c in ".,;:?'\"()-" else 4 if _c == "!"
          else 5 if _c == "|" else 6 if _c in "#$%&*@^~<>{}[]\\/=+_`" else 8 if _b > 127 else 7)
    _CLASS[_b, _k] = 1
_SYMBOLS = frozenset("#$%&*@^~<>{}[]\\/=+_`|")
PARTIALS = 16
FOLDS = 2


def statistics(text: str) -> np.ndarray:
    """The statistics of one whole text, in the order of ``STATISTICS``."""
    data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    n = max(len(data), 1)
    share = np.bincount(data, minlength=256) @ _CLASS / n
    words = text.split()
    w = max(len(words), 1)
    seen = Counter(words)
    lines = text.split("\n")
    repeated = seen.most_common(1)[0][1] if seen else 0
    shouted = sum(k for x, k in seen.items() if x.isupper() and len(x) > 1)
    marked = sum(k for x, k in seen.items() if x[-1] in _SYMBOLS)
    pairs = len(set(zip(words, words[1:])))
    sentences = 1 + text.count(". ") + text.count(".\n")
    return np.array([
        np.log1p(len(data)), np.log1p(len(words)), min(n / w, 40.0), share[0], share[1], share[2], share[3], share[4],
        share[5], share[6], share[7], share[8], len(seen) / w, repeated / w, shouted / w, marked / w,
        len(set(lines)) / len(lines), np.log1p(n / len(lines)), np.log1p(w / sentences), (pairs + 1) / w,
    ])


def document_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``stats`` (array of double)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.drop(columns=["_text"]).assign(stats=[statistics(x) for x in b["_text"]])

    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in (text, "stats")],
                       F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return kept.mapInPandas(run, kept.drop("_text").schema.add("stats", T.ArrayType(T.DoubleType())))


@dataclass
class Model:
    """Standardisation, random directions, ridge weights and the isotonic steps."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None = None
    fold_weights: list | None = None
    steps: tuple[np.ndarray, np.ndarray] | None = None

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        waves = np.sqrt(2 / len(self.phases)) * np.cos(z @ self.directions + self.phases)
        return np.hstack([np.ones((len(z), 1)), z / 4, waves])

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None or not len(stats):
            return np.full(len(stats), 0.5)
        raw = self.features(stats) @ self.weights
        return np.clip(np.interp(raw, *self.steps), 0.0, 1.0) if self.steps else np.clip(raw, 0.0, 1.0)


def _matrix(stats) -> np.ndarray:
    return np.array(stats.tolist(), dtype=float).reshape(len(stats), -1)


def isotonic(x: np.ndarray, n: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins (position, rows, sum of labels): the pooled
    positions and their means, not falling."""
    blocks: list[list[float]] = []
    for xi, ni, yi in zip(x, n, y):
        blocks.append([xi * ni, ni, yi])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


def fit(rows: DataFrame, features: int = 96, ridge: float = 0.3, bins: int = 512, seed: int = 7) -> Model | None:
    """Fit on ``rows`` (stats array<double>, label double, part int in 0..FOLDS-1);
    None without rows."""
    k = len(STATISTICS)
    sums = rows.agg(F.count("*").alias("n"), *[f(F.element_at("stats", i + 1)).alias(f"{m}{i}")
                    for i in range(k) for m, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    if not sums["n"]:
        return None
    rng = np.random.default_rng(seed)
    scale = np.array([sums[f"s{i}"] for i in range(k)])
    model = Model(np.array([sums[f"m{i}"] for i in range(k)]), np.where(scale > 1e-9, scale, 1.0),
                  rng.normal(size=(k, features)) / np.sqrt(k), rng.uniform(0, 2 * np.pi, features))
    size = 1 + k + features

    def equations(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((FOLDS, size, size + 1))
        for b in batches:
            phi, y, part = model.features(_matrix(b["stats"])), b["label"].to_numpy(float), b["part"].to_numpy()
            for f in range(FOLDS):
                p = phi[part == f]
                total[f] += p.T @ np.column_stack([p, y[part == f]])
        yield pd.DataFrame({"bucket": [TaskContext.get().partitionId() % PARTIALS], "sums": [total.tobytes()]})

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x) for x in pdf["sums"])
        return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "sums": [total.tobytes()]})

    schema = "bucket int, sums binary"
    partial = rows.mapInPandas(equations, schema).groupBy("bucket").applyInPandas(added, schema)
    total = sum(np.frombuffer(r["sums"]) for r in partial.collect()).reshape(FOLDS, size, size + 1)

    def solve(m: np.ndarray) -> np.ndarray:
        penalty = np.eye(size) * ridge
        penalty[0, 0] = 1e-9
        return np.linalg.solve(m[:, :size] + penalty, m[:, size])

    model.weights = solve(total.sum(0))
    model.fold_weights = [solve(total.sum(0) - total[f]) for f in range(FOLDS)]

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, y = np.zeros(bins), np.zeros(bins)
        for b in batches:
            phi, part = model.features(_matrix(b["stats"])), b["part"].to_numpy()
            raw = np.einsum("ij,ij->i", phi, np.array(model.fold_weights)[part])
            at = np.clip(((raw + 0.5) / 2 * bins).astype(int), 0, bins - 1)
            n += np.bincount(at, minlength=bins)
            y += np.bincount(at, b["label"].to_numpy(float), minlength=bins)
        some = np.flatnonzero(n)
        yield pd.DataFrame({"bin": some, "n": n[some], "y": y[some]})

    found = rows.mapInPandas(binned, "bin int, n double, y double").groupBy("bin").agg(
        F.sum("n").alias("n"), F.sum("y").alias("y")).orderBy("bin").collect()
    at = np.array([(r["bin"] + 0.5) / bins * 2 - 0.5 for r in found])
    n, y = (np.array([r[c] for r in found]) for c in ("n", "y"))
    rate = y.sum() / n.sum()
    model.steps = isotonic(at, n + 0.02, y + 0.02 * rate)
    model.fold_weights = None
    return model


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 5) -> tuple[Model | None, DataFrame]:
    """The model that labels of documents teach whose id's crc32 is not divisible by
    ``modulus``, and the written statistics of all rows (doc_id, stats)."""
    stats = written(document_statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")), "stats")
    known = labels.where(F.col(label).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(label).cast("double").alias("label"))
    rest = fold("doc_id", modulus)
    rows = stats.join(known, "doc_id").where(rest != 0).select("stats", "label", (rest % FOLDS).cast("int").alias("part"))
    return fit(written(rows, "labelled")), stats


def score(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 5, threshold: float = 0.3) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted."""
    model, stats = learn(docs, labels, label, modulus)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            s = model.score(_matrix(b["stats"])) if model else np.full(len(b), 0.5)
            yield b.drop(columns=["stats"]).assign(score=s, predicted=(s >= threshold).astype("int32"))

    held = stats.select("doc_id", F.coalesce(fold("doc_id", modulus) == 0, F.lit(False)).alias("held_out"), "stats")
    return held.mapInPandas(run, "doc_id long, held_out boolean, score double, predicted int")


def kept(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all their columns."""
    model, _ = learn(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.schema.get_field_index("text")).to_pylist()
            if model and texts:
                s = model.score(np.array([statistics(x or "") for x in texts]))
                b = b.filter(pa.array(s >= threshold))
            yield b

    return docs.mapInArrow(run, docs.schema)

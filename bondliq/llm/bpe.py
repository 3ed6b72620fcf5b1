"""Exact BPE encoding in linear time, and decoding by an offset table.

Encoder: an Aho-Corasick automaton over the vocabulary gives the longest token that
starts at each byte. Tokens are taken greedily from the left; a token may follow
another only if the pair is *compatible*, that is, if merging the two tokens' bytes by
rank would keep exactly that boundary. An incompatible choice backs off to the token's
longest proper prefix in the vocabulary, and a position from which nothing can follow
is marked, so no position is left twice. Only one such sequence exists: the one that
the merge rules give.

Decoder: token bytes lie in one blob; token ``i`` is ``blob[offset[i]:offset[i+1]]``.
Decoding gathers all bytes of a document at once.

Defined results: null text is the empty text; the empty text has no tokens; repeated
rows are encoded one by one; texts of any length are encoded whole; further columns
are left out of the result; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondliq.llm import tokens as T

#: The byte-level vocabulary's split pattern with its white space spelled out (fixed values).
_WS = re.escape(T.WHITE_SPACE)
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"
DECODE_BLOCK = 1 << 20
#: entries of a generation of the memo of chunks; the memo of split pieces is larger
CHUNK_ENTRIES = 300_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others follow from code point 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class BPE:
    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        stand_in = byte_alphabet()
        vocab = spec["model"]["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *added.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(stand_in[c] for c in token)
        # rank: single bytes first, then tokens in the order of their merges
        self.rank = [0] * size
        self.parts: list[tuple[int, int] | None] = [None] * size
        self.merged: dict[tuple[int, int], int] = {}
        for r, (a, b) in enumerate(merges, 1):
            i, pair = vocab[a + b], (vocab[a], vocab[b])
            self.merged.setdefault(pair, r)
            if self.parts[i] is None:
                self.parts[i], self.rank[i] = pair, r
        by_bytes = {self.bytes_of[i]: i for i in vocab.values()}
        # only what merges build, and single bytes, can be a token of a text
        made = {b: i for b, i in by_bytes.items() if len(b) == 1 or self.parts[i] is not None}
        # and only if the merge rules, run on its own bytes, give it
        self.compatible: dict[tuple[int, int], bool] = {}
        made = {b: i for b, i in sorted(made.items(), key=lambda x: self.rank[x[1]]) if self.spans(i)}
        self.made = made
        self.automaton = ahocorasick.Automaton()
        for b, i in made.items():
            self.automaton.add_word(b.decode("latin-1"), (len(b), i))
        self.automaton.make_automaton()
        self.shorter: dict[int, int] = {}
        for b, i in made.items():
            for n in range(len(b) - 1, 0, -1):
                if (p := made.get(b[:n])) is not None:
                    self.shorter[i] = p
                    break
        self.size_of = [len(b) for b in self.bytes_of]
        for content, i in added.items():
            self.bytes_of[i] = content.encode()
        self.added = added
        self.special = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True)) + ")") if added else None
        self.split = regex.compile(SPLIT)
        self.offsets = np.concatenate([[0], np.cumsum([len(b) for b in self.bytes_of])]).astype(np.int64)
        self.blob = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)
        self.memo = T.Memo(self._chunk, CHUNK_ENTRIES)
        self.pieces = T.Memo(lambda piece: T.le32(self.encode_bytes(piece.encode())))

    # --- the pair-compatibility table, filled as pairs are met ---------------

    def pair_ok(self, left: int, right: int) -> bool:
        """Do the merge rules leave the boundary between these two tokens alone?

        Undo both tokens' merges from the latest to the earliest. At each moment the
        tokens next to the boundary are a pair that stood there; if that pair has a
        merge which comes before the merge undone last, it would have fired."""
        ok = self.compatible[left, right] = self._boundary_holds(left, right)
        return ok

    def _boundary_holds(self, a: int, b: int) -> bool:
        # left tokens merge first among equal ranks: undoing a right-hand token of the
        # same rank comes first, and a merge across of that rank would fire before it
        before = (float("inf"), 0)
        while True:
            across = self.merged.get((a, b))
            if across is not None and (across, 1) < before:
                return False
            ra = self.rank[a] if self.parts[a] else 0
            rb = self.rank[b] if self.parts[b] else 0
            if not ra and not rb:
                return True
            if ra > rb:
                before, a = (ra, 0), self.parts[a][1]
            else:
                before, b = (rb, 2), self.parts[b][0]

    def encode_bytes(self, data: bytes) -> list[int]:
        """Ids of one split piece."""
        whole = self.made.get(data)
        if whole is not None:
            return [whole]
        n = len(data)
        longest = [0] * n
        for end, (size, i) in self.automaton.iter(data.decode("latin-1")):
            longest[end - size + 1] = i  # ends come in order, so the longest stays
        open_ = bytearray(b"\x01") * (n + 1)  # positions from which the rest may still work
        out: list[int] = []
        pos, token = 0, longest[0]
        size_of, shorter, known = self.size_of, self.shorter.get, self.compatible.get
        while True:
            last = out[-1] if out else -1
            while True:
                end = pos + size_of[token]
                fits = open_[end]
                if fits and last >= 0:
                    fits = known((last, token))
                    if fits is None:
                        fits = self.pair_ok(last, token)
                if fits:
                    out.append(token)
                    pos = end
                    if pos == n:
                        return out
                    token = longest[pos]
                    break
                token = shorter(token, -1)
                if token < 0:
                    open_[pos] = 0
                    token = out.pop()
                    pos -= size_of[token]
                    break

    def spans(self, token: int) -> bool:
        """Do the merge rules, run on the token's own bytes, give the token?"""
        parts = self.parts[token]
        if parts is None:
            return True
        known = self.compatible.get((-1, token))
        if known is None:
            a, b = parts
            known = self.spans(a) and self.spans(b) and self._meets(a, b, self.rank[token])
            self.compatible[-1, token] = known
        return known

    def _meets(self, a: int, b: int, rank: int) -> bool:
        """No merge across the boundary fires before both halves are whole."""
        before = (rank, 1)
        while True:
            ra = self.rank[a] if self.parts[a] else 0
            rb = self.rank[b] if self.parts[b] else 0
            if not ra and not rb:
                return True
            if ra > rb:
                before, a = (ra, 0), self.parts[a][1]
            else:
                before, b = (rb, 2), self.parts[b][0]
            across = self.merged.get((a, b))
            if across is not None and (across, 1) < before:
                return False

    # --- whole texts ----------------------------------------------------------

    def _ids(self, text: str) -> bytes:
        """Ids of any stretch of text: added tokens, then split pieces."""
        piece = self.pieces.__getitem__
        if text.isascii() and text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):
            return piece(text)  # a word: the split pattern would give it back whole
        if not self.special or not self.special.search(text):
            return b"".join(map(piece, self.split.findall(text)))
        out = []
        for part in self.special.split(text):
            out += [T.le32([self.added[part]])] if part in self.added else map(piece, self.split.findall(part))
        return b"".join(out)

    def _chunk(self, text: str) -> tuple[bytes, str]:
        ids = self._ids(text)
        return ids, str(np.frombuffer(ids, dtype="<u4").tolist())[1:-1].replace(" ", "")

    def encode(self, text: str | None) -> tuple[bytes, str]:
        """Ids of a whole text: as little-endian uint32 bytes, and as decimal text."""
        if not text:
            return b"", ""
        if not T.splittable(text):
            return self._chunk(text)
        found = list(map(self.memo.__getitem__, T.chunks(text)))
        return b"".join([x[0] for x in found]), ",".join([x[1] for x in found if x[1]])

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that the ids stand for, by the offset table."""
        out = []
        for k in range(0, len(ids), DECODE_BLOCK):
            block = ids[k:k + DECODE_BLOCK].astype(np.int64)
            start = self.offsets[block]
            size = self.offsets[block + 1] - start
            ends = np.cumsum(size)
            total = int(ends[-1])
            place = np.arange(total, dtype=np.int64) + np.repeat(start - (ends - size), size)
            out.append(self.blob[place].tobytes())
        return b"".join(out)


_MODELS: dict[str, BPE] = {}


def model(path: str) -> BPE:
    """One model per process and vocabulary."""
    if path not in _MODELS:
        _MODELS[path] = BPE(path)
    return _MODELS[path]


def encode(df: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids`` (binary, little-endian uint32) of each whole text."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = model(vocabulary)
        for b in batches:
            yield b.drop(columns=[text]).assign(ids=[bpe.encode(x)[0] for x in b[text]])

    rest = [f for f in df.schema.fields if f.name not in (text, "ids")]
    kept = df.select(*[F.col(f"`{f.name}`") for f in rest], F.coalesce(F.col(text), F.lit("")).alias(text))
    schema = kept.drop(text).schema.add("ids", "binary")
    return kept.mapInPandas(run, schema)


def decode(df: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``text``: what its ids (as ``encode`` gives them) stand for."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = model(vocabulary)
        for b in batches:
            yield b.drop(columns=[ids]).assign(
                text=[bpe.decode(np.frombuffer(x or b"", dtype="<u4")).decode("utf-8", "replace") for x in b[ids]])

    kept = df.drop("text")
    return kept.mapInPandas(run, kept.drop(ids).schema.add("text", "string"))


def round_trip_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256. Encodes and decodes
    in one pass, so neither ids nor texts leave the task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = model(vocabulary)
        for b in batches:
            n, ids_hex, text_hex = [], [], []
            for text in b["text"]:
                with T.uncollected():
                    ids, written = bpe.encode(text)
                n.append(len(ids) // 4)
                ids_hex.append(hashlib.sha256(written.encode()).hexdigest())
                text_hex.append(hashlib.sha256(bpe.decode(np.frombuffer(ids, dtype="<u4"))).hexdigest())
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_tokens": n, "ids_sha256": ids_hex, "decoded_sha256": text_hex})

    kept = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return kept.mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

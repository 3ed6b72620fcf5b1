"""op1, op2, op7: against the tokenizers library, and exact round trips."""

import hashlib
import pickle
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from bondliq.llm import bpe, packing, token_files
from bondliq.llm.common import fresh_path
from bondliq.llm.queries import BYTE_BPE, QUERIES, WORD_BPE
from bondliq.llm.tokens import LibraryEncoder, library_encoder


def ids_of(data):
    return np.frombuffer(data, dtype="<u4").tolist()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


def test_encoder_equals_library_on_random_texts(library):
    rng = random.Random(3)
    letters = "aabcdeethnoi  \n\t'sSTr12€é　\xa0\x1c.,!-$|"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["a" * 20_000, " " * 500, "\n " * 300, "<|endoftext|> x<|endoftext|>", "".join(rng.choice("etaoin") for _ in range(20_000))]
    model, encoder = bpe.model(BYTE_BPE), library_encoder(BYTE_BPE)
    for text, ids in zip(texts, encoder.ids(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        got, decimal = model.encode(text)
        assert ids_of(got) == want == ids_of(ids) and decimal == ",".join(map(str, want))
        assert model.decode(np.array(want, dtype=np.uint32)).decode() == text


@pytest.mark.parametrize("path, word_ends", [(BYTE_BPE, False), (WORD_BPE, True)])
def test_letter_runs_go_to_the_model_at_once(path, word_ends):
    rng = random.Random(11)
    letters = "aEitsZ\u00c9\u00dfx\u00ff\u00d7\u00b5" + "    ..,'\n" + "1\u0301\u0130\u0958"
    texts = ["", " ", " x", "x ", "<|endoftext|>", "a<|endoftext|>.", "'s it's", "y" * 300 + "."]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    library, encoder = Tokenizer.from_file(path), LibraryEncoder(path, word_ends, 300)
    for k in range(0, len(texts), 40):
        some = texts[k:k + 40]
        assert [ids_of(x) for x in encoder.ids(some)] == [library.encode(x, add_special_tokens=False).ids for x in some]
        assert len(encoder.young) < 300 and not any(len(x) > 64 for x in (*encoder.young, *encoder.old))

    # words and words with closing marks need no call of the whole library once the marks are known
    class Model:
        def encode(self, *_, **__):
            raise AssertionError("a run of letters was encoded whole")

        encode_batch_fast = encode

    encoder.ids(["a. b,"])
    encoder.tokenizer = Model()
    text = "Unmet \u00c9t\u00e9words, ofletters\u00df."
    assert ids_of(encoder.ids([text])[0]) == library.encode(text, add_special_tokens=False).ids


def test_broadcast_encoder_is_its_path():
    encoder = library_encoder(WORD_BPE, True)
    encoder.ids(["some words kept"])
    data = pickle.dumps(encoder)
    assert len(data) < 1000 and not pickle.loads(data).young


def test_split_pattern_agrees_on_all_code_points(library):
    model = bpe.model(BYTE_BPE)
    for low in range(0, 0x20000, 512):
        text = "".join(f"a{chr(c)}1 {chr(c)}" for c in range(low, low + 512) if not 0xD800 <= c < 0xE000)
        assert ids_of(model.encode(text)[0]) == library.encode(text, add_special_tokens=False).ids


def test_op1(docs_of, awkward, library):
    got = sorted(map(tuple, bpe.round_trip_digests(docs_of(awkward), BYTE_BPE).collect()), key=str)
    want = []
    for d, text, _ in awkward:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_encode_and_decode_round_trip(docs_of, awkward):
    docs = docs_of(awkward).select("doc_id", "text", "lang")
    back = bpe.decode(bpe.encode(docs, BYTE_BPE), BYTE_BPE)
    key = lambda r: str((r["doc_id"], r["text"]))
    assert sorted(map(key, back.collect())) == sorted(str((d, t or "")) for d, t, _ in awkward)


def test_op2_files(spark, docs_of, awkward, library):
    path = fresh_path(spark, "tokens")
    token_files.write(docs_of(awkward), path, BYTE_BPE, end_id=2, parts=3)
    rows = token_files.read(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == sorted([d for d, _, _ in awkward], key=lambda d: (d is not None, d))
    at = 0
    wanted = sorted(str((d, library.encode(t or "", add_special_tokens=False).ids + [2])) for d, t, _ in awkward)
    assert sorted(str((r["doc_id"], ids_of(r["ids"]))) for r in rows) == wanted
    for r in rows:
        assert r["start"] == at and r["n_tokens"] == len(ids_of(r["ids"]))
        at += r["n_tokens"]
    digests = {(r["start"], r["ids_crc32"]) for r in token_files.read(spark, path, digest=True).collect()}
    assert digests == {(r["start"], zlib.crc32(bytes(r["ids"]))) for r in rows}


def test_plan_keeps_every_capacity():
    rng = np.random.default_rng(0)
    for rule in ("norm", "dot"):
        for _ in range(20):
            lengths = np.unique(rng.integers(1, 60, 15))
            counts = rng.integers(1, 30, len(lengths))
            capacity = np.array([60, 5, 2000.0])
            lengths, counts = lengths[lengths**2 <= 2000], counts[lengths**2 <= 2000]
            runs = packing.plan(lengths, counts, capacity, np.array([1.0, 0.5, 0.5]), rule)
            bins = {}
            for length in lengths:
                mine = sorted(r for r in runs.tolist() if r[0] == length)
                ends = [r[1] for r in mine[1:]] + [int(counts[lengths == length][0])]
                for (_, begin, per, first, offset), end in zip(mine, ends):
                    for k in range(end - begin):
                        bins.setdefault(first + k // per, []).append((offset + k % per * length, length))
            assert sum(len(b) for b in bins.values()) == counts.sum()
            for b in bins.values():
                at = 0
                for offset, length in sorted(b):
                    assert offset == at
                    at += length
                assert at <= 60 and len(b) <= 5 and sum(n**2 for _, n in b) <= 2000


def test_op7(docs_of, awkward):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    rows = packing.pack(docs_of(awkward), WORD_BPE, end_id=1, tokens=512).collect()
    want = []
    for d, text, _ in awkward:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        want += [(d, k // 512, k, len(ids[k:k + 512]), zlib.crc32(np.array(ids[k:k + 512], dtype="<u4").tobytes()))
                 for k in range(0, len(ids), 512)]
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(want, key=str)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 512
    total = sum(r["length"] for r in rows)
    assert len(sequences) <= -(-total // 512) + 1


def test_empty_tables(spark, docs_of):
    none = docs_of([(1, "x", "en")]).where("doc_id = 0")
    assert bpe.round_trip_digests(none, BYTE_BPE).count() == 0
    assert token_files.written_and_read(none, BYTE_BPE, 2).count() == 0
    assert packing.pack(none, WORD_BPE, 1).count() == 0


def test_registered(spark, sf):
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert QUERIES["op1_bpe"](spark, sf).count() == n

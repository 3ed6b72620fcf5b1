"""op11: against a brute-force search over all words."""

import collections
import random
import re
import zlib

import numpy as np

from bondliq.llm import spelling

UP = {ord(a): b for a, b in zip(spelling.UPPER, spelling.LOWER)}


def words_of(rows):
    n = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UP)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    n = words_of(rows)
    by = collections.defaultdict(list)
    for w in n:
        by[len(w)].append(w)
    found = {w: [o for k in (-1, 0, 1) for o in by[len(w) + k] if near(w, o)] for w in n}
    form = {}
    for w, others in found.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(found[w]), n[form[w]] if form[w] else None)
    return out


def texts(seed=3, docs=400):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(5, 9))) for _ in range(40)] + ["aabbccaa", "ÉCLAIRS", "straße", "x" * 300]
    out = []
    for i in range(docs):
        own = []
        for _ in range(rng.randint(0, 40)):
            w = rng.choice(base[: 1 + int(len(base) * rng.random() ** 2)])
            for _ in range(rng.choice([0, 0, 0, 1, 2])):
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("abÀé") + w[k:], w[:k] + rng.choice("abÀé") + w[k + 1:]])
            own.append(rng.choice([w, w.title(), w.upper()]) if rng.random() < 0.2 else w)
        out.append((None if i % 50 == 7 else i, rng.choice([" ", ", ", "1"]).join(own)))
    return out + [(9000, None), (9001, ""), (9002, "ab a b Kelvin"), (9003, "aaaaaaaaab " * 9), (9003, "aaaaaaaaab " * 9)]


def result(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_equal_to_brute_force(docs_of):
    rows = texts()
    got = result(spelling.variants(docs_of([(d, t, "en") for d, t in rows])))
    want = brute(rows)
    assert got == want
    assert any(r != f and f for f, r, *_ in want.values()), "no chain longer than one form"


def test_many_windows_give_the_same(docs_of, monkeypatch):
    rows = texts(5, 150)
    monkeypatch.setattr(spelling, "WINDOW", 3)
    monkeypatch.setattr(spelling, "EDITS", 500)
    assert result(spelling.variants(docs_of([(d, t, "en") for d, t in rows]))) == brute(rows)


def test_filter_passes_few_words_that_are_not_there(docs_of):
    rng = np.random.default_rng(1)
    words = ["".join(map(chr, w)) for w in rng.integers(97, 123, size=(20_000, 8))]
    shards = spelling.Shards({8: len(words)})
    h = spelling._mixed((spelling._values(spelling._points(words)) * spelling._powers(8)[:-1]).sum(1, dtype=np.uint64))
    lanes = np.zeros((shards.blocks, spelling.LANES), dtype=np.uint64)
    at, bits = shards.address(h, 8).astype(np.int64), spelling._bits(h)
    for k in range(spelling.LANES):
        np.bitwise_or.at(lanes[:, k], at, np.uint64(1) << ((bits >> np.uint64(6 * k)) & np.uint64(63)))
    window = spelling.Window(0, lanes)
    assert len(window.positive(h, shards.address(h, 8))) == len(words)
    other = ["".join(map(chr, w)) for w in rng.integers(192, 256, size=(20_000, 8))]
    h = spelling._mixed((spelling._values(spelling._points(other)) * spelling._powers(8)[:-1]).sum(1, dtype=np.uint64))
    assert len(window.positive(h, shards.address(h, 8))) < 0.01 * len(other)


def test_awkward_and_empty(docs_of, awkward):
    got = result(spelling.variants(docs_of(awkward)))
    assert got == brute([(d, t) for d, t, _ in awkward])
    assert result(spelling.variants(docs_of(awkward).where("doc_id = -1"))) == {}

"""op3, op6, op10: held-out accuracy and brute force."""

import collections
import math
import os
import re
import zlib

import numpy as np
import pytest

from bondliq.llm import langid, lm, quality
from bondliq.llm.elias_fano import EliasFano
from bondliq.session import shared_dir
from tests.conftest import SF01


def crc(d, n):
    return zlib.crc32(str(d).encode()) % n


def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = quality.score(docs, labels).collect()
    assert len(rows) == docs.count()
    held = [(r["predicted"], known[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in known]
    assert np.mean([a == b for a, b in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) and r["held_out"] == (crc(r["doc_id"], 5) == 0) for r in rows)


def test_quality_edge_cases(spark, docs_of, awkward):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality.score(docs_of(awkward), none).collect()
    assert len(rows) == len(awkward) and all(r["score"] == 0.5 for r in rows)
    few = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (5, 1, 0), (6, None, 0), (8, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality.score(docs_of(awkward), few).count() == len(awkward)
    assert quality.kept(docs_of(awkward), few).columns == docs_of(awkward).columns
    assert quality.score(docs_of(awkward).where("doc_id = 99"), few).count() == 0


def test_isotonic_does_not_fall():
    rng = np.random.default_rng(1)
    x, n = np.arange(50.0), rng.integers(1, 9, 50).astype(float)
    _, y = quality.isotonic(x, n, rng.uniform(0, 1, 50) * n)
    assert (np.diff(y) >= 0).all()


def test_language_on_held_out(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = langid.predict(docs).collect()
    assert len(rows) == len(lang)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]) > 0.97
    assert all(r["held_out"] == (crc(r["doc_id"], 3) == 1) for r in rows)


def test_language_edge_cases(docs_of, awkward):
    rows = langid.predict(docs_of([*awkward, (20, "123 456 !!", "en")])).collect()
    assert len(rows) == len(awkward) + 1
    for r in rows:
        if r["doc_id"] in (1, 2, 3, 20):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("en", "de", "fr") and 0 < r["score"] <= 1
    unlearned = langid.predict(docs_of([(1, "abc", None)])).collect()
    assert unlearned[0]["lang_pred"] == "und"
    kept = langid.kept(docs_of(awkward)).collect()
    assert {r["doc_id"] for r in kept}.isdisjoint({1, 2, 3})


def test_elias_fano():
    rng = np.random.default_rng(0)
    for top in (1, 5, 100, 10**4, 10**9, 1 << 61):
        for n in (1, 2, 63, 64, 65, 400):
            v = np.sort(rng.integers(0, top + 1, n))
            e = EliasFano.build(v)
            x = np.concatenate([rng.integers(0, top + 5, 100), v, v + 1, [0]])
            assert (e.get(np.arange(n)) == v).all() and (e.successor(x) == np.searchsorted(v, x)).all()
            u = np.unique(v)
            place = {k: i for i, k in enumerate(u.tolist())}
            assert EliasFano.build(u).find(x).tolist() == [place.get(k, -1) for k in x.tolist()]


@pytest.mark.parametrize("case", ["table", "awkward"])
def test_lm_equals_brute_force(spark, docs_of, awkward, sf, case):
    docs = spark.read.parquet(f"{sf}/documents.parquet") if case == "table" else docs_of([r for r in awkward if r[0]])
    texts = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) + [None]) for d, t in texts]
    train = [t for d, t in split if crc(d, 10)]
    one = collections.Counter(w for t in train for w in t)
    n, v, d = sum(one.values()), len(one), lm.DISCOUNT
    two = {k: c for k, c in collections.Counter(p for t in train for p in zip(t, t[1:])).items() if c >= 2}
    three = {k: c for k, c in collections.Counter(p for t in train for p in zip(t, t[1:], t[2:])).items() if c >= 3}
    kept1, kept2 = collections.Counter(), collections.Counter()
    for (a, _), c in two.items():
        kept1[a] += c - d
    for (a, b, _), c in three.items():
        kept2[a, b] += c - d

    def p1(w):
        return (one.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))

    def p2(w, a):
        return max(two.get((a, w), 0) - d, 0) / one[a] + (1 - kept1[a] / one[a]) * p1(w) if a in one else p1(w)

    def p3(w, a, b):
        return max(three.get((a, b, w), 0) - d, 0) / two[a, b] + (1 - kept2[a, b] / two[a, b]) * p2(w, b) if (a, b) in two else p2(w, b)

    got = sorted(lm.score(docs, min_count=(1, 2, 3)).collect(), key=lambda r: (r["doc_id"], r["base_score"]))
    want = []
    for doc, t in split:
        base = sum(math.log10(p1(w)) for w in t)
        score = math.log10(p1(t[0])) + sum(math.log10(p2(t[1], t[0]) if i == 1 else p3(t[i], t[i - 2], t[i - 1])) for i in range(1, len(t)))
        want.append((doc, len(t), sum(w in one for w in t), base, score))
    for r, w in zip(got, sorted(want, key=lambda x: (x[0], x[3])), strict=True):
        assert (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (*w[:3], n)
        assert r["base_score"] == pytest.approx(w[3], rel=1e-9) and r["score"] == pytest.approx(w[4], abs=3e-4 * w[1])


def test_lm_in_many_parts_leaves_no_model(spark, docs_of):
    """Contexts that go on over several parts; nothing but the result stays on the disk."""
    docs = docs_of([(i, " ".join(f"the w{i * j % 97} of the x{(i + j) ** 2 % 1009}" for j in range(60)), "en") for i in range(120)])
    folder = os.path.join(shared_dir(spark).removeprefix("file:"), "llm")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    found = {parts: sorted(map(tuple, lm.score(docs, parts=parts).collect())) for parts in (1, 9)}
    assert found[1] == found[9] and len(found[1]) == 120
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before if any(f for *_, f in os.walk(os.path.join(folder, name)))}
    assert left == {"scores"}


def test_lm_runs_are_small_and_whole():
    rng = np.random.default_rng(3)
    keys, counts = lm.counted(rng.integers(-(1 << 40), 1 << 40, 200_000))
    rows = lm.runs(keys, counts, np.array([-(1 << 39), 0, 1 << 39]))
    assert rows["part"].tolist() == [0, 1, 2, 3] and sum(map(len, [*rows["gaps"], *rows["counts"]])) <= 5 * len(keys)
    back = [np.cumsum(lm.unpacked(r.gaps, r.n)) + np.uint64(r.first % (1 << 64)) for r in rows.itertuples()]
    assert (np.concatenate(back).view(np.int64) == keys).all()
    assert (np.concatenate([lm.unpacked(r.counts, r.n) for r in rows.itertuples()]) == counts).all()
    far = np.array([np.iinfo(np.int64).min, -1, np.iinfo(np.int64).max])
    row = next(lm.runs(far, np.array([1, 1 << 40, 2]), np.array([], dtype=np.int64)).itertuples())
    assert (np.cumsum(lm.unpacked(row.gaps, 3)) + np.uint64(row.first % (1 << 64))).view(np.int64).tolist() == far.tolist()
    got = lm.added(np.array([5, 3, 5, far[0], far[2]]), np.array([1, 2, 1 << 40, 4, 5]))
    assert [x.tolist() for x in got] == [[far[0], 3, 5, far[2]], [4, 2, (1 << 40) + 1, 5]]


def test_lm_without_training_rows(docs_of):
    rows = lm.score(docs_of([(None, "a b", "en")])).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["score"]) for r in rows] == [(3, 0, 0, 0.0)]
    assert lm.score(docs_of([(1, "a", "en")]).where("doc_id = 2")).count() == 0


def test_lm_counts_beyond_32_bits_and_too_many_words():
    big = np.array([1, 2**32 + 5, 2**40], dtype=np.int64)
    assert lm.narrow(big).tolist() == big.tolist()
    assert lm.narrow(np.array([2**32 - 1])).dtype == np.uint32
    lm.check_ids(2**31)
    with pytest.raises(ValueError):
        lm.check_ids(2**31 + 1)


def test_language_model_keeps_numbers_in_arrays():
    langs, words = ["de", "en"], {"haus": [3, 0], "house": [0, 4]}
    tables = [{} for _ in range(langid.LONGEST + 1)]
    for w, n in words.items():
        for size in range(1, langid.LONGEST + 1):
            for g in langid.grams(w, size):
                tables[size][g] = [x + y for x, y in zip(tables[size].get(g, [0, 0]), n)]
    hashes = np.array([langid.hashed(w) for w in words], dtype=np.uint64)
    order = np.argsort(hashes)
    totals = np.array([[3.0, 4.0]] + [np.sum(list(t.values()), axis=0) for t in tables[1:]])
    model = langid.Model(langs, (hashes[order], np.array(list(words.values()), float)[order]), tables, totals)
    logs = [model._logs(np.array(list(t.values())), totals[n]) if n else None for n, t in enumerate(tables)]
    found = [logs[4][list(tables[4]).index(g)] for g in langid.grams("mouse", 4) if g in tables[4]]
    assert np.frombuffer(model._word("mouse")).tolist() == [sum(x) / len(found) for x in zip(*found)]
    assert model.classify("Mouse haus, Haus") == model.classify("haus haus mouse") and model.classify("qq")[1] == 0.5
    # a worker holds the whole model and memo: no object for each number
    assert all(type(x) is int for t in model.grams for x in t.values())
    assert all(type(x) is bytes for x in model.memo.values())

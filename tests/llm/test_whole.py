"""Nothing is left out: n-grams seen once, whole entities, rare languages, rows without id."""

import collections
import math
import re

import pytest

import corpus_pipeline
from bondliq.llm import langid, lm, packing, pii
from bondliq.llm.queries import QUERIES, WORD_BPE
from tests.llm.test_learned import crc


def test_lm_query_keeps_ngrams_seen_once(spark, sf):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) + [None]) for d, t in texts]
    train = [t for d, t in split if crc(d, 10)]
    one = collections.Counter(w for t in train for w in t)
    two = collections.Counter(p for t in train for p in zip(t, t[1:]))
    three = collections.Counter(p for t in train for p in zip(t, t[1:], t[2:]))
    after1, after2 = collections.Counter(a for a, _ in two), collections.Counter(x[:2] for x in three)
    n, d = sum(one.values()), lm.DISCOUNT
    assert min(two.values()) == min(three.values()) == 1

    def p1(w):
        return (one[w] + 0.1) / (n + 0.1 * (len(one) + 1))

    def p2(w, a):
        return (max(two[a, w] - d, 0) + d * after1[a] * p1(w)) / one[a] if one[a] else p1(w)

    def p3(w, a, b):
        return (max(three[a, b, w] - d, 0) + d * after2[a, b] * p2(w, b)) / two[a, b] if two[a, b] else p2(w, b)

    want = sorted((doc, len(t), math.log10(p1(t[0])) + sum(
        math.log10(p2(t[1], t[0]) if i == 1 else p3(t[i], t[i - 2], t[i - 1])) for i in range(1, len(t)))) for doc, t in split)
    got = sorted((r["doc_id"], r["n_tokens"], r["score"]) for r in QUERIES["op10_lm"](spark, sf).collect())
    for r, w in zip(got, want, strict=True):
        assert r[:2] == w[:2] and r[2] == pytest.approx(w[2], abs=3e-4 * w[1])


def test_language_sample_keeps_rare_languages_and_all_words(spark, docs_of):
    def word(i, letters):
        out = ""
        for _ in range(5):
            i, k = divmod(i, 10)
            out += letters[k]
        return out

    # 4,000 rows of a hot language with 70,000 words, each seen more often than a rare one's
    hot = [(i, " ".join(word((20 * i + k) % 70_000, "abcdefghij") for k in range(40)), "hot") for i in range(4000)]
    rare = [(9000 + i, " ".join(word(40 * i + k, "jihgfedcba") + "j" for k in range(40)), "rare") for i in range(3)]
    model = langid.fit(docs_of(hot + rare), train_rows=1000)
    assert model.langs == ["hot", "rare"]
    assert all(model.known(w) >= 0 for _, text, _ in rare for w in text.split())
    assert all(model.classify(text)[0] == "rare" for _, text, _ in rare)
    assert all(model.classify(text)[0] == "hot" for _, text, _ in hot[:50])
    assert 800 * 20 < len(model.hashes) <= 1200 * 40 + 120
    every = langid.fit(docs_of(hot + rare))
    assert all(every.known(w) >= 0 for _, text, _ in hot + rare for w in text.split())


def test_language_shares():
    shares = langid.shares({"a": 10**9, "b": 10**9, "c": 3}, 20_000, 200)
    assert shares["c"] == 1 and shares["a"] * 10**9 == pytest.approx(9998, abs=2) == shares["b"] * 10**9
    assert langid.shares({str(i): 1000 for i in range(500)}, 20_000, 200)["7"] == 0.2


def letters(i):
    return "".join("abcdefghij"[int(c)] for c in f"{i:04}")


def test_pii_left_contexts_of_whole_phones_and_spaced_identifiers(spark):
    # every phone has its own word on the right, so only the left context can teach
    seeds = [(i, f"words before phone: +1 (499) 555-{1000 + i} {letters(i)} and words after") for i in range(40)]
    unseen = [(100 + i, f"some text phone: (499) 555-650{i} {letters(500 + i)} more") for i in range(3)]
    grouped = [(200, "some text phone: 12 34 56 78 end"), (201, "some text phone: 12 34\n56 end"), (202, "phone: 77 +1 (499) 555-2000 88 end")]
    plain = [(300 + i, f"there are {i} apples in box{i} today") for i in range(30)]
    texts = dict(seeds + unseen + grouped + plain)
    rows = {r["doc_id"]: r["spans"] for r in pii.report(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}

    def cut(d):
        return [(k, texts[d][int(a):int(b)]) for k, a, b in (x.split(":") for x in rows[d].split(",") if x)]

    assert all(cut(i) == [("phone", f"+1 (499) 555-{1000 + i}")] for i in range(40))
    assert all(cut(100 + i) == [("phone", f"(499) 555-650{i}")] for i in range(3))
    assert cut(200) == [("phone", "12 34 56 78")] and cut(201) == [("phone", "12 34")]
    assert cut(202) == [("phone", "77"), ("phone", "+1 (499) 555-2000 88")]
    assert all(cut(300 + i) == [] for i in range(30))


def test_near_dup_stage_with_repeated_and_null_ids(spark, sf, docs_of):
    def text(k, last="end"):
        return " ".join(f"w{k}x{i}" for i in range(60)) + " " + last

    rows = [(1, text(1), "en"), (2, text(1, "fin"), "en"), (2, text(2), "en"),  # a near-copy and a clean text under one id
            (3, text(3), "en"), (3, text(3, "fin"), "en"), (3, text(3, "fin"), "en"),  # near-copies under one id
            (None, text(4), "en"), (None, text(4), "en"), (None, text(4, "fin"), "en"),  # copies without id
            (None, text(1, "out"), "en"), (None, text(5), "en"), (None, "", "en"), (9, " ", "en"), (9, " ", "en"), (10, None, "en")]
    out = corpus_pipeline.near_dup_stage(spark, docs_of(rows), sf)
    got = sorted(((r["doc_id"] or 0, (r["text"] or "").split(" ")[0]) for r in out.collect()))
    assert got == [(0, ""), (0, "w4x0"), (0, "w5x0"), (1, "w1x0"), (2, "w2x0"), (3, "w3x0"), (9, ""), (10, "")]


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_pack_under_binding_capacities(docs_of, rule):
    docs = docs_of([(i, " ".join(["word"] * (1 + i % 12)), "en") for i in range(300)])
    tokens, most, cost = 40, 4, 300
    rows = packing.pack(docs, WORD_BPE, end_id=1, tokens=tokens, max_pieces=most, max_cost=float(cost), weights=(1.0, 1.0, 1.0), rule=rule).collect()
    assert sorted((r["doc_id"], r["piece"]) for r in rows) == [(i, 0) for i in range(300)]
    by_sequence = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: r["offset"]):
        assert r["offset"] == sum(by_sequence[r["sequence_id"]])
        by_sequence[r["sequence_id"]].append(r["length"])
    sizes = [(sum(x), len(x), sum(n * n for n in x)) for x in by_sequence.values()]
    assert all(a <= tokens and b <= most and c <= cost for a, b, c in sizes)
    smallest = min(r["length"] for r in rows)
    full = [(a + smallest > tokens, b == most, c + smallest ** 2 > cost) for a, b, c in sizes]
    assert (False, True, False) in full and (False, False, True) in full  # each binds on its own

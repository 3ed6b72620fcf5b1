"""op4, op8, op9: against brute force."""

import collections
import random
import re

import numpy as np
import pytest

import bondliq.llm.components as components_module
from bondliq.llm import jaccard, mih, neardup
from bondliq.llm.components import components

SCHEMA = "vec_id long, embedding array<float>, label int"
BAD = [(9001, None, 0), (9002, [], 0), (9003, [0.0] * 8, 0), (9004, [float("nan")] + [1.0] * 7, 0), (9005, [None] + [1.0] * 7, 0),
       (9006, [float("inf")] * 8, 0), (None, [1.0] * 8, 0)]


def roots_of(nodes, links):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def vectors(rng, groups=12, size=25, dim=8):
    out = []
    for g in range(groups):
        centre = rng.normal(size=dim)
        spread = rng.choice([0.02, 0.1, 0.3])
        out += [centre + spread * rng.normal(size=dim) for _ in range(size)]
    out += [out[0], out[0], 3 * out[1]]
    return np.array(out, dtype=np.float32)


def test_components_of_paths_stars_and_chains(spark):
    rng = random.Random(0)
    links = [(i, i + 1) for i in range(50)] + [(200, 200 + i) for i in range(1, 40)] + [(399, 300 + i) for i in range(40)]
    links += [(rng.randint(500, 700), rng.randint(500, 700)) for _ in range(120)]
    nodes = {x for e in links for x in e}
    want = {x: r for x, r in roots_of(nodes, links).items() if x != r}
    got = components(spark.createDataFrame(links, "a long, b long"))
    assert {r["node"]: r["root"] for r in got.collect()} == want


@pytest.mark.parametrize("chunk", [1500, 16])
def test_op4(spark, docs_of, monkeypatch, chunk):
    monkeypatch.setattr(neardup, "CHUNK", chunk)
    x = vectors(np.random.default_rng(2))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    df = spark.createDataFrame([*rows, *BAD], SCHEMA).repartition(4)
    got = {r["vec_id"]: tuple(r)[1:] for r in neardup.near_duplicates(df).collect()}
    d = x.astype(float)
    n = np.linalg.norm(d, axis=1)
    close = (d @ d.T) / np.outer(n, n) >= 0.95
    np.fill_diagonal(close, False)
    root = roots_of(range(len(x)), np.argwhere(close).tolist())
    for i in range(len(x)):
        assert got[i] == (close[i].sum(), root[i], root[i] == i)
    for i in range(9001, 9007):
        assert got[i] == (0, i, True)
    assert len(got) == len(x) + 6


def test_vectors_of_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], SCHEMA)
    assert neardup.near_duplicates(none).count() == 0
    assert mih.search(none, none).count() == 0
    bad = spark.createDataFrame(BAD, SCHEMA)
    assert neardup.near_duplicates(bad).count() == 6 and mih.search(bad, bad).count() == 0


def test_op9_recall_and_exact_scores(spark, docs_of):
    x = np.random.default_rng(5).normal(size=(1500, 16)).astype(np.float32)
    x = np.vstack([x, vectors(np.random.default_rng(6), dim=16)])
    df = spark.createDataFrame([*[(i, v.tolist(), 0) for i, v in enumerate(x)], *BAD], SCHEMA).repartition(3)
    got = collections.defaultdict(list)
    for r in mih.search(df, df.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    hit = total = 0
    for q in range(0, len(x), 100):
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        d[q] = np.inf
        best = np.lexsort((np.arange(len(x)), d))[:10].tolist()
        hit += len(set(best) & {v for v, _ in got[q]})
        total += 10
        assert all(s == pytest.approx(d[v], rel=1e-12) for v, s in got[q])
        assert [s for _, s in got[q]] == sorted(s for _, s in got[q])
    assert len(got) == len(range(0, len(x), 100)) and hit / total >= 0.9


def test_op9_small_tables_return_all(spark, docs_of):
    df = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [0.0, 1.0], 0)], SCHEMA)
    rows = [(r["query_id"], r["rank"], r["vec_id"]) for r in mih.search(df, df.where("vec_id % 100 = 0")).collect()]
    assert sorted(rows) == [(0, 1, 1), (0, 2, 2)]


def shingled(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()


def near_texts(rng, groups=8, copies=14, words=120):
    out = []
    for g in range(groups):
        base = [f"w{rng.randint(0, 400)}" for _ in range(words)]
        for _ in range(copies):
            t = list(base)
            for _ in range(rng.randint(0, 6)):
                t[rng.randrange(words)] = f"new{rng.randint(0, 10**6)}"
            out.append(" ".join(t))
    passage = " ".join(f"shared{i}" for i in range(60))
    out += [passage + " " + " ".join(f"own{k}x{i}" for i in range(rng.randint(3, 90))) for k in range(25)]
    return out


@pytest.mark.parametrize("leaf", [1_500_000, 2500])
def test_op8(docs_of, awkward, monkeypatch, leaf):
    monkeypatch.setattr(jaccard, "LEAF", leaf)
    rows = [(100 + i, t, "en") for i, t in enumerate(near_texts(random.Random(4)))]
    rows += [r for r in awkward if r[0]] + [(50, "A b", "en"), (51, "a  B", "en"), (52, "a b c d", "en"), (53, "A B\tc D", "en")]
    got = collections.defaultdict(set)
    for r in jaccard.join(docs_of(rows)).collect():
        got[r["doc_id"]].add((r["n_shingles"], r["component_id"]))
    sets = {d: shingled(t, 4) for d, t, _ in rows}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[:i]
             if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    root = roots_of(ids, links)
    assert got == {d: {(len(sets[d]), root[d])} for d in ids}


def test_op8_edge_cases(docs_of):
    rows = jaccard.join(docs_of([(None, "a b c d e", "en"), (1, "a b c d e", "en"), (2, None, "en"), (3, "", "en")])).collect()
    assert sorted((tuple(r) for r in rows), key=str) == sorted([(None, 2, None), (1, 2, 1), (2, 0, 2), (3, 0, 3)], key=str)
    assert jaccard.join(docs_of([(1, "x", "en")]).where("doc_id = 0")).count() == 0


def test_op8_large_region_of_unrelated_texts_is_not_split(docs_of, monkeypatch):
    """A shared passage chains texts that have no partner: no block of them meets another."""
    monkeypatch.setattr(jaccard, "LEAF", 2500)
    seen = []
    joined = jaccard._joined
    monkeypatch.setattr(jaccard, "_joined", lambda rows, large, n, t: (seen.append(n), joined(rows, large, n, t))[1])
    passage = " ".join(f"shared{i}" for i in range(40))
    texts = [passage + " " + " ".join(f"own{k}x{i}" for i in range(80)) for k in range(60)]
    texts += [texts[k] + " more" for k in (3, 4)]  # two partners
    got = {r["doc_id"]: r["component_id"] for r in jaccard.join(docs_of([(i, t, "en") for i, t in enumerate(texts)])).collect()}
    assert got == {i: {60: 3, 61: 4}.get(i, i) for i in range(62)}
    assert seen == [0]


@pytest.mark.parametrize("ways", [jaccard.WAYS, 1, 0])
@pytest.mark.parametrize("threshold", [(85, 100), (80, 100)])
def test_op8_linked_sets_share_a_part(monkeypatch, threshold, ways):
    """As many differences as a link allows, at all sizes; without ways to cut, too."""
    monkeypatch.setattr(jaccard, "WAYS", ways)
    parts, rng, pairs = jaccard.Parts(threshold), np.random.default_rng(7), 0
    for n in [*range(1, 120), 333, 1000, 2500]:
        for _ in range(6):
            u = rng.integers(0, 2**64, n, dtype=np.uint64)
            common = jaccard.need(n, threshold)
            left = int(rng.integers(0, n - common + 1))
            x, y = np.sort(u[:common + left]), np.sort(np.concatenate([u[:common], u[common + left:]]))
            if left in (0, n - common) or 2 * left > n - common:  # all on one side, or on both
                pairs += 1
                assert len(x) == len(y) == common or np.intersect1d(parts.names(x), parts.names(y)).size
                assert len(x) == len(y) == common or np.intersect1d(parts.names(x, 3), parts.names(y, 3)).size
    assert pairs > 100


def test_op8_met_is_the_connected_sets():
    rng = np.random.default_rng(3)
    for n, names in ((0, 1), (1, 1), (40, 30), (400, 300), (400, 900)):
        h, node = rng.integers(0, names, n).astype(np.uint64), rng.integers(-60, 200, n)
        a, b = jaccard.met(h, node)
        links = [(x, y) for k in range(names) for x in node[h == k].tolist() for y in node[h == k].tolist()]
        root = roots_of(node.tolist(), links)
        assert dict(zip(a.tolist(), b.tolist())) == {x: r for x, r in root.items() if x != r}


def test_op8_texts_that_share_common_phrases_make_no_region(docs_of, monkeypatch):
    """Phrases met all over the table chain hardly any texts, so a larger table has no larger regions."""
    sizes = []
    refined = jaccard.refined
    monkeypatch.setattr(jaccard, "refined", lambda members, *rest: (sizes.append(members.count()), refined(members, *rest))[1])
    rng = random.Random(5)
    phrases = [" ".join(f"p{k}w{i}" for i in range(6)) for k in range(80)]
    texts = [" ".join(rng.choice(phrases) if rng.random() < 0.6 else " ".join(f"own{k}x{j}x{i}" for i in range(6)) for j in range(16)) for k in range(150)]
    texts += [texts[k] + " more" for k in (3, 4)]  # two partners
    got = {r["doc_id"]: r["component_id"] for r in jaccard.join(docs_of([(i, t, "en") for i, t in enumerate(texts)])).collect()}
    assert got == {i: {150: 3, 151: 4}.get(i, i) for i in range(152)}
    assert 4 <= sizes[0] < 50


@pytest.mark.parametrize("task, tables", [(0, 3), (10**6, 2)])
def test_components_in_rounds_or_one_task(spark, monkeypatch, task, tables):
    """Rounds end in the same roots as one task, which writes no more than its input and its result."""
    monkeypatch.setattr(components_module, "TASK", task)
    made, written = [], components_module.written
    monkeypatch.setattr(components_module, "written", lambda df, name: (made.append(name), written(df, name))[1])
    rng = random.Random(9)
    links = [(rng.randint(-80, 80), rng.randint(-80, 80)) for _ in range(90)] + [(i, i + 1) for i in range(1000, 1080)]
    root = roots_of({x for link in links for x in link}, links)
    got = components(spark.createDataFrame([*links, (None, 5), (7, None)], "a long, b long"))
    assert sorted(tuple(r) for r in got.collect()) == sorted((x, r) for x, r in root.items() if x != r)
    assert len(made) >= tables and (task == 0 or len(made) == tables)

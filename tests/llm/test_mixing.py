"""op12: against a plain simulation of the queues."""

import collections
import hashlib
import re
from fractions import Fraction

import pytest

from bondliq.llm import mixing

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas", "PythonUDF")


def brute(rows, weights=(3, 1, 2)):
    """rows (doc_id, text, source) -> multiset of results."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    total = collections.Counter()
    for (_, _, s), n in zip(rows, size):
        total[s] += n
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, full = Fraction(3 * sum(size), 2), set()
    while True:
        left = budget - sum(2 * total[s] for s in full)
        open_weight = sum(weight[s] for s in order if s not in full)
        target = {s: Fraction(2 * total[s]) if s in full else left * weight[s] / open_weight for s in order}
        above = {s for s in order if target[s] > 2 * total[s]}
        if not above:
            break
        full |= above
    digest = [hashlib.md5(f"{'' if d is None else d}:{t or ''}".encode()).hexdigest() for d, t, _ in rows]
    queue = []
    for f, s in enumerate(order):
        own = sorted((i for i in range(len(rows)) if rows[i][2] == s), key=lambda i: digest[i])
        for turn in (0, 1):
            at = turn * total[s]
            for i in own:
                at += size[i]
                if size[i]:
                    queue.append((at / float(target[s]), f, turn, digest[i], i))
    taken, served = collections.Counter(), 0
    for *_, i in sorted(queue):
        served += size[i]
        if served > budget:
            break
        taken[i] += size[i]
    return collections.Counter((rows[i][0], size[i], total[rows[i][2]], round(float(target[rows[i][2]]), 6), taken[i]) for i in range(len(rows)))


def table(spark, rows):
    return spark.createDataFrame([(d, t, s, 5, "x") for d, t, s in rows], "doc_id long, text string, source string, size long, digest string").repartition(3)


def got(df):
    return collections.Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    out = [(i, " ".join(["w"] * (i * 7 % 23)), f"s{i % 5}" if i % 3 else "hot") for i in range(300)]
    out += [(500 + i, "a b c", None) for i in range(4)] + [(600, None, "void"), (601, " \n", "void"), (602, "tiny", "Z")]
    return out + [(7, "same row", "s1")] * 3 + [(None, "no id", "s2")] * 2 + [(700, "é " * 900, "long")]


def test_equal_to_the_simulation(spark, rows):
    found = got(mixing.mix(table(spark, rows)))
    assert found == brute(rows)
    assert found == got(mixing.mix(table(spark, rows[::-1]).repartition(7)))


def test_taken_is_near_the_target_and_never_beyond_twice(spark, rows):
    found = list(got(mixing.mix(table(spark, rows))).elements())
    assert all(t in (0, n, 2 * n) for _, n, _, _, t in found)
    longest = max(n for _, n, *_ in found)
    assert abs(sum(t for *_, t in found) - 1.5 * sum(n for _, n, *_ in found)) <= longest


def test_mixture_holds_each_text_as_often_as_taken(spark, rows):
    df = table(spark, rows)
    words = collections.Counter()
    for r in mixing.mixture(df).collect():
        assert len((r["text"] or "").split()) == r["size"]
        words[r["doc_id"]] += r["size"]
    want = collections.Counter()
    for (d, *_, t), k in got(mixing.mix(df)).items():
        want[d] += t * k
    assert +words == +want


def test_no_python_empty_table_and_single_source(spark, rows):
    df = table(spark, rows)
    plan = mixing.mix(df)._jdf.queryExecution().toString()
    assert not any(node in plan for node in PYTHON_NODES)
    assert mixing.mix(df.where("doc_id = -5")).count() == 0
    one = [(i, "x y z", "only") for i in range(4)]
    assert got(mixing.mix(table(spark, one))) == brute(one)
    nothing = [(1, None, "a"), (2, "", None)]
    assert {r["taken"] for r in mixing.mix(table(spark, nothing)).collect()} == {0}

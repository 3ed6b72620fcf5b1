"""op13: against plain Lloyd rounds in Python integers."""

import collections
import hashlib
import math

import numpy as np
import pytest

from bondliq.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, n long"


def brute(rows):
    """rows (vec_id, vector, label) -> multiset of results, and the digest."""
    rows = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(rows[0][1]) // 4
    whole = [[math.floor(1024 * x) if abs(x) < 2.0**60 else 1024 * int(x) for x in v] for _, v, _ in rows]
    parts = [[v[p * w:(p + 1) * w] for v in whole] for p in range(4)]
    books = [list(parts[p][:256]) for p in range(4)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(4):
        for p in range(4):
            groups = collections.defaultdict(list)
            for x in parts[p]:
                groups[nearest(x, books[p])[1]].append(x)
            for i, own in groups.items():
                books[p][i] = [sum(c) // len(own) for c in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, sums = [], collections.Counter()
    for k, (vec_id, _, label) in enumerate(rows):
        hits = [nearest(parts[p][k], books[p]) for p in range(4)]
        error = sum(d for d, _ in hits)
        out.append((vec_id, "".join(f"{i:02x}" for _, i in hits), error, label))
        sums[label] += error
    return collections.Counter((v, c, e, sums[label]) for v, c, e, label in out), digest


def run(spark, rows, parts=3, schema=SCHEMA):
    df = spark.createDataFrame([(v, None if x is None else [None if c is None else float(c) for c in x], k, "x", 1) for v, x, k in rows], schema)
    got = codes.vector_codes(df.repartition(parts)).collect()
    return collections.Counter((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got), {r["codebooks_sha256"] for r in got}


def vectors(seed, n, dim=12, spread=0.2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, dim))
    x = (centres[rng.integers(9, size=n)] + spread * rng.normal(size=(n, dim))).astype(np.float32)
    return [(int(i * 3 % n), [float(c) for c in x[i]], None if i % 7 == 0 else int(i % 3)) for i in range(n)]


BAD = [(9001, None, 0), (9002, [], 0), (9003, [float("nan")] + [1.0] * 11, 0), (9004, [None] + [1.0] * 11, None), (9005, [float("inf")] * 12, 1)]


@pytest.mark.parametrize("spread", [0.02, 0.6])
def test_equal_to_plain_rounds(spark, spread):
    rows = vectors(1, 700, spread=spread)
    rows += [rows[0], rows[0], rows[5], (None, rows[9][1], 1), (4, rows[11][1], None), (-5, [0.0] * 12, 2)]
    want, digest = brute(rows)
    got, digests = run(spark, rows + BAD)
    assert got == want and digests == {digest}


def test_many_blocks_and_partitions(spark, monkeypatch):
    monkeypatch.setattr(codes, "BLOCK", 50)
    monkeypatch.setattr(codes, "LEAF", 4)
    rows = vectors(2, 400, spread=0.1)
    want, digest = brute(rows)
    got, digests = run(spark, rows, parts=5)
    assert got == want and digests == {digest}


def test_whole_nodes_are_assigned_from_cached_sums():
    rng = np.random.default_rng(4)
    entries = np.floor(rng.normal(size=(256, 8)) * 1024)
    points = entries[rng.integers(40, size=3000)] + rng.integers(-9, 9, size=(3000, 8))
    tree, sizes = codes.grow(points, codes.LEAF), []
    sums = np.zeros_like(entries)

    def add(e, n, s):
        sizes.append(n)
        sums[e] += s

    code = codes.assigned(tree, entries, add)
    want = np.argmin(((points[:, None, :] - entries[None]) ** 2).sum(2), axis=1)
    assert (code == want[tree["order"]]).all() and sum(sizes) == 3000
    assert len(sizes) < 1000, "nodes are not assigned whole"
    assert all((sums[e] == points[want == e].sum(0)).all() for e in range(256))


def test_fewer_rows_than_entries_ties_and_odd_lengths(spark):
    rows = [(i, [float(i % 3)] * 8, 1) for i in range(20)]
    want, digest = brute(rows)
    got, digests = run(spark, rows + [(99, [1.0] * 9, 1)])
    assert got == want and digests == {digest}
    got, _ = run(spark, [(1, [0.5, 0.25, 1.0], 1), (2, [0.5, 0.25, -1.0], 1)])
    assert {(v, e) for v, _, e, _ in got} == {(1, 0), (2, 0)}


def test_large_components_stay_exact(spark):
    schema = SCHEMA.replace("float", "double")
    rows = [(i, [2.0**30 * (i % 11) + i, float(i), -(2.0**33), 1.5] * 2, i % 2) for i in range(300)]
    want, digest = brute(rows)
    got, digests = run(spark, rows, schema=schema)
    assert digests == {digest}
    small = collections.Counter({k: n for k, n in want.items() if k[2] < 2**63 and k[3] < 2**63})
    assert collections.Counter({k: n for k, n in got.items() if k[3] is not None}) == small
    huge = [(i, [3e38, -3e38, 1.0, 0.0] if i % 2 else [0.0] * 4, 0) for i in range(300)]
    assert sum(run(spark, huge)[0].values()) == 300


def test_empty_table(spark):
    assert sum(run(spark, [(1, None, 0)])[0].values()) == 0

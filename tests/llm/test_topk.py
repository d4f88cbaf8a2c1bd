"""Exact top-k against brute force."""

import math
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq

from murmur.llm import topk


def brute(rows, every, k):
    ok = [(i, [math.floor(Fraction(x) * 1024) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = {}
    for q, qv in sorted(ok):
        if q % every == 0 and q not in {x[0] for x in out}:
            most = 2**63 - 1
            s = sorted((-min(most, max(-most, sum(a * b for a, b in zip(qv, v)))), i) for i, v in ok if i != q and len(v) == len(qv))[:k]
            for rank, (score, i) in enumerate(s, 1):
                out[q, rank] = (i, -score)
    return out


def got(df):
    return {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in df.collect()}


def test_whole_table(spark):
    t = pq.read_table("/root/testdata/sf0.01/embeddings.parquet").to_pydict()
    rows = list(zip(t["vec_id"], t["embedding"]))
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert got(topk.top_k(df)) == brute(rows, 100, 10)
    assert got(topk.top_k(df, every=7, k=3)) == brute(rows, 7, 3)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 0.25]), (100, [0.5, 0.25]), (200, None), (300, [nan, 0.0]), (400, [None, 1.0]), (5, [inf, 0.0]),
            (6, [0.5, 0.25]), (7, [0.5, 0.25]), (7, [0.5, 0.25]), (8, [-0.0001, 0.0]), (9, [1.0, 2.0, 3.0]), (500, [1.0, 2.0, 3.0]),
            (600, []), (None, [9.0, 9.0]), (10, [0.0, 0.0]), (-100, [3000.0, -2.5]), (11, [1e4, 1e4])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    assert got(topk.top_k(df, k=4)) == brute(rows, 100, 4)
    assert topk.top_k(df.limit(0)).collect() == []


def test_large_components_and_scores(spark):
    """Products that doubles would round, that need longs, and that no long holds."""
    rng = np.random.default_rng(9)
    rows = [(0, [1e6, 0.0, 0.0]), (1, [1e6, 0.0, 0.0]), (2, [2e6, 0.0, 0.0])]
    rows += [(i, [1e6, float(i % 7) / 1024, 0.0]) for i in range(3, 40)]                     # scores differ by less than a double tells
    rows += [(100, [1e6, 1.0, 3.0]), (200, [-1e6, 1e5, 0.25]), (300, [1e300, -1e300, 1.0]), (301, [1e300, 1.0, 1.0]), (302, [1.7e308, 0.0, 0.0]), (400, [0.0, 2.0, 0.0])]
    rows += [(i, rng.normal(size=3).tolist()) for i in range(500, 560)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got_rows, want = got(topk.top_k(df, k=10)), brute([(i, v) for i, v in rows if i != 302] + [(302, [np.finfo(float).max / 1024, 0.0, 0.0])], 100, 10)
    assert got_rows == want
    small = [(i, v) for i, v in rows if max(map(abs, v)) < 1e7]
    scores = got(topk.top_k(spark.createDataFrame(small, "vec_id long, embedding array<double>"), k=10))
    assert scores == brute(small, 100, 10) and scores[0, 1] == (2, 2 * (1024 * 10**6) ** 2)


def test_groups_of_queries(spark, monkeypatch):
    monkeypatch.setattr(topk, "GROUP", 2)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(300)]
    assert got(topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=25, k=5)) == brute(rows, 25, 5)


def test_search_prunes_and_stays_exact():
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(20, 8)) * 3
    x = np.floor(1024 * (centers[rng.integers(0, 20, 6000)] + rng.normal(size=(6000, 8)) * 0.05))
    ids = rng.permutation(6000)
    s = topk.Search(ids[:300], x[:300], 5)
    calls = []
    inner = topk.Search._compare
    s._compare = lambda q, r, d, i: (calls.append((q.hi - q.lo) * (r.hi - r.lo)), inner(s, q, r, d, i))
    for lo in range(0, 6000, 2000):
        s.add(ids[lo:lo + 2000], x[lo:lo + 2000])
    for row in range(300):
        q = int(np.flatnonzero(ids[:300] == s.ids[row])[0])
        want = sorted((-int(x[q] @ x[j]), int(ids[j])) for j in range(6000) if j != q)[:5]
        assert [(-int(a), int(b)) for a, b in zip(s.best[row], s.rows[row])] == want
    assert sum(calls) < 0.65 * 300 * 6000


def test_tree_covers_its_members():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(500, 4)), np.zeros((200, 4)), rng.normal(size=(300, 4)) * 0.01])
    t = topk.CoverTree(x)
    assert sorted(t.order.tolist()) == list(range(1000))
    stack, leaves = [t.root], 0
    while stack:
        n = stack.pop()
        assert np.sqrt(((t.x[n.lo:n.hi] - n.center) ** 2).sum(axis=1)).max() <= n.radius + 1e-9
        leaves += 0 if n.children else n.hi - n.lo
        stack += n.children
    assert leaves == 1000

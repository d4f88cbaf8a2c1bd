"""Exact top-k by integer inner product: dual-tree search over cover trees.

The queries (a stated subset of the rows) form cover trees of bounded groups, which are
broadcast; every task builds cover trees over blocks of its own rows and walks each pair of
trees from the roots.  For nodes with centers q, r and covering radii a, b no pair of
members scores above  q.r + a|r| + b|q| + ab  (nor above the product of the largest
norms), so a node pair is dropped once that bound is below the worst k-th score of the query
node.  The k-th scores start from the other queries of the group, which are rows
too.  Tasks emit at most k rows a query; a window takes the final k.

Nulls, ties, empty input: rows with a NULL vec_id, a NULL vector, or a NULL or non-finite component
take no part; vectors of different length are never compared; equal scores go to the
smaller vec_id; a row never meets rows of its own vec_id, and a query id that occurs twice
searches with its smallest vector; scores are exact integers, and one that no long holds becomes the
nearest long (then equal to others that do); an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmur.llm.common import dense, ship, staged

BLOCK = 4096        # rows of one tree over the data
GROUP = 8192        # queries that are broadcast together
LEAF = 32
_MOST = np.iinfo(np.int64).max
_NONE = np.iinfo(np.int64).min       # no score yet


def integer(x: np.ndarray) -> np.ndarray:
    """floor(1024 * x), exact in doubles; what overflows them becomes the largest one."""
    with np.errstate(over="ignore"):
        return np.nan_to_num(np.floor(1024.0 * x))


class Node:
    """Members ``lo:hi`` of the tree's order, covered by ``radius`` around ``center``."""

    __slots__ = ("lo", "hi", "center", "norm", "radius", "longest", "children")

    def __init__(self, lo: int, hi: int, center: np.ndarray, radius: float, longest: float):
        self.lo, self.hi, self.center, self.radius, self.longest = lo, hi, center, radius, longest
        with np.errstate(over="ignore"):
            self.norm = float(np.sqrt(center @ center))
        self.children: list[Node] = []


class CoverTree:
    """Cover tree over the rows of ``x``; ``order`` lists the rows node by node.

    A node's children have centers more than half its radius apart and cover half of it.
    Once many centers in a row have caught hardly any member (no clusters at that
    scale), the rest of the members become one leaf.
    """

    def __init__(self, x: np.ndarray):
        self.x = x
        self.order = np.empty(len(x), np.int64)
        with np.errstate(over="ignore"):
            self.norms = np.sqrt((x * x).sum(axis=1))
        self.root = self._grow(np.arange(len(x)), None, 0)
        self.x = x[self.order]

    def _apart(self, rows: np.ndarray, center: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore", invalid="ignore"):
            diff = self.x[rows] - center
            return np.sqrt(np.einsum("ij,ij->i", diff, diff))

    def _grow(self, rows: np.ndarray, far: np.ndarray | None, at: int) -> Node:
        center = self.x[rows[0]]
        far = self._apart(rows, center) if far is None else far
        radius = float(far.max())
        node = Node(at, at + len(rows), center, radius, float(self.norms[rows].max()))
        if len(rows) <= LEAF or radius == 0:
            self.order[at:at + len(rows)] = rows
            return node
        near = far <= radius / 2
        groups, small = [], []
        part, dist = rows[near], far[near]
        rest, idle = rows[~near], 0
        while True:
            (groups if len(part) > LEAF // 4 else small).append((part, dist))
            idle = 0 if len(part) > LEAF // 4 else idle + 1
            if not len(rest):
                break
            if idle > 16:
                small.append((rest, None))
                break
            dist = self._apart(rest, self.x[rest[0]])
            take = dist <= radius / 2
            part, dist, rest = rest[take], dist[take], rest[~take]
        if small:
            left = np.concatenate([p for p, _ in small])
            if not groups:
                self.order[at:at + len(rows)] = left
                return node
            self.order[at:at + len(left)] = left
            over = self._apart(left, self.x[left[0]])
            node.children.append(Node(at, at + len(left), self.x[left[0]], float(over.max()), float(self.norms[left].max())))
            at += len(left)
        for part, dist in groups:
            node.children.append(self._grow(part, dist, at))
            at += len(part)
        return node


class Search:
    """The k best rows of every query of one tree, over any number of data trees."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int):
        self.k, self.tree = k, CoverTree(x)
        self.ids = ids[self.tree.order]
        self.best = np.full((len(ids), k), _NONE)
        self.rows = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.floor = self._seeds()

    def _seeds(self) -> np.ndarray:
        """k-th best score among the other queries: what the k-th best row reaches at least."""
        n, floor = len(self.ids), np.full(len(self.ids), _NONE)
        if n > self.k:
            for lo in range(0, n, 512):
                s = product(self.tree.x[lo:lo + 512], self.tree.x)
                s[np.arange(len(s)), lo + np.arange(len(s))] = _NONE
                floor[lo:lo + 512] = np.partition(s, n - self.k, axis=1)[:, n - self.k]
        return floor

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        data = CoverTree(x)
        ids = ids[data.order]
        stack = [(self.tree.root, data.root)]
        while stack:
            q, r = stack.pop()
            worst = self._worst(q)
            if worst > float(_NONE) and self._bound(q, r) < worst:
                continue
            if not q.children and not r.children:
                self._compare(q, r, data.x, ids)
            elif not q.children or r.children and r.radius > q.radius:
                pairs = [(q, c) for c in r.children]
            else:
                pairs = [(c, r) for c in q.children]
            if q.children or r.children:
                stack += sorted(pairs, key=lambda p: self._bound(*p))      # the best bound is next

    @staticmethod
    def _bound(q: Node, r: Node) -> float:
        with np.errstate(over="ignore", invalid="ignore"):
            b = min(float(q.center @ r.center) + q.radius * r.norm + r.radius * q.norm + q.radius * r.radius, q.longest * r.longest)
        size = q.norm * r.norm + q.longest * r.longest       # of what may have cancelled
        return b + 1 + size * 1e-9 if np.isfinite(b) and np.isfinite(size) else np.inf       # room for rounding

    def _worst(self, q: Node) -> float:
        return float(np.maximum(self.best[q.lo:q.hi, -1], self.floor[q.lo:q.hi]).min())

    def _compare(self, q: Node, r: Node, x: np.ndarray, ids: np.ndarray) -> None:
        for lo in range(q.lo, q.hi, 512):
            hi = min(lo + 512, q.hi)
            s = product(self.tree.x[lo:hi], x[r.lo:r.hi])
            own = self.ids[lo:hi, None] == ids[None, r.lo:r.hi]
            if own.any():
                s[own] = _NONE
            least = np.maximum(self.best[lo:hi, -1], self.floor[lo:hi])
            hit = np.flatnonzero(((s >= least[:, None]) & (s > _NONE)).any(axis=1))
            if len(hit):
                at = lo + hit
                scores = np.concatenate([self.best[at], s[hit]], axis=1)
                rows = np.concatenate([self.rows[at], np.broadcast_to(ids[r.lo:r.hi], (len(hit), r.hi - r.lo))], axis=1)
                order = np.lexsort((rows, ~scores), axis=1)[:, :self.k]
                self.best[at] = np.take_along_axis(scores, order, 1)
                self.rows[at] = np.take_along_axis(rows, order, 1)

    def result(self) -> pa.RecordBatch:
        q, j = np.nonzero((self.best > _NONE) & (self.best >= self.floor[:, None]))
        return pa.RecordBatch.from_arrays([pa.array(self.ids[q]), pa.array(self.rows[q, j]), pa.array(self.best[q, j])],
                                          ["query_id", "vec_id", "score"])


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integers held in doubles, as longs: in doubles where those do not
    round, else in longs, else in Python's integers (beyond a long: the nearest long)."""
    with np.errstate(over="ignore"):
        most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if most < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    if most < 2.0 ** 62 and max(np.abs(a).max(), np.abs(b).max()) < 2.0 ** 62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(a) @ whole(b).T, -_MOST, _MOST).astype(np.int64)


def top_k(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each row whose vec_id is divisible
    by ``every``."""
    spark = vectors.sparkSession
    ship(spark)
    data = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).filter("vec_id is not null")
    asked = (data.filter(F.col("vec_id") % every == 0).filter("embedding is not null")
             .filter(~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
             .groupBy("vec_id").agg(F.min("embedding").alias("embedding")))
    groups = max(1, -(-asked.count() // GROUP))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    found = []
    for g in range(groups):
        # one bounded group of queries at a time (the hash deals about GROUP to each), one live broadcast
        part = asked if groups == 1 else asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(groups)) == g)
        rows = part.orderBy("vec_id").collect()
        sent = spark.sparkContext.broadcast([(r["vec_id"], np.array(r["embedding"], np.float64)) for r in rows])
        one = data.mapInArrow(_searcher(sent, k), "query_id long, vec_id long, score long")
        ranked = one.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        found.append(staged(ranked, "top-k"))
        sent.destroy()
    return reduce(DataFrame.union, found)


def _searcher(sent, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches: dict[int, Search] | None = None
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def flush(size: int, least: int) -> None:
            ids, x = (np.concatenate(p) for p in zip(*held[size]))
            while len(ids) >= max(1, least):
                searches[size].add(ids[:BLOCK], x[:BLOCK])
                ids, x = ids[BLOCK:], x[BLOCK:]
            held[size] = [(ids, x)]

        for b in batches:
            if searches is None:
                by: dict[int, list] = {}
                for i, v in sent.value:
                    by.setdefault(len(v), []).append((i, v))
                searches = {n: Search(np.array([i for i, _ in rows]), integer(np.array([v for _, v in rows])), k) for n, rows in by.items()}
            ids = np.asarray(b.column(0))
            for rows, x in dense(b.column(1))[1]:
                size = x.shape[1]
                if size in searches:
                    held.setdefault(size, []).append((ids[rows], integer(x)))
                    if sum(len(i) for i, _ in held[size]) >= BLOCK:
                        flush(size, BLOCK)
        for size in held:
            flush(size, 1)
        for s in (searches or {}).values():
            yield s.result()

    return run

"""Ranked lexical search: exact inner-product search with sparse ball trees.

Terms are runs of letters, digits and non-ASCII characters, A-Z lower-cased.  A document's vector
holds, per term, ``(10**9 * tf) div (1000 * tf + 8 * m)``, m growing with its length; a query's vector
holds the weights ``floor(1000 * ln((2 * N + 2) / (2 * df + 1)))`` of its terms.  The score is their inner
product in 64-bit integers.  Terms that no query has add nothing to any product, so the vectors
are those of the queries' terms only; lengths, N and df are counted over all documents and all terms.

Each task builds ball trees over blocks of its documents: a node knows the centroid c of its vectors and
their largest distance r from it, so none of them scores above ``<q, c> + |q| * r``.  In sparse vectors of
thousands of terms r is large; a node therefore keeps the radius along each coordinate as well, which
gives ``<q, c> + <q, r'>``, and the smaller bound holds (on the test table the first alone leaves out under 1 % of
the scores, both together more than half).  Trees are
searched best-first for all queries of a block at once; a subtree is left out for the queries whose
k-th best score so far lies above its bound, and a leaf is scored in integers.  Bounds are
computed in doubles and rounded up by far more than their error, so that no document is lost; ties
with the k-th score are visited.

Queries come to the tasks in blocks of bounded size (``ITEMS`` items, ``PAIRS`` item-term pairs; one broadcast
at a time, removed after its job), documents are tokenised once for up to ``VOCABULARY`` pairs.  Each
task returns its k best documents of each query, and a window ranks them.

Nulls, ties, empty input: NULL, empty and term-less texts take part in nothing, on either side; rows that
share an item_id (NULL included) are one item of all their terms; rows that repeat a doc_id are
documents each; equal scores go by doc_id, NULL last; scores of 0 are no result; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmur.llm.common import gather, ship, staged, text_bytes

ITEMS, PAIRS = 200, 12_000     # of one block of queries
VOCABULARY = 400_000           # item-term pairs that one pass over the texts looks for
DOCUMENTS, ENTRIES = 4096, 2_000_000      # of one tree
LEAF = 32
SAFE = 1e-9                    # relative slack of bounds; the error of a sum of n doubles is below n * 1.2e-16
_NO_ID = np.iinfo(np.int64).max

#: Everything in ASCII but digits and letters separates terms.
_TERM_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TERM_BYTES).split()


class BallTree:
    """Nodes over the rows of a sparse matrix (``starts``, ``ids``, ``values`` of 0 or more) of ``size`` columns;
    queries are 0 or more as well."""

    def __init__(self, starts: np.ndarray, ids: np.ndarray, values: np.ndarray, size: int, leaf: int = LEAF):
        self.rows = np.arange(len(starts) - 1)
        self.nodes: list[tuple[int, int, int, int]] = []      # first and last row, children (-1: a leaf)
        self.centroids: list[np.ndarray] = []
        self.radii: list[float] = []
        self.reach: list[np.ndarray] = []          # centroid plus radius of each coordinate (upwards)
        lengths = np.diff(starts)
        norms = np.bincount(np.repeat(self.rows, lengths), values * values, len(lengths)) if len(ids) else np.zeros(len(lengths))
        todo = [(0, len(lengths), -1)]
        while todo:
            lo, hi, parent = todo.pop()
            rows = self.rows[lo:hi]
            at = gather(starts[rows], lengths[rows])
            t, v, own = ids[at], values[at], np.repeat(np.arange(hi - lo), lengths[rows])
            center = np.bincount(t, v, size) / (hi - lo)

            def off(point: np.ndarray) -> np.ndarray:
                return np.maximum(norms[rows] - 2 * np.bincount(own, v * point[t], hi - lo) + point @ point, 0)

            def dense(k: int) -> np.ndarray:
                out = np.zeros(size)
                out[t[own == k]] = v[own == k]
                return out

            far = off(center)
            me = len(self.nodes)
            self.centroids.append(center)
            # what cancels in a distance is at most its terms
            self.radii.append(math.sqrt(float((far + SAFE * (norms[rows] + center @ center)).max())))
            self.nodes.append((lo, hi, -1, -1))
            reach = np.zeros(size)
            np.maximum.at(reach, t, v)
            self.reach.append(reach)
            if parent >= 0:
                a, b, left, right = self.nodes[parent]
                self.nodes[parent] = (a, b, me, right) if left < 0 else (a, b, left, me)
            if hi - lo > leaf:
                one = off(dense(int(far.argmax())))
                side = one - off(dense(int(one.argmax())))
                half = (hi - lo) // 2
                self.rows[lo:hi] = rows[np.argpartition(side, half)]
                todo += [(lo + half, hi, me), (lo, lo + half, me)]

    def bounds(self, node: int, queries: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """No row of the node has a larger inner product with the queries (columns)."""
        c, r, far = self.centroids[node], self.radii[node], self.reach[node]
        ball = (c @ queries + norms * r) + SAFE * norms * (math.sqrt(float(c @ c)) + r)
        return np.minimum(ball, (far @ queries) * (1 + SAFE)) + 1


class Best:
    """The k best (score, doc) of each query; equal scores go to the smaller doc."""

    def __init__(self, queries: int, k: int):
        self.score = np.zeros((queries, k), np.int64)
        self.doc = np.full((queries, k), _NO_ID)

    def least(self, q: np.ndarray) -> np.ndarray:
        """What a document must reach to come in (ties do)."""
        return np.maximum(self.score[q, -1], 1)

    def add(self, q: np.ndarray, docs: np.ndarray, scores: np.ndarray) -> None:
        """``scores``: a row per query of ``q``, a column per document."""
        hit = (scores >= self.least(q)[:, None]).any(axis=1)
        q, scores = q[hit], scores[hit]
        if not len(q):
            return
        score = np.concatenate([self.score[q], scores], axis=1)
        doc = np.concatenate([self.doc[q], np.broadcast_to(docs, scores.shape)], axis=1)
        order = np.lexsort((doc, -score), axis=-1)[:, :self.score.shape[1]]
        self.score[q], self.doc[q] = np.take_along_axis(score, order, 1), np.take_along_axis(doc, order, 1)


def search(docs: np.ndarray, starts: np.ndarray, ids: np.ndarray, values: np.ndarray, weights: np.ndarray,
           queries: np.ndarray, best: Best, leaf: int = LEAF) -> int:
    """Best-first search of one block of documents for all queries; the number of scores computed.

    ``values`` are integers, ``weights`` the integer weight of each term, ``queries`` a 0/1 matrix (terms,
    queries).  The trees hold the weighted vectors, as a query's vector is 0 or 1 then.
    """
    weighted = values * weights[ids]
    tree = BallTree(starts, ids, weighted.astype(float), len(weights), leaf)
    lengths = np.diff(starts)
    asked = queries.astype(float)
    norms = np.sqrt(asked.sum(axis=0))
    everyone = np.arange(queries.shape[1])
    bound = tree.bounds(0, asked, norms)
    heap = [(-float(bound.max(initial=0)), 0, everyone, bound)]
    scored = 0
    while heap:
        _, node, q, bound = heapq.heappop(heap)
        alive = bound >= best.least(q)
        if not alive.any():
            continue
        q, bound = q[alive], bound[alive]
        lo, hi, left, right = tree.nodes[node]
        if left < 0:
            rows = tree.rows[lo:hi]
            rows = rows[lengths[rows] > 0]
            if len(rows):
                at = gather(starts[rows], lengths[rows])
                first = np.cumsum(lengths[rows]) - lengths[rows]
                scores = np.add.reduceat(weighted[at, None] * queries[ids[at]][:, q], first, axis=0)
                best.add(q, docs[rows], scores.T)
                scored += scores.size
            continue
        part = asked if len(q) == len(everyone) else asked[:, q]
        for child in (left, right):
            b = np.minimum(bound, tree.bounds(child, part, norms[q]))
            heapq.heappush(heap, (-float(b.max()), child, q, b))
    return scored


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [sorted(set(terms_of(t))) for t in text_bytes(b.column(1))]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.binary()))], ["item_id", "terms"])


def _vectors(of_term):
    """doc, n and the counts of the wanted terms of every document with a term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = of_term.value
        for b in batches:
            docs, keep, n, ids, tf = b.column(0), [], [], [], []
            for i, text in enumerate(text_bytes(b.column(1))):
                words = terms_of(text)
                if not words:
                    continue
                found = [(number[w], c) for w, c in Counter(words).items() if w in number]
                keep.append(i)
                n.append(len(words))
                ids.append([t for t, _ in found])
                tf.append([c for _, c in found])
            if keep:
                yield pa.RecordBatch.from_arrays([docs.take(pa.array(keep)), pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32())),
                                                  pa.array(tf, pa.list_(pa.int64()))], ["doc_id", "n", "ids", "tf"])
    return run


def _ranked(shared, k: int):
    """Each task's k best documents of every query of the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, local, weights, queries, total, words = shared.value
        best = Best(queries.shape[1], k)

        def flush(held: list[tuple]) -> None:
            docs, lengths, ids, values = (np.concatenate(x) for x in zip(*held))
            search(docs, np.concatenate([[0], np.cumsum(lengths)]), ids, values, weights, queries, best)

        held: list[tuple] = []
        size = entries = 0
        for b in batches:
            docs = np.asarray(b.column(0).fill_null(_NO_ID))
            m = np.array([10 + 90 * n * total // words for n in b.column(1).to_pylist()], np.int64)
            lengths = np.asarray(b.column(2).value_lengths(), np.int64)
            ids, tf = local[np.asarray(b.column(2).flatten())], np.asarray(b.column(3).flatten())
            own = np.repeat(np.arange(len(docs)), lengths)
            in_block = ids >= 0
            own, ids, tf = own[in_block], ids[in_block], tf[in_block]
            values = 1_000_000_000 * tf // (1000 * tf + 8 * m[own])
            lengths = np.bincount(own, minlength=len(docs))
            some = lengths > 0
            held.append((docs[some], lengths[some], ids, values))
            size, entries = size + int(some.sum()), entries + len(ids)
            if size >= DOCUMENTS or entries >= ENTRIES:
                flush(held)
                held, size, entries = [], 0, 0
        if size:
            flush(held)
        q, place = np.nonzero(best.score > 0)
        docs = best.doc[q, place]
        yield pa.RecordBatch.from_arrays([
            items.take(pa.array(q)), pa.array(docs, mask=docs == _NO_ID), pa.array(best.score[q, place])], ["item_id", "doc_id", "score"])
    return run


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def rank(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` best documents of every item."""
    spark = docs.sparkSession
    ship(spark)
    sc = spark.sparkContext
    asked = (items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
             .mapInArrow(_terms, "item_id long, terms array<binary>").select("item_id", F.explode("terms").alias("term")).distinct())
    asked = staged(asked, "search-terms")
    size = asked.agg(F.count("*").alias("pairs"), F.count_distinct(F.struct("item_id")).alias("items")).first()
    passes = max(1, -(-size["pairs"] // VOCABULARY))
    blocks = max(1, -(-size["pairs"] // (passes * PAIRS)), -(-size["items"] // (passes * ITEMS)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    share = F.pmod(F.xxhash64("item_id"), F.lit(passes * blocks))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    parts: list[DataFrame] = []
    for p in range(passes):
        mine = asked.filter(share % passes == p)
        vocabulary = [bytes(r["term"]) for r in mine.select("term").distinct().collect()]     # at most about VOCABULARY
        of_term = sc.broadcast({t: i for i, t in enumerate(vocabulary)})
        vectors = staged(texts.mapInArrow(_vectors(of_term), "doc_id long, n long, ids array<int>, tf array<long>"), "search-vectors")
        of_all = vectors.agg(F.count("*").alias("documents"), F.sum("n").alias("words")).first()
        df = np.zeros(len(vocabulary), np.int64)
        for r in vectors.select(F.explode("ids").alias("t")).groupBy("t").count().collect():
            df[r["t"]] = r["count"]
        for b in range(blocks):
            pairs = mine.filter(F.floor(share / passes) == b).collect()
            if not pairs or not of_all["documents"]:
                continue
            names = sorted({r["item_id"] for r in pairs}, key=lambda i: (i is None, i))
            column = {i: q for q, i in enumerate(names)}
            wanted = sorted({of_term.value[bytes(r["term"])] for r in pairs})
            local = np.full(len(vocabulary), -1, np.int32)
            local[wanted] = np.arange(len(wanted))
            queries = np.zeros((len(wanted), len(names)), np.int64)
            for r in pairs:
                queries[local[of_term.value[bytes(r["term"])]], column[r["item_id"]]] = 1
            weights = np.array([weight(of_all["documents"], int(df[t])) for t in wanted], np.int64)
            shared = sc.broadcast((pa.array(names, pa.int64()), local, weights, queries, of_all["documents"], of_all["words"]))
            found = vectors.mapInArrow(_ranked(shared, k), "item_id long, doc_id long, score long")
            ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            parts.append(staged(ranked.select("item_id", "rank", "doc_id", "score"), "search-ranked"))
            shared.destroy()
        of_term.destroy()
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")

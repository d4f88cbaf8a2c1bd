"""Embedding near-duplicates through an inverted multi-index.

Unit vectors are cut in halves; an independent codebook per half (k-means on a
bounded sample) makes a grid of cells, and every vector is filed under the cell of its two
nearest centroids.  A vector's partners are sought in the cells a multi-sequence traversal
visits: cells in the order of how far the vector lies from their borders
(the two halves' distances added in squares), nearest first, until the border
distance exceeds ``reach``.  ``reach`` is the distance within which ``target_recall`` of
simulated neighbours at exactly the threshold were found in the sample; 1.0 visits every
cell that could hold a partner at all.  Each pair met is then verified by its cosine.

Exact copies are one node with a count.  A cell is cut into blocks by hash, so no task holds
more than a pair of blocks, and a block pair gives counts and spanning links, never pairs.

Nulls, ties, empty input: vectors that are NULL, empty, zero or hold NULL or non-finite
components, and rows with a NULL label, link with nothing but keep their row; vectors of
different length never link; a NULL vec_id keeps its row with component NULL and links
with nothing; an empty table gives an empty result; further columns are ignored.  vec_id
identifies a vector: rows that repeat one with the same vector are copies.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmur.llm.common import Labels, dense, ship, staged
from murmur.llm.graph import connected_components

SAMPLE = 20_000       # vectors that codebooks are fitted on, at most
BLOCK = 1024          # vectors of a cell compared inside one task, per side


@dataclass(frozen=True)
class Index:
    """Codebooks of the two halves of vectors of one length, and how far to visit."""

    first: np.ndarray
    second: np.ndarray
    reach: float

    def cells(self, x: np.ndarray) -> list[list[int]]:
        """Cells to visit per unit vector, nearest first; the first is its own."""
        half = x.shape[1] // 2
        m1, m2 = _borders(x[:, :half], self.first), _borders(x[:, half:], self.second)
        o1, o2 = m1.argsort(axis=1, kind="stable"), m2.argsort(axis=1, kind="stable")
        s1, s2 = np.take_along_axis(m1, o1, 1) ** 2, np.take_along_axis(m2, o2, 1) ** 2
        return [_multi_sequence(a, b, p, q, self.reach ** 2, len(self.second))
                for a, b, p, q in zip(s1.tolist(), s2.tolist(), o1.tolist(), o2.tolist())]


def _multi_sequence(a: list[float], b: list[float], p: list[int], q: list[int], most: float, width: int) -> list[int]:
    """Cells (p[i], q[j]) by increasing a[i] + b[j], up to ``most`` (a and b ascend)."""
    out, heap, seen = [], [(a[0] + b[0], 0, 0)], {(0, 0)}
    while heap:
        d, i, j = heapq.heappop(heap)
        if out and d > most:
            break
        out.append(p[i] * width + q[j])
        for n in ((i + 1, j), (i, j + 1)):
            if n[0] < len(a) and n[1] < len(b) and n not in seen:
                seen.add(n)
                heapq.heappush(heap, (a[n[0]] + b[n[1]], *n))
    return out


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ c.T + (c * c).sum(axis=1), 0)


def _borders(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Distance of each row to the half space where a centroid is nearer than its own one: no
    vector nearer than that is filed under that centroid."""
    d = _squares(x, c)
    own = d.argmin(axis=1)
    apart = np.sqrt(np.maximum(_squares(c, c)[own], 1e-30))
    m = (d - d[np.arange(len(x)), own][:, None]) / (2 * apart)
    m[np.arange(len(x)), own] = 0
    return np.maximum(m, 0)


def _codebook(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    distinct = np.unique(x, axis=0)
    c = distinct[rng.choice(len(distinct), min(k, len(distinct)), replace=False)].copy()
    for _ in range(rounds):
        own = _squares(x, c).argmin(axis=1)
        count = np.bincount(own, minlength=len(c))
        total = np.stack([np.bincount(own, x[:, j], len(c)) for j in range(x.shape[1])], axis=1) if x.shape[1] else np.zeros((len(c), 0))
        c[count > 0] = total[count > 0] / count[count > 0][:, None]
    return c


def fit_index(x: np.ndarray, centroids: int, threshold: float, target_recall: float, seed: int = 6) -> Index:
    """Index over unit vectors ``x`` (a sample); ``reach`` covers ``target_recall`` of simulated
    neighbours whose cosine is the threshold."""
    rng = np.random.default_rng(seed)
    half = x.shape[1] // 2
    first, second = _codebook(x[:, :half], centroids, rng), _codebook(x[:, half:], centroids, rng)
    most = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    if target_recall >= 1:
        return Index(first, second, most)
    u = x[rng.choice(len(x), min(len(x), 4000), replace=False)]
    side = rng.normal(size=u.shape)
    side -= (side * u).sum(axis=1)[:, None] * u
    side /= np.maximum(np.sqrt((side * side).sum(axis=1)), 1e-30)[:, None]
    v = threshold * u + np.sqrt(1 - threshold ** 2) * side
    need = np.zeros(len(u))
    for part, book in ((slice(0, half), first), (slice(half, None), second)):
        at = _squares(v[:, part], book).argmin(axis=1)
        need += _borders(u[:, part], book)[np.arange(len(u)), at] ** 2
    return Index(first, second, min(most, float(np.sqrt(np.quantile(need, target_recall))) * 1.1))


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows with a length above zero, those rows scaled to length one)."""
    big = np.abs(x).max(axis=1) if x.shape[1] else np.zeros(len(x))
    ok = np.flatnonzero(big > 0)
    y = x[ok] / big[ok][:, None]            # no overflow in the squares
    return ok, y / np.sqrt((y * y).sum(axis=1))[:, None]


_VISIT = "node long, copies long, label long, cell long, home boolean, embedding array<{}>"


def _visits(indexes: dict[int, Index], number: type):
    """Every vector, as it came, at its own cell (home) and at the further cells to visit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, x in dense(b.column(3))[1]:
                ok, u = _unit(x)
                if not len(ok):
                    continue
                rows, x, size = rows[ok], x[ok].astype(number), u.shape[1]
                cells = indexes[size].cells(u) if size in indexes else [[0]] * len(rows)
                count = np.fromiter(map(len, cells), np.int64, len(cells))
                at = np.repeat(np.arange(len(rows)), count)
                cell = np.fromiter((c for x in cells for c in x), np.int64, int(count.sum()))
                home = np.zeros(len(at), bool)
                home[np.cumsum(count) - count] = True
                for lo in range(0, len(at), 20_000):      # bounded batches
                    part = at[lo:lo + 20_000]
                    took = [b.column(k).take(pa.array(rows[part])) for k in range(3)]
                    vec = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(part) + 1) * size, size, dtype=np.int32)), pa.array(x[part].ravel()))
                    yield pa.RecordBatch.from_arrays(
                        [took[0], took[1], took[2], pa.array(cell[lo:lo + 20_000]), pa.array(home[lo:lo + 20_000]), vec],
                        [f.split()[0] for f in _VISIT.split(", ")])

    return run


def _compare(threshold: float):
    """One block of homes against one block of visitors of a cell: (node, links, root)."""

    def run(table: pa.Table) -> pa.Table:
        node, copies = np.asarray(table["node"]), np.asarray(table["copies"])
        size = len(table["embedding"][0])
        x = _unit(np.asarray(table["embedding"].combine_chunks().flatten(), np.float64).reshape(-1, size))[1]
        h, p = np.flatnonzero(np.asarray(table["as_home"])), np.flatnonzero(~np.asarray(table["as_home"]))
        near = (x[p] @ x[h].T) >= threshold
        near &= node[p][:, None] != node[h][None, :]
        links = near @ copies[h]
        some = np.flatnonzero(links)
        labels = Labels(len(node))
        i, j = np.nonzero(near)
        labels.join(p[i], h[j])
        a, b = labels.edges()
        return pa.table({"node": pa.array(np.concatenate([node[p[some]], node[a]])),
                         "links": pa.array(np.concatenate([links[some], np.zeros(len(a), np.int64)]).astype(np.int64)),
                         "root": pa.array([None] * len(some) + node[b].tolist(), pa.int64())})

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, target_recall: float = 0.999,
                    per_cell: int = 64) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    ship(spark)
    # floats travel as floats; all arithmetic is in doubles
    single = vectors.schema["embedding"].dataType == T.ArrayType(T.FloatType())
    kind, number = ("float", np.float32) if single else ("double", np.float64)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    usable = rows.filter("vec_id is not null and label is not null and size(embedding) > 0")
    nodes = usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    nodes = staged(nodes.select("node", "copies", "label", "embedding"), "vectors")

    # bounded sample for the codebooks, in hash order; lengths that it lacks get one cell
    indexes: dict[int, Index] = {}
    largest = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("embedding").toArrow()
    for _, x in dense(sample["embedding"])[1]:
        u = _unit(x)[1]
        if len(u) and u.shape[1] > 1:
            centroids = int(min(256, max(1, round((largest / per_cell) ** 0.5))))
            indexes[u.shape[1]] = fit_index(u, centroids, threshold, target_recall)

    visits = staged(nodes.mapInArrow(_visits(indexes, number), _VISIT.format(kind)).withColumn("size", F.size("embedding")), "visits")
    key = ["label", "size", "cell"]
    blocks = visits.groupBy(*key).agg(
        F.ceil(F.sum(F.col("home").cast("int")) / BLOCK).cast("int").alias("homes"),
        F.ceil(F.count("*") / BLOCK).cast("int").alias("visitors")).filter("homes > 0")
    placed = visits.join(blocks, key)
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    cols = [*key, "node", "copies", "embedding"]
    homes = (placed.filter("home").select(*cols, own("homes").alias("hb"), F.explode(every("visitors")).alias("pb"), F.lit(True).alias("as_home")))
    visitors = placed.select(*cols, F.explode(every("homes")).alias("hb"), own("visitors").alias("pb"), F.lit(False).alias("as_home"))
    # dealt by the block pair: the grouping below would otherwise be content with the cell
    dealt = homes.union(visitors).repartition(*key, "hb", "pb")
    met = staged(dealt.groupBy(*key, "hb", "pb")
                 .applyInArrow(_compare(threshold), "node long, links long, root long"), "links")
    counts = met.groupBy("node").agg(F.sum("links").alias("links"))
    parts = connected_components(met.filter("root is not null").select("node", "root"))
    found = (nodes.join(counts, "node", "left").join(parts, "node", "left")
             .select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
                     F.coalesce("component", "node").alias("component"), "node"))
    zero = F.forall("embedding", lambda x: x == 0) | F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    linked = found.filter(~F.coalesce(zero, F.lit(True))).select("label", "embedding", "links", "component")
    out = rows.join(linked, (rows.label == linked.label) & (rows.embedding == linked.embedding) & rows.vec_id.isNotNull(), "left")
    component = F.coalesce(linked.component, rows.vec_id)
    return out.select(rows.vec_id, F.coalesce(linked.links, F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(rows.vec_id == component, F.lit(True)).alias("kept"))

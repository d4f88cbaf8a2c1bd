"""Merkle manifest of a dataset: leaves, subroots, one root, and folds that resume hash states.

Each row is a leaf, the sha256 of its fields.  Per group the leaves stand in order, and every
``arity`` consecutive nodes become their parent until one is left, the group's subroot; the
subroots, in the order of their groups, become the root in the same way.

A parent feeds its children's digests to one SHA state and keeps a copy of the state in front
of each child.  Folding a (new) leaf resumes the copy of its slot with the leaf and the siblings
to its right only, level by level: nothing to its left is hashed again.

On Spark: rows get their position by a range partitioning, ``arity ** height`` consecutive
nodes make one chunk, a chunk's levels are built in one task, and the chunks' roots are the nodes
of the next round (4096 times fewer each).  Way down, every chunk gets its path to the root, the
siblings of each level; the state in front of its slot is made once from the left ones and copied for
every leaf of the chunk.  No task holds more than one chunk, nothing goes through the driver.

Nulls, ties, empty input: a NULL field is the leaf text ``-``; a NULL group is a group of its own, in
front of the others; a NULL order column comes first; rows of one order value stand in the order of
their leaves, equal rows are leaves each; an empty table gives an empty result; further columns are
ignored; long texts are hashed by the JVM and never sent to Python.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.llm.common import ship, staged

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left:string,right:string>>"
_PATH_TYPE = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def leaf(fields: Iterable[Column]) -> Column:
    """Hex sha256 of the fields: ``-`` for NULL, else byte count, ``:`` and the value."""
    def one(c: Column) -> Column:
        s = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
    return F.sha2(F.concat(*(one(c) for c in fields)).cast("binary"), 256)


class Tree:
    """The levels of one chunk, with the state in front of every child."""

    def __init__(self, digests: list[bytes], levels: int, arity: int):
        self.arity = arity
        self.states: list[list] = []
        self.left: list[list[bytes]] = []
        self.right: list[list[bytes]] = []
        nodes = digests
        for _ in range(levels):
            states, left, right, parents = [], [], [], []
            for lo in range(0, len(nodes), arity):
                run = nodes[lo:lo + arity]
                h = sha256()
                for k, d in enumerate(run):
                    states.append(h.copy())
                    left.append(b"".join(run[:k]))
                    right.append(b"".join(run[k + 1:]))
                    h.update(d)
                parents.append(h.hexdigest().encode())
            self.states.append(states)
            self.left.append(left)
            self.right.append(right)
            nodes = parents
        self.root = nodes[0]

    def path(self, i: int) -> list[tuple[bytes, bytes]]:
        """(left, right) siblings of node i, level by level."""
        out = []
        for left, right in zip(self.left, self.right):
            out.append((left[i], right[i]))
            i //= self.arity
        return out

    def fold(self, i: int, digest: bytes) -> bytes:
        """The chunk's root with ``digest`` in the place of node i."""
        for states, right in zip(self.states, self.right):
            h = states[i].copy()
            h.update(digest + right[i])
            digest = h.hexdigest().encode()
            i //= self.arity
        return digest


def _levels(total: int, height: int, arity: int) -> int:
    """Levels of a chunk of a group of ``total`` nodes: ``height``, or as many as leave one node."""
    levels = 0
    while levels < height and arity ** levels < total:
        levels += 1
    return levels


def _ordered(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows``, with pos (from 0 in its group, by ``order``) and total (rows of the group).

    Rows are dealt by ranges of (group, order, place in the input), so a group with a third of all
    rows, or one row repeated as often, lies in many tasks.
    """
    salted = rows.withColumn("salt", F.monotonically_increasing_id())
    by = [group, *order, "salt"]
    dealt = staged(salted.repartitionByRange(*by).sortWithinPartitions(*by)
                   .select(*rows.columns, F.spark_partition_id().alias("part"),
                           F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("at")), name)
    counts = dealt.groupBy("part", group).agg(F.count("*").alias("n"), F.min("at").alias("first"))
    whole = Window.partitionBy(group)
    before = F.coalesce(F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("part", group, (before - F.col("first")).alias("shift"), F.sum("n").over(whole).alias("total"))
    return (dealt.join(counts, ["part", group])
            .select(*rows.columns, (F.col("at") + F.col("shift")).alias("pos"), "total"))


def _sorted(table: pa.Table) -> pa.Table:
    return table.sort_by("pos")


def _bytes(column: pa.ChunkedArray) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def _text(digests: Iterable[bytes]) -> pa.Array:
    return pa.array([d.decode() for d in digests], pa.string())


def _with_chunk(nodes: DataFrame, size: int) -> DataFrame:
    return nodes.withColumn("chunk", F.expr(f"pos div {size}"))


def _rounds(nodes: DataFrame, height: int, arity: int, name: str) -> list[DataFrame]:
    """``nodes`` (grp, pos, total, digest), the roots of their chunks, the roots of those, ...,
    down to one row per group."""
    size = arity ** height

    def roots(table: pa.Table) -> pa.Table:
        table = _sorted(table)
        total = table["total"][0].as_py()
        tree = Tree(_bytes(table["digest"]), _levels(total, height, arity), arity)
        return pa.table({"grp": table["grp"].slice(0, 1), "pos": table["chunk"].slice(0, 1),
                         "total": pa.array([-(-total // size)], pa.int64()), "digest": _text([tree.root])})

    out = [nodes]
    while True:
        up = (_with_chunk(out[-1].select("grp", "pos", "total", "digest"), size).groupBy("grp", "chunk")
              .applyInArrow(roots, "grp string, pos long, total long, digest string"))
        out.append(staged(up, name))
        if out[-1].filter("total > 1").isEmpty():
            return out


def _down(rounds: list[DataFrame], top: DataFrame, fn: Callable, schema: str, height: int, arity: int) -> DataFrame:
    """Paths handed down from ``top`` (grp, pos, path, ...) to the chunks of the first round, whose nodes
    ``fn(nodes, upper)`` turns into rows of ``schema``."""
    size = arity ** height

    def paths(nodes: pa.Table, upper: pa.Table) -> pa.Table:
        nodes = _sorted(nodes)
        tree = Tree(_bytes(nodes["digest"]), _levels(nodes["total"][0].as_py(), height, arity), arity)
        above = upper["path"][0].as_py()
        found = [[{"left": a.decode(), "right": b.decode()} for a, b in tree.path(i)] + above for i in range(len(nodes))]
        return pa.table({"grp": nodes["grp"], "pos": nodes["pos"], "path": pa.array(found, _PATH_TYPE),
                         "subroot": pa.array(upper["subroot"].to_pylist() * len(nodes), pa.string()),
                         "root": pa.array(upper["root"].to_pylist() * len(nodes), pa.string())})

    def pair(nodes: DataFrame, upper: DataFrame):
        upper = upper.withColumnRenamed("pos", "chunk")
        return _with_chunk(nodes, size).groupBy("grp", "chunk").cogroup(upper.groupBy("grp", "chunk"))

    for nodes in rounds[-2:0:-1]:
        top = pair(nodes, top).applyInArrow(paths, f"grp string, pos long, path {_PATH}, subroot string, root string")
    return pair(rounds[0], top).applyInArrow(fn, schema)


def manifest(docs: DataFrame, now: dict[str, Column] | None = None, fields: tuple[str, ...] = FIELDS, group: str = "lang",
             order: str = "doc_id", arity: int = 8, height: int = 4, siblings: bool = False) -> DataFrame:
    """One row per row of ``docs``: the order column, leaf, subroot, root, proof_sha256 (of the siblings of the
    way to the root, level by level, left to right), folded_root and verified; with ``siblings`` also
    proof, the siblings' digests as one string per level.

    ``now`` replaces fields by what they hold today; folded_root is the root that the row's leaf of
    today gives with the siblings of the manifest, and verified tells whether it is the root.
    """
    ship(docs.sparkSession)
    now = now or {}
    # the group as a string that sorts as it should: NULL, then bytewise
    grp = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    rows = docs.select(F.col(order).alias("key"), grp.alias("grp"), leaf(F.col(c) for c in fields).alias("digest"),
                       leaf(now.get(c, F.col(c)) for c in fields).alias("now"))
    leaves = staged(_ordered(rows, "grp", ["key", "digest"], "manifest-rows"), "manifest-leaves")
    forest = _rounds(leaves, height, arity, "manifest-nodes")
    subroots = forest[-1].select("grp", "digest")
    tops = staged(_ordered(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("of"), "digest"), "grp", ["of"], "manifest-subroots"),
                  "manifest-groups")
    upper = _rounds(tops, height, arity, "manifest-top")

    def group_paths(nodes: pa.Table, above: pa.Table) -> pa.Table:
        nodes = _sorted(nodes)
        tree = Tree(_bytes(nodes["digest"]), _levels(nodes["total"][0].as_py(), height, arity), arity)
        rest = above["path"][0].as_py()
        found = [[{"left": a.decode(), "right": b.decode()} for a, b in tree.path(i)] + rest for i in range(len(nodes))]
        return pa.table({"grp": nodes["of"], "pos": pa.array([0] * len(nodes), pa.int64()), "path": pa.array(found, _PATH_TYPE),
                         "subroot": nodes["digest"], "root": pa.array(above["root"].to_pylist() * len(nodes), pa.string())})

    start = upper[-1].select("grp", "pos", F.array().cast(_PATH).alias("path"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    of_group = _down(upper, start, group_paths, f"grp string, pos long, path {_PATH}, subroot string, root string", height, arity)

    key = rows.schema["key"]

    def folds(nodes: pa.Table, above: pa.Table) -> pa.Table:
        nodes = _sorted(nodes)
        n = len(nodes)
        digests, today = _bytes(nodes["digest"]), _bytes(nodes["now"])
        tree = Tree(digests, _levels(nodes["total"][0].as_py(), height, arity), arity)
        way = [(x["left"].encode(), x["right"].encode()) for x in above["path"][0].as_py()]
        states = [(sha256(a), b) for a, b in way]
        root = above["root"][0].as_py()
        folded, proofs, shown = [], [], []
        parents: dict[int, list[bytes]] = {}       # siblings from the second level on, shared by a run
        for i, d in enumerate(today):
            d = tree.fold(i, d)
            for state, right in states:
                h = state.copy()
                h.update(d + right)
                d = h.hexdigest().encode()
            folded.append(d)
            if i // arity not in parents:
                parents = {i // arity: [a + b for a, b in tree.path(i)[1:] + way]} if tree.left else {i // arity: [a + b for a, b in way]}
            own = [tree.left[0][i] + tree.right[0][i]] if tree.left else []
            levels = own + parents[i // arity]
            proofs.append(sha256(b"".join(levels)).hexdigest())
            if siblings:
                shown.append([x.decode() for x in levels])
        out = {order: nodes["key"], "leaf": nodes["digest"], "subroot": pa.array(above["subroot"].to_pylist() * n, pa.string()),
               "root": pa.array([root] * n, pa.string()), "proof_sha256": pa.array(proofs, pa.string()), "folded_root": _text(folded),
               "verified": pa.array([f == root.encode() for f in folded], pa.bool_())}
        if siblings:
            out["proof"] = pa.array(shown, pa.list_(pa.string()))
        return pa.table(out)

    schema = (f"`{order}` {key.dataType.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, "
              f"folded_root string, verified boolean" + (", proof array<string>" if siblings else ""))
    return _down(forest, of_group, folds, schema, height, arity)

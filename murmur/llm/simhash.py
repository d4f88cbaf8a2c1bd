"""SimHash near-duplicates through a Gray-ordered hierarchical index.

Texts become 64-bit fingerprints.  Two fingerprints link at ``max_bits`` or fewer
differing bits.  ``max_bits + 1`` rotations bring one chunk of the bits after the
other to the front; a pair within the distance agrees on at least one chunk, so
it meets in at least one rotation.  Each rotation is sorted by Gray rank (one
distributed range sort), where neighbours share long bit patterns.  Runs of
equal chunk become blocks; in a block, nodes of 64 and of 8 neighbours hold the bits
that all their members share, and a node pair is dropped, members and all, once the
differences added up on the way down exceed the distance.  Runs longer
than a block are compared block by block, after the same test on the blocks'
shared bits.  Only spanning links leave a task, never all pairs of a group.

Nulls, ties, empty input: a NULL or word-less text has fingerprint zero and links like
any other; equal fingerprints are one node; a NULL id keeps its row and takes the
component of its fingerprint; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import Labels, gather, give_back, ship, staged, text_bytes, unused
from murmur.llm.graph import connected_components

BLOCK = 4096          # fingerprints of one chunk value that are compared inside one task
NODES = (64, 8, 1)    # members of the nodes from the top of a block down
_PAIRS = 20_000       # node pairs opened at a time (bounds memory, not results)


def fingerprint(text: bytes | None, shingle: int) -> int:
    """SimHash of the lower-cased (A-Z) words' shingles, repeats included."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    digest = partial(xxhash.xxh64_intdigest, seed=42)
    line = b" ".join(words)
    if len(words) <= shingle:
        return digest(line)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    n = len(words) - shingle + 1
    hashes = np.fromiter((digest(line[s:e]) for s, e in zip(starts, ends[shingle - 1:].tolist())), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):      # very long texts: bounded memory
        part = hashes[k:k + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed long."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in text_bytes(b.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])
        give_back()

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, fp long"))


def _rotated(fp: Column, by: int) -> Column:
    return fp if by == 0 else F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by))


def _gray_rank(x: Column) -> Column:
    for s in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, s))
    return x


def _unrotate(x: np.ndarray, by: int) -> np.ndarray:
    return x if by == 0 else (x >> np.uint64(by)) | (x << np.uint64(64 - by))


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int16)


class _Level:
    """Nodes of up to ``size`` neighbours of one run: members' shared bits and values."""

    def __init__(self, fp: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int):
        per = -(-(ends - starts) // size)
        inside = gather(np.zeros(len(per), np.int64), per)
        self.run = np.repeat(np.arange(len(per)), per)
        self.lo = np.repeat(starts, per) + inside * size
        self.hi = np.minimum(self.lo + size, np.repeat(ends, per))
        self.first = np.cumsum(per) - per          # node index of a run's first node
        both = np.bitwise_and.reduceat(fp, self.lo)
        self.shared = ~(both ^ np.bitwise_or.reduceat(fp, self.lo))
        self.value = both


def link_runs(fp: np.ndarray, starts: np.ndarray, ends: np.ndarray, max_bits: int, labels: Labels,
              left: np.ndarray | None = None) -> None:
    """Join in ``labels`` what is within ``max_bits`` inside each run [start, end).

    The runs are adjacent and cover ``fp``.  ``left``: then only pairs of a run's first
    ``left`` members with its others (two blocks side by side).
    """
    levels = [_Level(fp, starts, ends, s) for s in NODES]
    top = levels[0]
    last = np.append(top.first[1:], len(top.lo))[top.run]      # end of the run's nodes
    at = np.arange(len(top.lo))
    lag = 0
    live = at
    while len(live):
        for k in range(0, len(live), _PAIRS):
            i = live[k:k + _PAIRS]
            _descend(levels, 0, i, i + lag, None, None, fp, max_bits, labels, starts, left)
        lag += 1
        live = live[live + lag < last[live]]


def _descend(levels, depth, i, j, diff, seen, fp, max_bits, labels, starts, left) -> None:
    level = levels[depth]
    shared = level.shared[i] & level.shared[j]
    new = shared if seen is None else shared & ~seen
    diff = _bits((level.value[i] ^ level.value[j]) & new) + (0 if diff is None else diff)
    near = diff <= max_bits
    i, j, diff, shared = i[near], j[near], diff[near], shared[near]
    if depth == len(levels) - 1:
        a, b = level.lo[i], level.lo[j]
        keep = a < b
        if left is not None:
            edge = (starts + left)[level.run[i]]
            keep &= (a < edge) & (b >= edge)
        labels.join(a[keep], b[keep])
        return
    below, size = levels[depth + 1], NODES[depth + 1]
    first = below.first[level.run] + (level.lo - starts[level.run]) // size
    count = -(-(level.hi - level.lo) // size)
    step = max(1, _PAIRS * 4 // ((NODES[depth] // size) ** 2) * 16)
    for k in range(0, len(i), step):
        p, q = i[k:k + step], j[k:k + step]
        wide = count[p] * count[q]
        pair = np.repeat(np.arange(len(p)), wide)
        inner = gather(np.zeros(len(p), np.int64), wide)
        ci = first[p][pair] + inner // count[q][pair]
        cj = first[q][pair] + inner % count[q][pair]
        once = (ci <= cj) | (p != q)[pair]
        pair, ci, cj = pair[once], ci[once], cj[once]
        _descend(levels, depth + 1, ci, cj, diff[k:k + step][pair], shared[k:k + step][pair],
                 fp, max_bits, labels, starts, left)


_LINKS = ("u long, v long, turn int, chunk long, block long, shared long, value long, members binary")


def _link_sorted(max_bits: int, width: int):
    """mapInArrow over one range-sorted partition: links inside blocks, and the blocks of
    runs that go on outside one block."""

    def out(u, v) -> pa.RecordBatch:
        n = len(u)
        none = [pa.nulls(n, t) for t in (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())]
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), *none], NAMES)

    def done(turn, chunk, fp, whole):
        """Links of finished runs; whole: no run goes on beyond these rows."""
        cut = np.flatnonzero((turn[1:] != turn[:-1]) | (chunk[1:] != chunk[:-1])) + 1
        starts, ends = np.append(0, cut), np.append(cut, len(fp))
        per = -(-(ends - starts) // BLOCK)
        run = np.repeat(np.arange(len(per)), per)
        lo = np.repeat(starts, per) + gather(np.zeros(len(per), np.int64), per) * BLOCK
        hi = np.minimum(lo + BLOCK, ends[run])
        labels = Labels(len(fp))
        link_runs(fp, lo, hi, max_bits, labels)
        a, b = labels.edges()
        own = np.empty(len(fp), np.uint64)
        for t in np.unique(turn):
            own[turn == t] = _unrotate(fp[turn == t], int(t) * width)
        own = own.view(np.int64)
        if len(a):
            yield out(own[a], own[b])
        open_run = per > 1
        open_run[0] |= not whole[0]
        open_run[-1] |= not whole[1]
        k = np.flatnonzero(open_run[run])
        if len(k):
            both = np.bitwise_and.reduceat(fp, lo)
            shared = ~(both ^ np.bitwise_or.reduceat(fp, lo))
            yield pa.RecordBatch.from_arrays([
                pa.nulls(len(k), pa.int64()), pa.nulls(len(k), pa.int64()), pa.array(turn[lo[k]]),
                pa.array(chunk[lo[k]]), pa.array(own[lo[k]]), pa.array(shared[k].view(np.int64)),
                pa.array(both[k].view(np.int64)), pa.array([fp[x:y].tobytes() for x, y in zip(lo[k], hi[k])], pa.binary())],
                NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows, begun = 0, False
        for b in batches:
            if not b.num_rows:
                continue
            held.append((np.asarray(b.column(0)).astype(np.int32), np.asarray(b.column(1)).view(np.uint64)))
            rows += b.num_rows
            if rows < 1 << 18:
                continue
            turn, fp = (np.concatenate(x) for x in zip(*held))
            chunk = (fp >> np.uint64(64 - width)).astype(np.int64)
            # the last run may go on: keep its rows unless they fill blocks by themselves
            tail = int(np.flatnonzero((turn != turn[-1]) | (chunk != chunk[-1]))[-1]) + 1 if (turn[0], chunk[0]) != (turn[-1], chunk[-1]) else 0
            keep = tail if tail else len(fp) // BLOCK * BLOCK
            yield from done(turn[:keep], chunk[:keep], fp[:keep], (begun, bool(tail)))
            begun = bool(tail)
            held, rows = [(turn[keep:], fp[keep:])], len(fp) - keep
        if rows:
            turn, fp = (np.concatenate(x) for x in zip(*held))
            yield from done(turn, (fp >> np.uint64(64 - width)).astype(np.int64), fp, (False, False))

    NAMES = [c.split()[0] for c in _LINKS.split(", ")]
    return run


def links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """Spanning links (u, v) between distinct fingerprints (column ``fp``) that connect
    everything within ``max_bits``."""
    ship(fps.sparkSession)
    width = 64 // (max_bits + 1)
    turns = F.array(*[F.struct(F.lit(t).alias("turn"), _rotated(F.col("fp"), t * width).alias("x")) for t in range(max_bits + 1)])
    spread = fps.select("fp").distinct().select(F.explode(turns).alias("r")).select("r.turn", "r.x")
    # flip the top bit: the signed order of the key is then the unsigned order of the rank
    rank = _gray_rank(F.col("x")).bitwiseXOR(F.lit(-(1 << 63)))
    ordered = (spread.withColumn("rank", rank).repartitionByRange("turn", "rank")
               .sortWithinPartitions("turn", "rank").select("turn", "x"))
    found = staged(ordered.mapInArrow(_link_sorted(max_bits, width), _LINKS), "simhash-links")
    blocks = found.filter("block is not null").select("turn", "chunk", "block", "shared", "value", "members")
    a = blocks.select("turn", "chunk", *[F.col(c).alias(f"{c}_a") for c in ("block", "shared", "value", "members")])
    b = blocks.select("turn", "chunk", *[F.col(c).alias(f"{c}_b") for c in ("block", "shared", "value", "members")])
    apart = F.bit_count(F.col("value_a").bitwiseXOR(F.col("value_b")).bitwiseAND(F.col("shared_a")).bitwiseAND(F.col("shared_b")))
    pairs = (a.join(b, ["turn", "chunk"]).filter(F.col("block_a") < F.col("block_b")).filter(apart <= max_bits)
             .select("turn", "members_a", "members_b"))

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for turn, x, y in zip(*(c.to_pylist() for c in batch.columns)):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                fp = np.concatenate([x, y])
                labels = Labels(len(fp))
                link_runs(fp, np.array([0]), np.array([len(fp)]), max_bits, labels, np.array([len(x)]))
                i, j = labels.edges()
                own = _unrotate(fp, turn * width).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(own[i]), pa.array(own[j])], ["u", "v"])

    return (found.filter("u is not null").select("u", "v")
            .union(pairs.mapInArrow(across, "u long, v long")))


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (the smallest
    doc_id reachable over links of at most ``max_bits`` differing bits, itself included)."""
    return _grouped(staged(fingerprints(docs, shingle), "simhash-fp"), max_bits)


def _grouped(fps: DataFrame, max_bits: int) -> DataFrame:
    """doc_id, fingerprint, component_id of staged fingerprints."""
    reps = fps.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    roots = connected_components(links(fps, max_bits)).withColumnsRenamed({"node": "fp", "component": "root"})
    placed = staged(reps.join(roots, "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    least = placed.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_fp = placed.join(least, "root").select("fp", "component_id")
    return fps.join(of_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def simhash_dedup(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its group, all columns kept."""
    key, = unused(docs, "key")
    keep = (simhash_groups(docs, shingle, max_bits).filter("doc_id = component_id")
            .select(F.col("doc_id").alias(key)).distinct())
    return (docs.withColumn(key, F.col("doc_id").cast("long")).join(keep, key, "left_semi")
            .select(*(f"`{c}`" for c in docs.columns)))


def one_of_each_group(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with exactly one row of each group: of the smallest doc_id, NULL last, and of
    rows that repeat it the first by a key that every row gets when it is written here."""
    row, = unused(docs, "row")
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "simhash-rows")
    # groups by row key: the smallest key stands for a group, also where all ids are NULL
    fps = staged(fingerprints(rows.select(F.col(row).alias("doc_id"), "text"), shingle), "simhash-fp")
    groups = _grouped(fps, max_bits).select(F.col("doc_id").alias("row"), "component_id")
    ids = rows.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("id"))
    keep = (groups.join(ids, "row").groupBy("component_id")
            .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first"))
            .select(F.col("first.row").alias(row)))
    return rows.join(keep, row, "left_semi").select(*(f"`{c}`" for c in docs.columns))

"""Best-fit packing of tokenised documents into sequences of at most ``size`` tokens.

A document is its token ids followed by id 0.  Only longer documents are cut, into
pieces of ``size`` tokens (the last may be shorter).  Pieces are placed by the
sum-of-squares rule: with N(g) open sequences of residual gap g, a piece goes where the
sum of N(g)^2 over all gaps becomes smallest, be it an open sequence or a new one.

Only the small piece rows (no text, no ids) are shuffled.  They are written, counted and dealt in
turn over ``ceil(pieces / per_packer)`` packers, so each packer holds a bounded number of pieces at any
input size and whatever ids repeat, and packs them longest first.
What the last sequences of a packer leave unfilled is at most a few in
``per_packer``.

Nulls and empty input: a NULL text is empty and yields one piece, the single id 0; a NULL
id keeps its rows; an empty table gives an empty result; repeated rows are
packed as often as they occur; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import give_back, ship, staged
from murmur.llm.wordids import slices, tokenizers_word_ids

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, size: int = 2048) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (of little-endian 32-bit ids)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizers_word_ids(tokenizer)
        for b in batches:
            for lo, hi in slices(b.column(1)):
                ids, counts = words.of_texts(b.column(1).slice(lo, hi - lo))
                ids = ids.astype("<u4", copy=False)
                per = -(-counts // size)
                doc = np.repeat(np.arange(hi - lo), per)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
                start = piece * size
                length = np.minimum(size, counts[doc] - start)
                at = (np.cumsum(counts) - counts)[doc] + start
                crc = [zlib.crc32(ids[s:e]) for s, e in zip(at.tolist(), (at + length).tolist())]
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(lo, hi - lo).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start),
                    pa.array(length), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])
        give_back()

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, _PIECE))


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(sequence, offset) of every length in the given order, and the number of sequences."""
    count = np.zeros(size + 1, np.int64)                # open sequences by residual gap
    stacks: list[list[int]] = [[] for _ in range(size + 1)]
    seq, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened = 0
    far = np.iinfo(np.int64).max
    for k, s in enumerate(lengths.tolist()):
        best, gap = (2 * int(count[size - s]) + 2 if s < size else 0), size
        if s < size:
            # change of the sum when gap g becomes g - s; a filled sequence leaves the sum
            have = count[s:size]
            change = 2 * (count[:size - s] - have) + 2
            change[0] = 1 - 2 * have[0]
            change[have == 0] = far
            g = int(change.argmin())
            if change[g] <= best - 1:
                gap = g + s
        if gap == size:
            at, opened = opened, opened + 1
        else:
            at = stacks[gap].pop()
            count[gap] -= 1
        seq[k], offset[k] = at, size - gap
        if gap > s:
            count[gap - s] += 1
            stacks[gap - s].append(at)
    return seq, offset, opened


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, per_packer: int = 200_000) -> DataFrame:
    """Pieces of all documents with their sequence_id and gapless offset inside it."""
    pieced = staged(pieces(docs, tokenizer, size), "pieces")
    packers = max(1, -(-pieced.count() // per_packer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held)
        seq, offset, _ = sum_of_squares(np.asarray(t["length"]), size)
        base = TaskContext.get().partitionId() << 40
        t = t.append_column("sequence_id", pa.array(base + seq)).append_column("offset", pa.array(offset))
        yield from t.to_batches()

    ordered = pieced.repartition(packers).sortWithinPartitions(F.desc("length"), "doc_id", "piece", "ids_crc32")
    return ordered.mapInArrow(run, _PIECE + ", sequence_id long, offset long")

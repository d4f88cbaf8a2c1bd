"""Word n-gram counts per video (bigram / trigram panels).

One item goes through the shuffle per word position instead of one per n-gram: the words of the largest
n-gram that starts there, cut where the smaller ones end.  Positions with the same words are
counted in the task first, over bounded portions of text, so an n-gram that every comment of a
video holds is sent a few times per task.  They are dealt by ``parts`` hashes of video and smallest n-gram; those of
one portion and part are one row: their words once each, in alphabetical order, and numbers that say which word stands
where, both compressed (about 12 bytes a position, under a third of the words as text).  A pass over the rows sorted by part
counts every n-gram by the numbers of its words and holds one batch and the distinct n-grams of one part.
The per-video top-k is a ``row_number <= k`` window that is planned with a partial WindowGroupLimit, so a
video with a third of all comments still sends at most k rows per (video, n) per task to the last stage.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from murmur.functions.text import portions
from murmur.session import ship_package

PORTION_BYTES = 4 << 20      # texts whose n-grams are counted together in a task
BUCKETS = 1 << 16
PARTS = 256                  # at least so many parts, more of them where there are more shuffle partitions
ROWS_BYTES = 1 << 20         # of packed rows that go on together
HELD = 1 << 20               # positions of a part after which the equal ones are added up
_MULT = np.uint64(0x9E3779B97F4A7C15)


def _hashed(values: pa.Array) -> np.ndarray:
    """A hash of each value, that of NULL last (at index -1)."""
    return np.array([*(zlib.crc32(str(v).encode("utf-8", "surrogatepass")) for v in values.to_pylist()), 0], np.uint64)


def _joined(words: Sequence[pa.Array]) -> pa.Array:
    return pc.binary_join_element_wise(*words, " ") if len(words) > 1 else words[0]


class Found(NamedTuple):
    """Counted word positions: numbers of their video and of the words that start there (rows of ``codes``, -1 for NULL
    or where the n-gram would not fit), in the order of their hashes."""

    bucket: np.ndarray
    by: pa.Array
    names: pa.Array
    codes: np.ndarray
    times: np.ndarray


def _found(batches: Iterator[pa.RecordBatch], sizes: Sequence[int]) -> Iterator[Found]:
    """The word positions of each portion of text."""
    for b in batches:
        for lo, hi in portions(b.column(1), PORTION_BYTES):
            yield from _found_in(b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), sizes)


def _found_in(videos: pa.Array, texts: pa.Array, sizes: Sequence[int]) -> list[Found]:
    listed = pc.split_pattern(texts, " ")
    ends = np.asarray(listed.offsets, np.int32)
    ends = ends[1:] - ends[0]
    coded = listed.flatten().dictionary_encode()
    del listed
    names, word = coded.dictionary, np.asarray(coded.indices, np.int32)
    if not len(word):
        return []
    # words left from a position on: up to the end of its text or an empty word
    place = np.arange(len(word), dtype=np.int32)
    stops = np.full(len(word) + 1, len(word), np.int32)
    stops[ends] = ends
    empty = np.asarray(pc.equal(names, "").take(coded.indices))
    stops[:-1][empty] = place[empty]
    left = np.where(empty, 0, np.minimum.accumulate(stops[::-1])[::-1][1:] - place)
    start = np.flatnonzero(left >= sizes[0])
    left = left[start]
    del place, stops, empty, coded
    by = videos.dictionary_encode()
    own = np.repeat(np.asarray(pc.fill_null(by.indices, -1), np.int32), np.diff(np.append(0, ends)))
    codes = np.empty((1 + sizes[-1], len(start)), np.int32)
    codes[0] = own[start]
    for k in range(sizes[-1]):
        size = next(s for s in sizes if s > k)
        codes[k + 1] = np.where(left >= size, word[np.minimum(start + k, len(word) - 1)], -1)
    del own, left, start, word
    codes, times = _summed(codes, np.ones(codes.shape[1], np.int64))
    hashed = _hashed(by.dictionary)[codes[0]]
    of_word = _hashed(names)
    for c in codes[1:sizes[0] + 1]:
        hashed = (hashed ^ (hashed >> np.uint64(29))) * _MULT + of_word[c]
    bucket = (((hashed ^ (hashed >> np.uint64(32))) * _MULT) >> np.uint64(48)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    return [Found(bucket[order], by.dictionary, names, codes[:, order], times[order])]


def _summed(codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct columns of ``codes`` and the sums of their ``times``."""
    keys = [f"k{i}" for i in range(len(codes))]
    t = pa.table([*codes, times], [*keys, "times"]).group_by(keys, use_threads=False).aggregate([("times", "sum")]).combine_chunks()
    return np.stack([np.asarray(t[k], np.int32) for k in keys]), np.asarray(t["times_sum"], np.int64)


def _texts(names: pa.Array, codes: np.ndarray, cuts: Sequence[tuple[int, int]]) -> list[pa.Array]:
    """Per cut (first row of ``codes``, end) the words of these rows, joined."""
    text = [names.take(pa.array(c, mask=c < 0)) for c in codes]
    return [_joined(text[i:j]) for i, j in cuts]


def _positions(sizes: Sequence[int]):
    """Per hash the arrays (by, words of the smallest size, words up to the next size or NULL, ..., times) of word positions:
    what is counted, as texts."""
    cuts = list(zip([0, *sizes], sizes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in _found(batches, sizes):
            first = np.flatnonzero(np.append(True, f.bucket[1:] != f.bucket[:-1])[:len(f.bucket)])
            offsets = pa.array(np.append(first, len(f.bucket)).astype(np.int32))
            arrays = [*_texts(f.by, f.codes[:1], [(0, 1)]), *_texts(f.names, f.codes[1:], cuts), pa.array(f.times)]
            yield pa.RecordBatch.from_arrays([pa.array(f.bucket[first]), *(pa.ListArray.from_arrays(offsets, x) for x in arrays)],
                                             ["bucket", "by", *(f"w{j}" for j in sizes), "times"])

    return run


def _planes(a: np.ndarray) -> np.ndarray:
    """Bytes of 32-bit numbers, row by row all the lowest ones first: these compress better."""
    return np.ascontiguousarray(np.moveaxis(np.ascontiguousarray(a, "<i4").view(np.uint8).reshape(*a.shape, 4), -1, -2)).reshape(-1)


def _of_planes(b: np.ndarray, *shape: int) -> np.ndarray:
    return np.ascontiguousarray(np.moveaxis(b.reshape(*shape[:-1], 4, shape[-1]), -2, -1)).view("<i4").reshape(shape)


def _packed(sizes: Sequence[int], parts: int):
    """(part, by, names, codes, and their lengths) of word positions: one row for each portion and part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in _found(batches, sizes):
            yield from _rows(f, parts)
            del f
            pa.default_memory_pool().release_unused()

    return run


def _rows(f: Found, parts: int) -> Iterator[pa.RecordBatch]:
    """One row for each part of ``f``."""
    part = f.bucket // (BUCKETS // parts)
    cuts = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])[:len(part)]), len(part))
    if len(cuts) < 2:
        return
    # the words of each part, in alphabetical order, a space behind each, and their numbers there (0 for none)
    order = np.asarray(pc.sort_indices(f.names))
    rank = np.empty(len(order) + 1, np.int64)
    rank[order], rank[-1] = np.arange(1, len(order) + 1), 0
    room = len(order) + 1
    key, at = np.unique(part * room + rank[f.codes[1:]], return_inverse=True)
    none = key % room == 0
    first = np.searchsorted(key[~none], np.arange(parts + 1) * room)
    number = np.where(none, 0, np.cumsum(~none) - first[key // room]).astype(np.int32)[at].reshape(len(f.codes) - 1, -1)
    words = f.names.take(pa.array(order[key[~none] % room - 1])).cast(pa.large_string())
    words = pc.binary_join_element_wise(words, pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
    offsets, text = (np.frombuffer(x, kind) for x, kind in zip(words.buffers()[1:], (np.int64, np.uint8)))
    del key, at, none
    codec = pa.Codec("zstd", compression_level=3)
    rows, held = [], 0
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        k = int(part[lo])
        said = text[offsets[first[k]]:offsets[first[k + 1]]]
        by, own = np.unique(f.codes[0, lo:hi], return_inverse=True)
        times = f.times[lo:hi]
        codes = _planes(np.concatenate([[own], number[:, lo:hi], [times & 0x7FFFFFFF, times >> 31]]))
        rows.append((k, f.by.take(pa.array(by, mask=by < 0)), codec.compress(said, asbytes=True), codec.compress(codes, asbytes=True), len(said), hi - lo))
        held += len(rows[-1][2]) + len(rows[-1][3])
        if held > ROWS_BYTES or hi == len(part):
            cols = list(zip(*rows))
            ends = pa.array(np.append(0, np.cumsum([len(x) for x in cols[1]])), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.ListArray.from_arrays(ends, pa.concat_arrays(cols[1])), *(pa.array(c, pa.binary()) for c in cols[2:4]),
                                              *(pa.array(c, pa.int32()) for c in cols[4:])], ["part", "by", "names", "codes", "n_bytes", "n"])
            rows, held = [], 0


def _counted(sizes: Sequence[int]):
    """(by, n, gram, count) of packed rows sorted by their part."""
    cuts = list(zip([0, *sizes], sizes))
    rows = sizes[-1] + 3

    def opened(b: pa.RecordBatch, i: int) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]:
        """(by, names, numbers, times) of one row."""
        codec = pa.Codec("zstd")
        size, n = (b.column(k)[i].as_py() for k in (4, 5))
        said = np.frombuffer(codec.decompress(b.column(2)[i].as_buffer(), size), np.uint8)
        space = said == 32
        ends = np.flatnonzero(space)
        names = pa.StringArray.from_buffers(len(ends), pa.py_buffer(np.append(0, ends - np.arange(len(ends))).astype(np.int32)), pa.py_buffer(said[~space]))
        codes = _of_planes(np.frombuffer(codec.decompress(b.column(3)[i].as_buffer(), 4 * rows * n), np.uint8), rows, n)
        return b.column(1)[i].values, names, np.concatenate([codes[:1], codes[1:-2] - 1]), codes[-2].astype(np.int64) + (codes[-1].astype(np.int64) << 31)

    def together(held: list[tuple]) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]:
        """The rows of a part as one, equal positions added up."""
        out = []
        for k in (0, 1):
            all_of = pa.concat_arrays([h[k] for h in held]).dictionary_encode()
            number = np.append(np.asarray(pc.fill_null(all_of.indices, -1), np.int32), np.int32(-1))
            starts = np.cumsum([0, *(len(h[k]) for h in held[:-1])])
            some = slice(0, 1) if k == 0 else slice(1, None)
            out.append((all_of.dictionary, np.concatenate([number[np.where(h[2][some] < 0, -1, h[2][some] + s)] for h, s in zip(held, starts)], axis=1)))
        codes, times = _summed(np.concatenate([out[0][1], out[1][1]]), np.concatenate([h[3] for h in held]))
        return out[0][0], out[1][0], codes, times

    def out(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        by, names, codes, times = together(held)
        for k, n in enumerate(sizes):
            fits = codes[n] >= 0
            some, many = (codes[:n + 1, fits], times[fits]) if k == len(sizes) - 1 else _summed(codes[:n + 1, fits], times[fits])
            for lo in range(0, len(many), 20_000):
                part = some[:, lo:lo + 20_000]
                gram = _joined(_texts(names, part[1:], cuts[:k + 1]))
                yield pa.RecordBatch.from_arrays([*_texts(by, part[:1], [(0, 1)]), pa.array(np.full(len(gram), n, np.int32)), gram, pa.array(many[lo:lo + 20_000])],
                                                 ["by", "n", "gram", "count"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now, count, known = None, 0, 0
        for b in batches:
            for i, part in enumerate(b.column(0).to_pylist()):
                if held and part != now:
                    yield from out(held)
                    held, count, known = [], 0, 0
                now = part
                held.append(opened(b, i))
                count += len(held[-1][3])
                if count > HELD + 2 * known:
                    held = [together(held)]
                    count = known = len(held[0][3])
        if held:
            yield from out(held)

    return run


def _parts(spark: SparkSession) -> int:
    """Parts for each shuffle partition: at least two, as they are dealt by a hash."""
    want = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(BUCKETS, max(PARTS, 1 << (want - 1).bit_length()))


def ngram_counts(comments: DataFrame, sizes: Sequence[int] = (2, 3), text_col: str = "text_clean",
                 by: str = "video_id") -> DataFrame:
    """(by, n, gram, count) over every comment."""
    ship_package(comments.sparkSession)
    sizes = sorted(set(sizes))
    key = comments.schema[by].dataType.simpleString()
    texts = comments.select(F.col(by).alias("by"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = texts.mapInArrow(_packed(sizes, _parts(comments.sparkSession)),
                             f"part int, by array<{key}>, names binary, codes binary, n_bytes int, n int")
    return (found.repartition("part").sortWithinPartitions("part")
            .mapInArrow(_counted(sizes), f"by {key}, n int, gram string, count long").withColumnRenamed("by", by))


def top_ngrams(comments: DataFrame, sizes: Sequence[int] = (2, 3), k: int = 20, text_col: str = "text_clean",
               by: str = "video_id") -> DataFrame:
    """The k most frequent n-grams per (by, n); ties by gram text; ``rank`` 1..k."""
    counts = ngram_counts(comments, sizes, text_col, by)
    w = Window.partitionBy(by, "n").orderBy(F.col("count").desc(), F.col("gram").asc())
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

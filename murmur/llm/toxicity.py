"""Toxicity by compression distance between two zstandard dictionaries.

Training uses a bounded, documented sample of labelled rows (``Bounds``); a text longer than
``section`` characters enters it as sections of about that length, all of it.  The ordinary
dictionary is trained by zstandard on windows of ordinary documents.  The toxic one
holds, in front of the same ordinary bytes, the stretches of toxic documents whose byte
n-grams are ``ratio`` times as frequent there as in ordinary documents; sharing the rest
makes the two compressed lengths of an ordinary window equal but for a byte or two.

A text is cut into word-aligned windows of ``window`` bytes, the whole text of them.  A
window's gain is its length under the ordinary dictionary less that under the toxic one.
The score is a logistic function, calibrated on labelled rows that gave no stretch, of the
largest gain, the summed gains above one byte, their mean, and the number of windows.

Nulls, ties, empty input: a NULL or blank text is one empty window; rows without label, with a
NULL label or NULL id train nothing; an id labelled twice takes the larger label; without
rows of both classes every score is 0.0; an empty table gives an empty result; repeated
rows are scored each; further columns are ignored by ``toxicity`` and kept by ``drop_toxic``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import give_back, ship

_BLANK = re.compile(r"\s")


@dataclass(frozen=True)
class Bounds:
    """Bounds of the training sample and settings of the dictionaries."""

    toxic_rows: int = 2000
    ordinary_rows: int = 6000
    section: int = 40_000           # characters after which a training text goes on as a further row
    gram: int = 5
    least_share: float = 0.003      # of toxic documents that hold a stretch's n-gram
    ratio: float = 20.0
    dictionary: int = 8192
    window: int = 48
    level: int = 7


def _line(text: str | None) -> bytes:
    return b" " + b" ".join((text or "").lower().encode().split())


def windows(line: bytes, size: int) -> list[bytes]:
    """The whole line in pieces of at least ``size`` bytes, each cut before a blank."""
    out, at = [], 0
    while (end := line.find(b" ", at + size)) >= 0:
        out.append(line[at:end])
        at = end
    out.append(line[at:])
    return out


def _grams(line: bytes, n: int) -> set[bytes]:
    """n-grams inside words, the blank before a word included."""
    return {g for i in range(len(line) - n + 1) if 32 not in (g := line[i:i + n])[1:]}


def _stretches(toxic: list[bytes], ordinary: list[bytes], b: Bounds) -> list[bytes]:
    """Maximal stretches of toxic lines made of n-grams that ordinary lines hardly hold,
    rarest first."""
    a, o = Counter(), Counter()
    for line in toxic:
        a.update(_grams(line, b.gram))
    for line in ordinary:
        o.update(_grams(line, b.gram))
    least = max(3, b.least_share * len(toxic))
    kept = {g for g, c in a.items() if c >= least and b.ratio * (o[g] + 0.5) / len(ordinary) < c / len(toxic)}
    found: Counter[bytes] = Counter()
    for line in toxic:
        start = None
        for i in range(len(line) - b.gram + 2):
            if line[i:i + b.gram] in kept:
                start = i if start is None else start
            elif start is not None:
                found[line[start:i - 1 + b.gram]] += 1
                start = None
    return [s for s, c in sorted(found.items(), key=lambda x: (x[1], x[0])) if c >= 2]


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]      # of the scaled features, then the constant
    center: tuple[float, ...]
    scale: tuple[float, ...]
    low: tuple[float, ...]          # range of the features seen in calibration
    high: tuple[float, ...]
    window: int
    level: int

    def features(self, lines: list[bytes]) -> np.ndarray:
        plain, toxic = _compressors(self)
        rows = np.empty((len(lines), 4))
        for k, line in enumerate(lines):
            parts = windows(line, self.window)
            gain = np.array([len(plain.compress(w)) - len(toxic.compress(w)) for w in parts])
            over = float(np.maximum(gain - 1, 0).sum())
            rows[k] = gain.max(), np.log1p(over), over / len(gain), np.log(len(gain))
        return rows

    def score(self, lines: list[bytes]) -> np.ndarray:
        if not self.weights:
            return np.zeros(len(lines))
        x = (np.clip(self.features(lines), self.low, self.high) - self.center) / self.scale
        return 1 / (1 + np.exp(-(x @ self.weights[:-1] + self.weights[-1])))


_made: dict[tuple, tuple] = {}


def _compressors(m: Model) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
    key = m.ordinary, m.toxic, m.level, m.window
    if key not in _made:
        params = zstandard.ZstdCompressionParameters.from_level(
            m.level, source_size=m.window + 16, dict_size=len(m.ordinary) + len(m.toxic), min_match=5,
            write_content_size=False, write_checksum=False, write_dict_id=False)
        pair = []
        for content in (m.ordinary, m.toxic + m.ordinary):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            pair.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params))
        _made.clear()
        _made[key] = tuple(pair)
    return _made[key]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4) -> tuple[float, ...]:
    """Newton's method with a small ridge."""
    z = np.c_[x, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z / len(y) + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(h, z.T @ (p - y) / len(y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(w.tolist())


def fit(toxic: list[str], ordinary: list[str], b: Bounds = Bounds()) -> Model:
    """Dictionaries from two thirds of the texts, thresholds from the others (from all, where
    there are fewer than 60 toxic ones)."""
    t, o = [_line(x) for x in toxic], [_line(x) for x in ordinary]
    blank = Model(b"", b"", (), (), (), (), (), b.window, b.level)
    if not t or not o:
        return blank
    few = len(t) < 60
    dict_t, dict_o = (t, o) if few else ([x for i, x in enumerate(t) if i % 3], [x for i, x in enumerate(o) if i % 3])
    cal_t, cal_o = (t, o) if few else (t[::3], o[::3])
    stretches = _stretches(dict_t, dict_o, b)
    if not stretches:
        return blank
    samples = [w for line in dict_o for w in windows(line, 256)][:40_000]
    try:
        plain = zstandard.train_dictionary(b.dictionary, samples).as_bytes()
    except zstandard.ZstdError:      # too little text to train on: the text itself
        plain = b"".join(samples)[-b.dictionary:]
    m = Model(plain, b"\0".join(stretches) + b"\0", (), (), (), (), (), b.window, b.level)
    x = m.features(cal_t + cal_o)
    y = np.r_[np.ones(len(cal_t)), np.zeros(len(cal_o))]
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    weights = _logistic((x - center) / scale, y)
    if weights[3] > 0:               # length alone never speaks against a text
        weights = _logistic((x - center) / scale * [1, 1, 1, 0], y)
    return Model(m.ordinary, m.toxic, weights, tuple(center.tolist()),
                 tuple(scale.tolist()), tuple(x.min(axis=0).tolist()), tuple(x.max(axis=0).tolist()), b.window, b.level)


def sections(text: str | None, size: int) -> list[str]:
    """The whole text in pieces of at least ``size`` characters (the last may be shorter), cut before a blank."""
    text = text or ""
    out, at = [], 0
    while len(text) - at > size and (end := _next_blank(text, at + size)) >= 0:
        out.append(text[at:end])
        at = end
    out.append(text[at:])
    return out


def _next_blank(text: str, at: int) -> int:
    m = _BLANK.search(text, at)
    return m.start() if m else -1


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, b: Bounds = Bounds()) -> Model:
    """Fit on labelled documents that are not held out; the sample's ids, and the texts or sections of them, are at
    most ``toxic_rows + ordinary_rows``, taken in hash order."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parts = sections(t, b.section)
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(parts), pa.int64()), pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.string())],
                                                 ["doc_id", "part", "text"])

    ship(docs.sparkSession)
    of_id = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter(~held_out(F.col("doc_id"))))
    texts: dict[int, list[str]] = {0: [], 1: []}
    for label, rows in ((1, b.toxic_rows), (0, b.ordinary_rows)):
        ids = of_id.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select("doc_id")
        got = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .join(F.broadcast(ids), "doc_id")              # bounded by ``rows``
               .mapInArrow(cut, "doc_id long, part int, text string")
               .orderBy(F.xxhash64("doc_id", "part"), F.xxhash64("text")).limit(rows))
        texts[label] = [r["text"] for r in got.select("text").collect()]
    return fit(texts[1], texts[0], b)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.score([_line(t) for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], ["doc_id", "score"])

    scored = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
              .mapInArrow(run, "doc_id long, score double"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    return score(docs, train(docs, labels, bounds))


def drop_toxic(docs: DataFrame, labels: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """The rows of ``docs`` scored below 0.5, all columns kept (rows are scored where they
    lie: no join)."""
    ship(docs.sparkSession)
    model = train(docs, labels, bounds)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.score([_line(t) for t in batch.column(place).to_pylist()])
            yield batch.filter(pa.array(p < 0.5))
        give_back()

    return docs.mapInArrow(run, docs.schema)

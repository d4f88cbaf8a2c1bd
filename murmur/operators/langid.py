"""Language identification: smoothed log-probabilities over character 1-3-grams.

* fit: the grams of labelled, cleaned text are counted batch by batch and summed per (language,
  gram); ``floor(1000 * ln((n + ALPHA) / (N + ALPHA * V)))`` is the weight of a gram in a language,
  with n its count there, N all grams of that length there and V the distinct ones of that length.
  The model holds the ``max_grams`` most frequent grams and at most ``MAX_LANGUAGES`` languages
  whatever the amount of training text; that is what makes it safe to broadcast.
* predict: an Arrow-batched column function looks every gram of a text up and sums the weights; the
  largest sum wins (ties -> smaller language code).  Rows are scored where they lie: no join, no
  shuffle, and Catalyst drops the function when the language is not selected.

Grams are those of ' ' + text + ' ' (code points).  Texts of fewer than ``MIN_CHARS`` code points and
texts without any known gram are 'unknown'.  Weights are integers, so the sums are exact and a
SQL oracle can repeat them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.functions.text import by_portions, portions
from murmur.session import ship_package
from murmur.sources.storage import stage

UNKNOWN = "unknown"
MIN_CHARS = 5          # shorter texts are 'unknown' (code points)
SIZES = (1, 2, 3)
ALPHA = 0.5
MAX_GRAMS = 200_000
MAX_LANGUAGES = 500
_PIECE = 1 << 18       # code points that are looked up at once; longer texts go on in the next piece


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]      # sorted
    codes: np.ndarray               # sorted codes of the known grams
    weights: np.ndarray             # (grams, languages) integers

    def best(self, texts: list[str | None]) -> list[str]:
        """The language of every text."""
        sums = np.zeros((len(texts), len(self.languages)))
        hits = np.zeros(len(texts), bool)
        if len(self.codes):
            for own, codes in _grams(texts, SIZES):
                at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
                known = self.codes[at] == codes
                own, at = own[known], at[known]
                hits[own] = True
                for k in range(len(self.languages)):
                    sums[:, k] += np.bincount(own, self.weights[at, k], len(texts))
        top = sums.argmax(axis=1) if len(self.languages) else np.zeros(len(texts), int)
        return [self.languages[k] if h and len(t) >= MIN_CHARS else UNKNOWN
                for t, h, k in zip((t or "" for t in texts), hits, top)]

    def detect(self, text: Column) -> Column:
        """The language of a text column."""
        from pyspark.sql import SparkSession
        spark = SparkSession.active()
        ship_package(spark)
        shared = spark.sparkContext.broadcast(self)

        @F.arrow_udf("string")
        def language(texts: pa.Array) -> pa.Array:
            return by_portions(texts, shared.value.best)

        return language(text)


def _grams(texts: list[str | None], sizes: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, code) of every gram, in bounded portions; a code holds 21 bits a character,
    each counted from 1, so that grams of different lengths differ."""
    def codes(pieces: list[tuple[int, str, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        lengths = np.array([len(p) for _, p, _ in pieces])
        cp = np.frombuffer("".join(p for _, p, _ in pieces).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64) + 1
        own = np.repeat(np.array([i for i, _, _ in pieces]), lengths)
        place = np.arange(len(cp)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        starts, left = np.repeat(np.array([n for _, _, n in pieces]), lengths), np.repeat(lengths, lengths) - place
        for k in sizes:
            at = np.flatnonzero((place < starts) & (left >= k))
            code = cp[at]
            for j in range(1, k):
                code = code | cp[at + j] << (21 * j)
            yield own[at], code

    held: list[tuple[int, str, int]] = []
    size = 0
    for i, t in enumerate(texts):
        padded = f" {t or ''} "
        for lo in range(0, len(padded), _PIECE):
            piece = padded[lo:lo + _PIECE + max(sizes) - 1]
            held.append((i, piece, min(_PIECE, len(padded) - lo)))
            size += len(piece)
            if size >= _PIECE:
                yield from codes(held)
                held, size = [], 0
    if held:
        yield from codes(held)


def _length(code: np.ndarray) -> np.ndarray:
    return 1 + (code >> 21 > 0) + (code >> 42 > 0)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi in portions(b.column(1)):
            langs, texts = (b.column(k).slice(lo, hi - lo).to_pylist() for k in (0, 1))
            for lang in sorted(set(langs)):
                for _, codes in _grams([t for t, x in zip(texts, langs) if x == lang], SIZES):
                    found, n = np.unique(codes, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found)), pa.array(found), pa.array(n)], ["lang", "code", "n"])


def fit(examples: DataFrame, text_col: str = "text_clean", lang_col: str = "lang", max_grams: int = MAX_GRAMS) -> Model:
    """The model of labelled, cleaned text; rows without label train nothing."""
    ship_package(examples.sparkSession)
    labelled = examples.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string"))
    counts = stage(labelled.mapInArrow(_counted, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n")),
                   examples.sparkSession, "language-grams")
    size = 1 + (F.shiftright("code", 21) > 0).cast("int") + (F.shiftright("code", 42) > 0).cast("int")
    totals = {(r["lang"], r["size"]): r["n"] for r in
              counts.groupBy("lang", size.alias("size")).agg(F.sum("n").alias("n")).limit(MAX_LANGUAGES * len(SIZES) + 1).collect()}
    languages = sorted({lang for lang, _ in totals})
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"the label column holds more than {MAX_LANGUAGES} languages")
    grams = counts.groupBy("code").agg(F.sum("n").alias("total"), F.collect_list(F.struct("lang", "n")).alias("by"))
    distinct = {r["size"]: r["n"] for r in grams.groupBy(size.alias("size")).agg(F.count("*").alias("n")).collect()}
    top = (grams.orderBy(F.desc("total"), "code").limit(max_grams)
           .select("code", F.inline("by")).toArrow())
    codes, row = np.unique(np.asarray(top["code"], np.int64), return_inverse=True)
    n = np.zeros((len(codes), len(languages)))
    number = {lang: k for k, lang in enumerate(languages)}
    n[row, np.array([number[x] for x in top["lang"].to_pylist()], int)] = np.asarray(top["n"], float)
    sizes = _length(codes)
    of_all = np.array([[totals.get((lang, k), 0) for lang in languages] for k in (0, *SIZES)], float).reshape(len(SIZES) + 1, len(languages))
    seen = np.array([distinct.get(k, 0) for k in (0, *SIZES)], float)
    weights = np.floor(1000 * np.log((n + ALPHA) / (of_all[sizes] + ALPHA * seen[sizes][:, None])))
    return Model(tuple(languages), codes, weights)


def predict(df: DataFrame, text_col: str, model: Model, out_col: str = "language") -> DataFrame:
    """``df`` plus ``out_col``, the language of ``text_col``; all rows stay, also those without an id."""
    return df.withColumn(out_col, model.detect(F.col(text_col)))


def accuracy(pred: DataFrame, truth_col: str = "lang", pred_col: str = "language") -> DataFrame:
    """Per true language: rows, correct predictions (counts, no floats)."""
    return pred.groupBy(truth_col).agg(F.count(F.lit(1)).alias("n"),
                                       F.count_if(F.col(truth_col) == F.col(pred_col)).alias("n_correct"))

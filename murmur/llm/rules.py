"""Quality classifier: a sparse ensemble of rules over statistics of the text.

Boosted trees of little depth are grown on labelled rows; every path from a root to a node is a
conjunctive rule (``symbol_share > 0.02 and upper_share <= 0.4``).  A logistic regression with an
L1 penalty weighs the rules and leaves few of them (the penalty is the one of ``PENALTIES`` with
the smallest loss on a fifth of the training rows), and what is left is compiled to one Spark column.

Statistics (``STATISTICS``) are counted over the whole text, in Arrow batches; training sees a
bounded sample, ``rows`` labelled documents of each class in hash order, whole texts of
any length, and only their statistics reach the driver.

Nulls, ties, empty input: a NULL text counts as empty, an empty text has statistics of zero and gets
a score like any other; rows without label, with a NULL label or a NULL id train nothing; an id labelled
twice takes the larger label; without rows of both classes the score is the share of label 1 (0.5 without
any label); repeated rows are scored each; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import add, and_, eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import ship, text_bytes

STATISTICS = ("log_bytes", "log_words", "word_bytes", "upper_share", "digit_share", "symbol_share", "shout_share", "stop_share",
              "other_share", "line_bytes", "distinct_words", "repeated_words", "top_word", "bare_words", "distinct_lines")
ROWS = 10_000                  # labelled documents of each class that train
TREES, DEPTH, BINS, RATE = 40, 3, 32, 0.3
LEAST = 10                     # rows of a leaf
PENALTIES = (0.03, 0.01, 0.003, 0.001, 0.0003)

_STOPS, _SHOUT, _BLANK = b".,;:'\"-()", b"!?", b" \t\n\r\x0b\x0c"
_CLASSES = np.zeros((256, 7))
for _b in range(256):
    _c = bytes([_b])
    _CLASSES[_b, 0 if _c.isupper() else 1 if _c.islower() else 2 if _c.isdigit() else 3 if _b >= 128 else
             4 if _c in _SHOUT else 5 if _c in _STOPS or _c in _BLANK else 6] = 1
_CLASSES = np.c_[_CLASSES, [bytes([b]) in _STOPS for b in range(256)]]
_NOT_ALNUM = bytes(b for b in range(128) if not chr(b).isalnum() and b not in _BLANK)


def statistics_of(text: bytes | None) -> tuple[float, ...]:
    """The values of ``STATISTICS`` for one text."""
    t = text or b""
    words = t.split()
    if not words:
        return (float(np.log1p(len(t))), *[0.0] * (len(STATISTICS) - 1))
    upper, lower, digit, other, shout, _, symbol, stop = np.bincount(np.frombuffer(t, np.uint8), minlength=256) @ _CLASSES
    n, w = len(t), len(words)
    often = Counter(words)
    lines = [x for x in t.split(b"\n") if x]
    return (float(np.log1p(n)), float(np.log1p(w)), float(sum(map(len, words)) / w), float(upper / max(1, upper + lower)),
            float(digit / n), float(symbol / n), float(shout / n), float(stop / n), float(other / n), n / max(1, len(lines)),
            len(often) / w, sum(map(eq, words, words[1:])) / w, max(often.values()) / w,
            1 - len(t.translate(None, _NOT_ALNUM).split()) / w, len(set(lines)) / max(1, len(lines)))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and ``STATISTICS`` of every row."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([statistics_of(t) for t in text_bytes(b.column(1))]).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c) for c in x.T)], ["doc_id", *STATISTICS])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, " + ", ".join(f"{s} double" for s in STATISTICS)))


#: (statistic, whether it must lie above the threshold, threshold)
Condition = tuple[str, bool, float]


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    weight: float

    def column(self) -> Column:
        return reduce(and_, (F.col(s) > F.lit(t) if above else F.col(s) <= F.lit(t) for s, above, t in self.conditions))

    def __str__(self) -> str:
        return f"{self.weight:+.3f} if " + " and ".join(f"{s} {'>' if above else '<='} {t:.4g}" for s, above, t in self.conditions)


@dataclass(frozen=True)
class Ensemble:
    rules: tuple[Rule, ...]
    base: float                # logit without any rule

    def column(self) -> Column:
        """The score, from 0 to 1, over the columns ``STATISTICS``."""
        total = reduce(add, (F.when(r.column(), F.lit(r.weight)).otherwise(F.lit(0.0)) for r in self.rules), F.lit(self.base))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _grow(binned: np.ndarray, edges: list[np.ndarray], gradient: np.ndarray, curve: np.ndarray, rows: np.ndarray,
          path: tuple[Condition, ...], depth: int, step: np.ndarray) -> list[tuple[Condition, ...]]:
    """Splits ``rows`` by the largest gain of Newton's objective, adds the leaves' values to ``step`` and
    returns the paths of all nodes."""
    g, h = gradient[rows].sum(), curve[rows].sum()
    best = (1e-6, -1, -1)
    if depth:
        for f, cuts in enumerate(edges):
            k = len(cuts) + 1
            part = binned[rows, f]
            lg, lh, ln = (np.cumsum(np.bincount(part, x, k))[:-1] for x in (gradient[rows], curve[rows], np.ones(len(rows))))
            gain = lg * lg / (lh + 1) + (g - lg) ** 2 / (h - lh + 1) - g * g / (h + 1)
            gain[(ln < LEAST) | (len(rows) - ln < LEAST)] = 0
            if len(gain) and gain.max() > best[0]:
                best = (float(gain.max()), f, int(gain.argmax()))
    _, f, cut = best
    if f < 0:
        step[rows] = g / (h + 1)
        return []
    out = []
    for above in (False, True):
        here = (*path, (STATISTICS[f], above, float(edges[f][cut])))
        part = rows[(binned[rows, f] > cut) == above]
        out += [here, *_grow(binned, edges, gradient, curve, part, here, depth - 1, step)]
    return out


def _paths(x: np.ndarray, y: np.ndarray) -> list[tuple[Condition, ...]]:
    """The node paths of boosted trees, each once, conditions on one side of a statistic joined."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)])
    share = y.mean()
    logit = np.full(len(y), np.log(share / (1 - share)))
    found: dict[tuple[Condition, ...], None] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-logit))
        step = np.zeros(len(y))
        for path in _grow(binned, edges, y - p, p * (1 - p), np.arange(len(y)), (), DEPTH, step):
            tight: dict[tuple[str, bool], float] = {}
            for s, above, t in path:
                tight[s, above] = t if (s, above) not in tight else max(t, tight[s, above]) if above else min(t, tight[s, above])
            found[tuple(sorted((s, above, t) for (s, above), t in tight.items()))] = None
        logit += RATE * step
    return list(found)


def fires(path: tuple[Condition, ...], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for s, above, t in path:
        c = x[:, STATISTICS.index(s)]
        out &= c > t if above else c <= t
    return out


def _lasso(z: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 1500) -> tuple[np.ndarray, float]:
    """Weights and constant of the L1-penalised logistic regression (accelerated proximal gradient);
    columns are scaled by their deviation, the constant is not penalised."""
    scale = z.std(axis=0)
    a = np.c_[(z - z.mean(axis=0)) / scale, np.ones(len(z))]
    rate = 4 * len(y) / max(1e-12, float(np.linalg.eigvalsh(a.T @ a)[-1]))
    w = v = np.zeros(a.shape[1])
    k = 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ v, -40, 40)))
        new = v - rate * (a.T @ (p - y)) / len(y)
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * penalty, 0)
        up = (1 + np.sqrt(1 + 4 * k * k)) / 2
        v = new + (k - 1) / up * (new - w)
        done = np.abs(new - w).max() < 1e-6
        w, k = new, up
        if done:
            break
    return w[:-1] / scale, float(w[-1] - (w[:-1] / scale) @ z.mean(axis=0))


def fit(x: np.ndarray, y: np.ndarray) -> Ensemble:
    """Rules and weights for rows of ``STATISTICS`` and labels 0 or 1."""
    y = np.asarray(y, float)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        return Ensemble((), float(np.clip(np.log((share + 1e-9) / (1 - share + 1e-9)), -20, 20)))
    paths, columns, seen = [], [], set()
    for path in _paths(x, y):
        on = fires(path, x)
        if on.all() or not on.any() or (key := min(on.tobytes(), (~on).tobytes())) in seen:
            continue                   # a rule that says what another one says
        seen.add(key)
        paths.append(path)
        columns.append(on)
    if not paths:
        share = y.mean()
        return Ensemble((), float(np.log(share / (1 - share))))
    z = np.column_stack(columns).astype(float)
    check = np.arange(len(y)) % 5 == 0
    rest = ~check
    usable = z[rest].std(axis=0) > 0
    best = PENALTIES[len(PENALTIES) // 2], np.inf
    if usable.any() and 0 < y[rest].mean() < 1:
        for penalty in PENALTIES:
            w, base = _lasso(z[rest][:, usable], y[rest], penalty)
            logit = np.clip(z[check][:, usable] @ w + base, -40, 40)
            loss = float(np.mean(np.logaddexp(0, logit) - y[check] * logit))
            if loss < best[1]:
                best = penalty, loss
    w, base = _lasso(z, y, best[0])
    return Ensemble(tuple(Rule(p, float(v)) for p, v in zip(paths, w) if v), base)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Ensemble:
    """Fit on at most ``rows`` labelled documents of each class that are not held out."""
    of_id = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .dropna().groupBy("doc_id").agg(F.max("quality").alias("quality")).filter(~held_out(F.col("doc_id"))))
    xs, ys = [], []
    for label in (0, 1):
        ids = of_id.filter(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select("doc_id")
        texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                 .join(F.broadcast(ids), "doc_id"))               # bounded by ``rows``
        got = statistics(texts).orderBy(F.xxhash64("doc_id"), "doc_id", *STATISTICS).limit(rows).toArrow()
        x = np.column_stack([np.asarray(got[s]) for s in STATISTICS]).reshape(-1, len(STATISTICS))
        xs.append(x)
        ys.append(np.full(len(x), label))
    x, y = np.concatenate(xs), np.concatenate(ys)
    mixed = np.random.default_rng(0).permutation(len(y))
    return fit(x[mixed], y[mixed])


def quality(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    scored = statistics(docs).withColumn("score", train(docs, labels, rows).column())
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

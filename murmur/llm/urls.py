"""URL filter: host and path rules first, then logistic regression on hashed n-grams.

Host and path are cut out with SQL functions.  The longest rule that fits a host (or
one of its parent domains) and begins the path decides.  Every other url gets the verdict
of a logistic regression on hashed character n-grams of host and path, trained in numpy on
a small labelled table (``LABELLED`` unless another is given) and applied by an
Arrow function to the distinct (host, path) of each batch.

Nulls, ties, empty input: a NULL url, or one without ``://``, has empty host and path, fits no
rule and has no n-gram, so the model's prior decides: allow; rules of equal length are tried in the given order; a NULL
page_id keeps its row; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import ship

Rule = tuple[str, str]      # host/path, verdict

#: Small labelled table: (url, 1 = block).
LABELLED: tuple[tuple[str, int], ...] = (
    ("http://ads.bigserver.test/en/1201", 1), ("https://www.ad-tracker.test/de/771", 1),
    ("http://adserver.metrics.test/fr/31.html", 1), ("https://m.ads-network.test/es/90/", 1),
    ("http://blog.click-track.test/en/5512", 1), ("https://www.adtrack.test/en/20?page=2", 1),
    ("http://m.casino-royal.test/en/4410", 1), ("https://www.online-casino.test/de/812/", 1),
    ("http://blog.win-casino.test/fr/6.html", 1), ("https://casino-slots.test/en/33417", 1),
    ("http://free-bets-now.test/es/1822", 1), ("https://m.sports-bets.test/en/71#top", 1),
    ("http://www.best-betting.test/de/9120", 1), ("https://blog.poker-win.test/en/2", 1),
    ("http://cheap-pills-online.test/en/512", 1), ("https://m.buy-cheap-meds.test/fr/44", 1),
    ("http://www.pills-discount.test/en/7/", 1), ("https://blog.cheap-pharma.test/es/305", 1),
    ("http://adult-videos.test/en/66120", 1), ("https://www.adult-cams.test/de/18", 1),
    ("http://m.adult-x-chat.test/fr/2405", 1), ("https://blog.hot-adult.test/en/9.html", 1),
    ("http://spam-links.test/en/8123", 1), ("https://www.link-farm.test/de/4", 1),
    ("http://m.seo-spam-farm.test/es/51/", 1), ("https://blog.spam-mail.test/en/300", 1),
    ("http://malware-crack.test/en/72", 1), ("https://phishing-login.test/fr/1145", 1),
    ("http://www.fast-money.test/en/61", 1), ("https://m.payday-loans.test/de/7718", 1),
    ("https://www.library.test/en/1204", 0), ("http://news.citypaper.test/de/2021/", 0),
    ("https://en.encyclopedia.test/fr/31.html", 0), ("http://blog.gardener.test/en/90/", 0),
    ("https://docs.software.test/en/5512", 0), ("http://m.weather.test/fr/20?page=2", 0),
    ("https://school.test/de/4410", 0), ("http://museum.test/es/812/", 0),
    ("https://journal.science.test/en/8812", 0), ("http://recipes.test/en/33417", 0),
    ("https://m.forum.test/es/1822", 0), ("http://hospital.test/en/71#top", 0),
    ("https://www.bookstore.test/de/9120", 0), ("http://blog.university.test/en/2", 0),
    ("https://radio.test/en/512", 0), ("http://m.train.test/fr/44", 0),
    ("https://blog.station.test/es/305", 0), ("http://www.theatre.test/en/7/", 0),
    ("https://northern.test/en/66120", 0), ("http://www.thousand.test/de/18", 0),
    ("https://m.athens.test/fr/2405", 0), ("http://blog.whether.test/en/9.html", 0),
    ("https://tablenter.test/en/8123", 0), ("http://www.erstwhile.test/de/4", 0),
    ("https://m.mountain.test/es/51/", 0), ("http://blog.parliament.test/en/300", 0),
    ("https://history.test/en/72", 0), ("http://theory.test/fr/1145", 0),
    ("https://www.country.test/en/61", 0), ("http://m.kitchen.test/de/7718", 0),
)


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From behind the host to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, NULL where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):        # the longest is tried first
        h, slash, p = text.partition("/")
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(slash + p))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


@dataclass(frozen=True)
class Grams:
    """Hashed character n-grams of ``^host$`` and ``path$``; digits count as one sign."""

    low: int = 3
    high: int = 5
    buckets: int = 1 << 16

    def of(self, host: str, path: str) -> np.ndarray:
        found = set()
        for mark, text in (("h", f"^{host}$"), ("p", f"{path}$")):
            text = "".join("0" if c.isdigit() else c for c in text.lower())
            found.update(mark + text[i:i + n] for n in range(self.low, self.high + 1) for i in range(len(text) - n + 1))
        return np.unique(np.fromiter((zlib.crc32(g.encode("utf-8", "replace")) % self.buckets for g in found), np.int64, len(found)))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    grams: Grams

    def score(self, host: str, path: str) -> float:
        at = self.grams.of(host, path)
        z = self.bias + (self.weights[at].sum() / np.sqrt(len(at)) if len(at) else 0.0)
        return float(1 / (1 + np.exp(-z)))


def split(url: str | None) -> tuple[str, str]:
    """(host, path) of a url as ``host_of`` and ``path_of`` cut it."""
    _, found, rest = (url or "").partition("://")
    rest = rest.split("#")[0].split("?")[0] if found else ""
    host, slash, path = rest.partition("/")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), slash + path


def fit(labelled: Sequence[tuple[str, int]], grams: Grams = Grams(), rounds: int = 1000, ridge: float = 1e-5,
        bias: float = -0.5) -> Model:
    """Gradient descent on the small table (it is the training set as a whole).  ``bias`` is the
    prior for a url the table says nothing about, below 0: allow."""
    rows = [grams.of(*split(u)) for u, _ in labelled]
    used = np.unique(np.concatenate(rows)) if rows else np.zeros(0, np.int64)
    x = np.zeros((len(rows), len(used)))
    for k, at in enumerate(rows):
        if len(at):
            x[k, np.searchsorted(used, at)] = 1 / np.sqrt(len(at))
    y = np.array([v for _, v in labelled], float)
    w = np.zeros(len(used))
    for _ in range(rounds):
        off = 1 / (1 + np.exp(-(x @ w + bias))) - y
        w -= 4.0 * (x.T @ off / max(1, len(y)) + ridge * w)
    weights = np.zeros(grams.buckets)
    weights[used] = w
    return Model(weights, bias, grams)


def judge(pages: DataFrame, rules: Sequence[Rule], labelled: Sequence[tuple[str, int]] = LABELLED) -> DataFrame:
    """page_id, host, path, rule, verdict and the model's score of every page (NULL where a
    rule decides)."""
    ship(pages.sparkSession)
    model = fit(labelled)
    parts = pages.select(F.col("page_id"), host_of(F.col("url").cast("string")).alias("host"), path_of(F.col("url").cast("string")).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = parts.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("said"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            host, path, said = (b.column(k).to_pylist() for k in (1, 2, 4))
            seen: dict[tuple[str, str], float] = {}
            out: list[float | None] = []
            for h, p, s in zip(host, path, said):
                if s is None and (h, p) not in seen:
                    seen[h, p] = model.score(h, p)
                out.append(seen[h, p] if s is None else None)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.float64())], [*b.schema.names, "score"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ruled.schema.fields)
    scored = ruled.mapInArrow(run, f"{fields}, score double")
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce("said", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")

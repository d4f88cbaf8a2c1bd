"""Secret scan of whole texts: fixed patterns, and a token-efficiency test for the rest.

Base kinds are regular expressions (leftmost, non-overlapping per kind; too short
matches are dropped): ``assign``, ``access`` and ``hex``.  The method then looks at every
other unbroken run of ``LEAST`` or more key characters: ordinary words are cheap in a public
tiktoken vocabulary, random strings are not, so a run with fewer characters per token than
``max_ratio`` is a secret (kind ``random``).  Short runs and runs of letters alone, where
chance and rare words come nearer, must lie further below (``SHARES``).  Between joining characters the
parts are tested, so that paths and joined words are judged by their words; a run of short
parts is tested as a whole if at least half of it mixes letters and digits.  Known digests (hex of the
usual digest lengths), UUIDs, numbers and dates are excluded, and what overlaps a base span is not
reported twice.

Nulls and empty input: a NULL text is empty and has no span; a NULL id keeps its row; an empty
table gives an empty result; repeated rows are scanned each; further columns are ignored by
``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import give_back, ship

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")     # a maximal run of 16 or more
LEAST = 12
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
#: (characters, share of ``max_ratio`` for letters alone, for others) from that length on.
SHARES = ((18, 1.02, 1.05), (16, 0.97, 1.05), (14, 0.9, 0.95), (LEAST, 0.85, 0.95))
JOINS = re.compile("[-_/+=]+")
#: Every match of ASSIGN holds one of these in some case.
HINTS = ("passw", "secret", "token", "apikey", "api_key")
DIGESTS = frozenset((32, 40, 48, 56, 64, 96, 128))
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
CASE = re.compile("[a-z][A-Z]")
MIXED = re.compile(r"(?=.*[A-Za-z])(?=.*[0-9])(?![A-Za-z]+[0-9]+$).{4,}")     # more than a word with a number

Span = tuple[int, int, int]            # start, kind, end


def base_spans(text: str) -> list[Span]:
    found: list[Span] = []
    low = text.lower()
    if any(h in low for h in HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def known(run: str) -> bool:
    """A number or date, a UUID or a digest, not a secret."""
    if not any(c.isalpha() for c in run):
        return True
    return UUID.fullmatch(run) is not None or len(run) in DIGESTS and re.fullmatch("[0-9a-f]+|[0-9A-F]+", run) is not None


class TokenEfficiency:
    """Spans of runs with few characters per token."""

    def __init__(self, rank_file: str, max_ratio: float):
        import public_tokenizers
        import tiktoken
        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.coder = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.max_ratio = max_ratio

    def ratio(self, run: str) -> float:
        return len(run) / len(self.coder.encode_ordinary(run))

    def odd(self, run: str) -> bool:
        letters = not any(c.isdigit() for c in run) and len(CASE.findall(run)) < 2
        share = next(a if letters else b for n, a, b in SHARES if len(run) >= n)
        return self.ratio(run) < share * self.max_ratio

    def secret(self, run: str) -> bool:
        parts = JOINS.split(run)
        if any(self.odd(p) for p in parts if len(p) >= LEAST):
            return not known(run)
        mixed = sum(len(p) for p in parts if MIXED.match(p))
        return len(parts) > 1 and 2 * mixed >= len(run) and self.odd(run) and not known(run)

    def spans(self, text: str, taken: list[Span]) -> list[Span]:
        found = []
        for m in RUN.finditer(text):
            if any(s < m.end() and m.start() < e for s, _, e in taken):
                continue
            if self.secret(m[0]):
                found.append((m.start(), 3, m.end()))
        return found


_coders: dict[tuple[str, float], TokenEfficiency] = {}


def find(text: str | None, rank_file: str, max_ratio: float) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), both by start, then kind."""
    key = rank_file, max_ratio
    if key not in _coders:
        _coders[key] = TokenEfficiency(*key)
    base = base_spans(text or "")
    return base, sorted(base + _coders[key].spans(text or "", base))


_SPANS = ("doc_id long, base array<struct<kind:string,start:int,end:int>>, "
          "spans array<struct<kind:string,start:int,end:int>>")


def scan(docs: DataFrame, rank_file: str, max_ratio: float = 1.9) -> DataFrame:
    """doc_id, base and spans (arrays of kind, start, end in code points, end exclusive)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        rows = lambda spans: [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans]
        for b in batches:
            found = [find(t, rank_file, max_ratio) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([rows(x) for x, _ in found], kind), pa.array([rows(x) for _, x in found], kind)],
                ["doc_id", "base", "spans"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, _SPANS))


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, the SHA-256 of the base spans, and all spans as text."""
    line = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(line("base"), 256).alias("base_sha256"), line("spans").alias("spans"))


def mask(text: str, spans: list[Span], mark: str) -> str:
    out, at = [], 0
    for start, _, end in sorted(spans):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, rank_file: str, max_ratio: float = 1.9, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mark``; all rows and columns stay, texts without
    a span as they are, NULL texts stay NULL."""
    ship(docs.sparkSession)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(place).to_pylist()
            for i, t in enumerate(texts):
                if t:
                    spans = find(t, rank_file, max_ratio)[1]
                    if spans:
                        texts[i] = mask(t, spans, mark)
            cols = b.columns
            cols[place] = pa.array(texts, b.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)
        give_back()

    return docs.mapInArrow(run, docs.schema)

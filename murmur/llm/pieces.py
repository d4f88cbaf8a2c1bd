"""SentencePiece encoding and decoding with an Aho-Corasick automaton.

The automaton holds the model's pieces.  One pass over a text follows its goto edges; at
each position the output links name every piece that ends there, longest first, and each
relaxes the best score of a segmentation up to that position (Viterbi).  Bytes that no piece
covers become byte pieces (or the unknown id).  Equal scores keep the longer last
piece, as the library's unigram encoder does.

No piece has a blank mark behind another character (checked when the model is
loaded), so every segmentation has a border before each run of blank marks and the best one
of a text is that of its chunks, one after another.  Chunks are numbered by Arrow, encoded once
per worker, and all new chunks of a slice walk the automaton in step as numpy arrays.

Text is escaped as the model says: one blank mark in front (``add_dummy_prefix``), blanks become
marks; the model must normalise by identity and keep repeated blanks (checked).

Nulls and empty input: a NULL or empty text has no ids and decodes to the empty text; a NULL
id keeps its row; an empty table gives an empty result; repeated rows are encoded each; further
columns are ignored.  A slice holds a bounded number of bytes, one chunk at least.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import ship
from murmur.llm.wordids import WordIds, large, slices

MARK = "\u2581"
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6


@dataclass
class Automaton:
    """Aho-Corasick automaton over pieces, as tables for numpy.

    ``goto[state, column]`` is the next state with failure edges resolved; ``piece[state]`` is
    the piece that ends in a state (or -1), ``out[state]`` the next state on its chain of
    output links (0 ends it).  Only letters of pieces longer than one have a column; any other
    letter leads to one state from everywhere, and ``letters`` holds that state, negated.
    """

    letters: dict[str, int]
    goto: np.ndarray
    piece: np.ndarray
    out: np.ndarray

    @classmethod
    def build(cls, pieces: list[tuple[str, int]]) -> Automaton:
        letters = {c: i + 1 for i, c in enumerate(sorted({c for p, _ in pieces if len(p) > 1 for c in p}))}      # 0: any other
        edges: list[dict[int, int]] = [{}]
        ends = [-1]
        for text, number in pieces:
            if len(text) == 1 and text not in letters:
                letters[text] = -len(edges)
                edges.append({})
                ends.append(number)
                continue
            state = 0
            for c in text:
                step = edges[state].get(letters[c])
                if step is None:
                    step = edges[state][letters[c]] = len(edges)
                    edges.append({})
                    ends.append(-1)
                state = step
            ends[state] = number
        goto = np.zeros((len(edges), max(letters.values(), default=0) + 1), np.int32)
        out = np.zeros(len(edges), np.int32)
        fail = np.zeros(len(edges), np.int32)
        queue = deque([0])
        while queue:
            state = queue.popleft()
            if state:
                goto[state] = goto[fail[state]]
            for letter, step in edges[state].items():
                back = goto[state, letter] if state else 0
                fail[step] = back
                out[step] = back if ends[back] >= 0 else out[back]
                goto[state, letter] = step
                queue.append(step)
        alone = [-c for c in letters.values() if c < 0]
        goto[alone] = goto[0]
        return cls(letters, goto, np.array(ends, np.int32), out)

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        return np.where(code < 0, -code, self.goto[state, np.maximum(code, 0)])


@dataclass
class Model:
    """Pieces and scores of a model file, with encoder and decoder."""

    path: str
    automaton: Automaton = field(init=False)

    def __post_init__(self) -> None:
        from sentencepiece import sentencepiece_model_pb2
        proto = sentencepiece_model_pb2.ModelProto()
        with open(self.path, "rb") as f:
            proto.ParseFromString(f.read())
        norm = proto.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only models that normalise by identity and keep blanks are supported")
        self.prefix = MARK if norm.add_dummy_prefix else ""
        self.pieces = [p.piece for p in proto.pieces]
        self.kinds = np.array([p.type for p in proto.pieces])
        self.scores = np.array([p.score for p in proto.pieces], np.float64)
        self.unknown = int(np.flatnonzero(self.kinds == _UNKNOWN)[0])
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.kinds[i] == _BYTE}
        normal = [(p, i) for i, p in enumerate(self.pieces) if self.kinds[i] in (_NORMAL, _USER)]
        if any(MARK in p.lstrip(MARK) for p, _ in normal):
            raise ValueError("a piece has a blank mark behind another character")
        if (self.kinds == _USER).any():
            raise ValueError("models with user-defined pieces are not supported")
        self.automaton = Automaton.build(normal)
        used = self.scores[self.kinds == _NORMAL]
        self.missing = float(used.min()) - 10.0 if len(used) else -10.0      # score of an uncovered character
        self.values = np.append(self.scores, self.missing)                 # -1: the uncovered character

    def best(self, chunks: list[str]) -> list[list[int]]:
        """Ids of the best segmentation of each chunk (already escaped)."""
        order = sorted(range(len(chunks)), key=lambda i: -len(chunks[i]))
        result: list[list[int]] = [[] for _ in chunks]
        lo = 0
        while lo < len(order):       # chunks of like length walk in step, in bounded tables
            longest = max(1, len(chunks[order[lo]]))
            group = order[lo:lo + max(1, 2_000_000 // longest)]
            lo += len(group)
            for i, ids in zip(group, self._walk([chunks[i] for i in group])):
                result[i] = ids
        return result

    def _walk(self, chunks: list[str]) -> list[list[int]]:
        a, n = self.automaton, len(chunks)
        size = np.array([len(c) for c in chunks])
        if not size.max(initial=0):
            return [[] for _ in chunks]
        points = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)
        known, numbers = np.unique(points, return_inverse=True)
        table = np.array([a.letters.get(chr(c), 0) for c in known.tolist()], np.int32)
        flat, start = table[numbers], np.cumsum(size) - size
        width = int(size.max())
        best = np.full((width + 1, n), -np.inf)
        best[0] = 0
        back = np.zeros((width + 1, n), np.int32)          # piece that ends here
        lengths = np.array([len(p) for p in self.pieces] + [1], np.int32)
        values = self.values
        state = np.zeros(n, np.int32)
        for t in range(width):
            live = int(np.searchsorted(-size, -t, "left"))      # chunks come longest first
            code = flat[start[:live] + t]
            state = a.step(state[:live], code)
            row = np.arange(live)
            at = np.where(a.piece[state] >= 0, state, a.out[state])
            while True:
                some = np.flatnonzero(at)
                if not len(some):
                    break
                row, at = row[some], at[some]
                piece = a.piece[at]
                score = best[t + 1 - lengths[piece], row] + values[piece]
                better = score > best[t + 1, row]
                best[t + 1, row[better]] = score[better]
                back[t + 1, row[better]] = piece[better]
                at = a.out[at]
            # a character that is no piece by itself may be passed over
            bare = np.flatnonzero(a.piece[a.step(np.zeros_like(state), code)] < 0)
            if len(bare):
                score = best[t, bare] + values[-1]
                better = score > best[t + 1, bare]
                best[t + 1, bare[better]] = score[better]
                back[t + 1, bare[better]] = -1
        ids: list[list[int]] = []
        for c in range(n):
            found: list[int] = []
            end = len(chunks[c])
            while end:
                piece = int(back[end, c])
                step = int(lengths[piece])
                if piece >= 0:
                    found.append(piece)
                elif self.bytes:
                    found += [self.bytes[x] for x in reversed(chunks[c][end - 1].encode("utf-8", "surrogatepass"))]
                elif not found or found[-1] != self.unknown:      # a run of unknown characters is one id
                    found.append(self.unknown)
                end -= step
            ids.append(found[::-1])
        return ids

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of id ranges that end at ``ends`` (control ids give nothing)."""
        parts = self._parts
        out, lo = [], 0
        prefix = 1 if self.prefix else 0
        for hi in ends.tolist():
            raw = b"".join([parts[i] for i in ids[lo:hi].tolist()])
            text = raw.decode("utf-8", "replace").replace(MARK, " ")
            out.append(text[prefix:] if text.startswith(" ") else text)
            lo = hi
        return out

    @property
    def _parts(self) -> list[bytes]:
        if not hasattr(self, "_part_list"):
            number = {i: b for b, i in self.bytes.items()}
            self._part_list = [bytes([number[i]]) if i in number else b"" if self.kinds[i] == _CONTROL
                               else " \u2047 ".encode() if i == self.unknown else p.encode() for i, p in enumerate(self.pieces)]
        return self._part_list


class Encoder:
    """Ids of whole texts: chunks are encoded once, texts are gathered."""

    def __init__(self, path: str):
        self.model = Model(path)
        self.cache = WordIds(self.model.best, [])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each text)."""
        escaped = pc.replace_substring(large(texts), " ", MARK)
        if self.model.prefix:
            escaped = pc.if_else(pc.equal(pc.binary_length(escaped), 0), escaped, pc.binary_join_element_wise(pa.scalar(MARK, pa.large_string()), escaped, pa.scalar("", pa.large_string())))
        at, chunks = _chunks(escaped)
        return self.cache.of_words(at, chunks.dictionary_encode())


def _chunks(escaped: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(start of each text's chunks and the end, chunks) of large strings: a border stands before each
    run of blank marks."""
    ends = np.frombuffer(escaped.buffers()[1], np.int64, len(escaped) + 1, escaped.offset * 8)
    raw = escaped.buffers()[2]
    data = np.frombuffer(raw, np.uint8, int(ends[-1])) if raw is not None and ends[-1] else np.zeros(0, np.uint8)
    a, b, c = MARK.encode()
    mark = np.flatnonzero((data[:-2] == a) & (data[1:-1] == b) & (data[2:] == c)) if len(data) > 2 else np.zeros(0, np.int64)
    mark = mark[mark >= ends[0]]
    borders = np.union1d(ends, mark[np.append(True, np.diff(mark) != 3)[:len(mark)]])
    chunks = pa.Array.from_buffers(pa.large_string(), len(borders) - 1, [None, pa.py_buffer(borders.astype(np.int64).tobytes()), raw or pa.py_buffer(b"")])
    return np.searchsorted(borders, ends), chunks


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


_CODED = "doc_id long, ids array<int>, round_trip boolean"


def _coded(model: str, back: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(model)
        for b in batches:
            for lo, hi in slices(b.column(1), 2 << 20):
                texts = b.column(1).slice(lo, hi - lo)
                ids, count = code(texts)
                at = np.append(0, np.cumsum(count))
                cols = [b.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))]
                if back:
                    want = pc.replace_substring(large(texts), MARK, " ")
                    cols.append(pc.equal(pa.array(code.model.decode(ids, at[1:]), want.type), want))
                yield pa.RecordBatch.from_arrays(cols, [f.split()[0] for f in _CODED.split(", ")][:len(cols)])

    return run


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id and ids of the best segmentation of every whole text."""
    ship(docs.sparkSession)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(_coded(model, False), "doc_id long, ids array<int>"))


def encode_and_decode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids, and whether decoding the ids gave the text back (blank marks in a text come
    back as blanks: the model's format cannot tell them apart)."""
    ship(docs.sparkSession)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(_coded(model, True), _CODED))


def decode(coded: DataFrame, model: str) -> DataFrame:
    """doc_id and text of every row of (doc_id, ids); a NULL list gives the empty text."""
    ship(coded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(model).model
        for b in batches:
            count = np.asarray(pc.fill_null(pc.list_value_length(b.column(1)), 0), np.int64)
            texts = code.decode(np.asarray(b.column(1).flatten()), np.cumsum(count))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


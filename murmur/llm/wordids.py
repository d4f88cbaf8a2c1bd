"""Token ids of whole texts through a per-process cache of words.

A tokenizer whose pre-tokenizer drops white space encodes every run of non-blank
characters on its own.  Arrow splits a slice of texts and numbers its distinct words,
each word is encoded once per worker, and numpy gathers the ids of the texts.
The cache is emptied when it holds ``LIMIT`` words, which bounds its memory and changes
no result.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from murmur.llm.common import gather

LIMIT = 400_000
SLICE_BYTES = 8 << 20


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of a string column of about ``limit`` bytes each (one text at least)."""
    size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64))
    lo = 0
    while lo < len(size):
        hi = int(np.searchsorted(size, (size[lo - 1] if lo else 0) + limit, "right"))
        hi = max(hi, lo + 1)
        yield lo, hi
        lo = hi


def large(texts: pa.Array) -> pa.Array:
    """A string column as large strings of its own memory, NULL as empty.

    (Arrow's string functions go astray on a cast slice whose offsets start above zero.)
    """
    none = pa.array([], pa.large_string())
    return pc.fill_null(pa.concat_arrays([texts.cast(pa.large_string()), none]), "")


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """(start of each text's words and the end, dictionary-encoded words) of a string column.

    Words are the runs between ASCII white space; an empty word may stand at the ends.
    """
    listed = pc.ascii_split_whitespace(large(texts))
    at = np.asarray(listed.offsets, np.int64)
    return at - at[0], listed.flatten().dictionary_encode()


class _Index(dict):
    """word -> position in the cache; new words are queued for encoding."""

    def __init__(self):
        super().__init__({"": 0})
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        at = self[word] = len(self) + 1       # 0: the empty word, 1: the end of a document
        self.new.append(word)
        return at


class WordIds:
    """Ids of texts, each followed by ``end``; ``encode`` gives the ids of each of a list of words."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], end: list[int]):
        self.encode, self.end = encode, end
        self._clear()

    def _clear(self) -> None:
        self.index = _Index()
        self.flat = np.array(self.end, np.uint32)
        self.starts = np.zeros(2, np.int64)
        self.lengths = np.array([0, len(self.end)], np.int64)

    def _add(self) -> None:
        ids = self.encode(self.index.new)
        self.index.new = []
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        self.starts = np.append(self.starts, len(self.flat) + np.cumsum(lengths) - lengths)
        self.lengths = np.append(self.lengths, lengths)
        self.flat = np.append(self.flat, np.fromiter((x for w in ids for x in w), np.uint32, int(lengths.sum())))

    def of_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids of each text)."""
        return self.of_words(*split_words(texts))

    def places(self, words: list[str]) -> np.ndarray:
        """Position of each word in ``starts`` and ``lengths``."""
        if len(self.index) > LIMIT:
            self._clear()
        index = self.index
        place = np.fromiter([index[w] for w in words], np.int64, len(words))
        if index.new:
            self._add()
        return place

    def of_words(self, at: np.ndarray, words: pa.DictionaryArray) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts given by their words: start of each text's words and the end, words."""
        place = self.places(words.dictionary.to_pylist())
        each = place[np.asarray(words.indices)] if len(words) else np.zeros(0, np.int64)
        each = np.insert(each, at[1:], 1)
        lengths = self.lengths[each]
        ids = self.flat[gather(self.starts[each], lengths)]
        done = np.append(0, np.cumsum(lengths))[at[1:] + np.arange(1, len(at))]
        return ids, np.diff(np.append(0, done))


def _byte_letters() -> dict[int, str]:
    """Printable stand-ins of the 256 bytes, as byte-level vocabularies write them."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_cached: dict[tuple, WordIds] = {}


def tokenizers_word_ids(path: str) -> WordIds:
    """Ids by the ``tokenizers`` library's file at ``path``; id 0 ends a document.

    A word of letters (with one full stop or comma behind at most) is one run of the
    pre-tokenizer, so the library's BPE model takes it at once; any other word
    goes through the whole tokenizer.
    """
    if ("tokenizers", path) in _cached:
        return _cached["tokenizers", path]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    model, letters = tok.model, _byte_letters()
    marks = {m: tok.encode(m, add_special_tokens=False).ids for m in ".,"}

    def encode(word: str) -> list[int]:
        core, mark = (word[:-1], marks[word[-1]]) if word[-1] in marks else (word, [])
        if core.isalpha():
            if core.isascii():
                return [t.id for t in model.tokenize(core.lower())] + mark
            low = "".join(map(str.lower, core))
            if low.isalpha() and unicodedata.is_normalized("NFC", core) and unicodedata.is_normalized("NFC", low):
                return [t.id for t in model.tokenize("".join(letters[b] for b in low.encode()))] + mark
        return tok.encode(word, add_special_tokens=False).ids

    _cached["tokenizers", path] = WordIds(lambda words: [encode(w) for w in words], [0])
    return _cached["tokenizers", path]

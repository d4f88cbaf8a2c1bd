"""Best-fit packing: ids against the tokenizer itself, whole cover, number of sequences."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from murmur.llm import packing
from murmur.llm.wordids import tokenizers_word_ids
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(tok, text):
    return np.array(tok.encode(text or "", add_special_tokens=False).ids + [0], "<u4")


def check_whole(rows, texts, size=2048):
    tok = Tokenizer.from_file(PATH)
    want = []
    for doc, text in texts:
        ids = ids_of(tok, text)
        for k in range(0, len(ids), size):
            want.append((doc, k // size, k, len(ids[k:k + size]), zlib.crc32(ids[k:k + size].tobytes())))
    key = lambda r: (r[0] is None, *(x or 0 for x in r))
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=key) == sorted(want, key=key)
    seqs = defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= size
    return len(seqs)


def test_whole_table(spark):
    t = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pydict()
    rows = packing.pack(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), PATH).collect()
    n = check_whole(rows, list(zip(t["doc_id"], t["text"])))
    assert n <= -(-sum(r["length"] for r in rows) // 2048) * 1.03 + 1


def test_nulls_empty_odd_and_long_texts(spark):
    odd = "don't it's we'll A.B. ...x, é É.  <|endoftext|> <|ENDOFTEXT|> İstanbul ΣΑΣ, 12,5 3. ½. 你好. नमस्ते ß ﬁx, \x1cq ẞ Å, K"
    texts = [(1, None), (2, ""), (3, " \n"), (4, odd), (5, "word " * 9000), (5, "word " * 9000), (None, "x y")]
    df = spark.createDataFrame([(*r, 0) for r in texts], "doc_id long, text string, sequence_id int")
    check_whole(packing.pack(df, PATH).collect(), texts)
    assert packing.pack(df.limit(0), PATH).collect() == []


def test_rows_without_id_and_long_documents_are_dealt_evenly(spark):
    """One key holds nearly all pieces; every packer gets its share."""
    texts = [(None, f"row {i % 7}") for i in range(900)] + [(8, "word " * 2048 * 120)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    rows = packing.pack(df, PATH, per_packer=100).collect()
    check_whole(rows, texts)
    of_packer = defaultdict(int)
    for r in rows:
        of_packer[r["sequence_id"] >> 40] += 1
    assert len(of_packer) == -(-len(rows) // 100) and max(of_packer.values()) <= 130


def test_cache_reset_changes_nothing(monkeypatch):
    words = tokenizers_word_ids(PATH)
    texts = pa.array(["alpha beta, gamma.", None, "delta alpha"])
    first = words.of_texts(texts)
    monkeypatch.setattr("murmur.llm.wordids.LIMIT", 1)
    again = words.of_texts(texts)
    assert [x.tolist() for x in first] == [x.tolist() for x in again]


def test_sum_of_squares_rule():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 21, 400)
    seq, offset, n = packing.sum_of_squares(lengths, 20)
    fill = defaultdict(int)
    for s, o, length in zip(seq, offset, lengths):
        before = defaultdict(int)
        for f in fill.values():
            if f < 20:
                before[20 - f] += 1

        def after(gap):
            n = defaultdict(int, before)
            if gap < 20:
                n[gap] -= 1
            if gap > length:
                n[gap - length] += 1
            return sum(v * v for v in n.values())

        options = {g: after(g) for g in [*(g for g in before if g >= length), 20]}
        assert o == fill[s] and options[20 - fill[s]] == min(options.values())
        fill[s] += int(length)
    assert len(fill) == n

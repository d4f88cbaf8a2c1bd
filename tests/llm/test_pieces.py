"""SentencePiece by Aho-Corasick and Viterbi: against the library with the same pieces, brute
force, and round trips."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from murmur.llm import pieces
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("piece_bpe_32k.model")


def ids_of(texts):
    ids, count = pieces.encoder(PATH)(pa.array(texts, pa.string()))
    at = np.append(0, np.cumsum(count))
    return [ids[a:b].tolist() for a, b in zip(at, at[1:])]


def test_never_worse_than_the_library_over_the_same_pieces():
    """The library's unigram encoder adds scores as 32-bit floats and so may miss the best sum."""
    proto = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    lib = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    t = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pydict()["text"]
    lines = [x for text in t for x in text.split("\n")][:1500] + ["", "a", "Hello world", "naïve ﬁ Ünïcode"]
    score = lambda ids: sum(proto.pieces[i].score for i in ids)
    same = 0
    for mine, x in zip(ids_of(lines), lines):
        theirs = lib.encode(x)
        assert score(mine) >= score(theirs) and lib.decode(mine) == lib.decode(theirs)
        same += mine == theirs
    assert same > 500


def test_best_score_against_plain_viterbi():
    model = pieces.encoder(PATH).model
    table = {p: (i, model.scores[i]) for i, p in enumerate(model.pieces) if model.kinds[i] == 1}
    lines = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pydict()["text"][:40]
    words = sorted({"▁" + w for x in lines for w in x.split()})[:800]
    for chunk in (*words, "▁the", "▁▁▁▁x", "▁an\nthe日本🙂the", "▁", "x" * 40, "▁Donaudampfschifffahrt", "\x00"):
        best = [0.0] + [-np.inf] * len(chunk)
        for j in range(1, len(chunk) + 1):
            for i in range(max(0, j - 16), j):
                if chunk[i:j] in table:
                    best[j] = max(best[j], best[i] + table[chunk[i:j]][1])
            if chunk[j - 1] not in table:
                best[j] = max(best[j], best[j - 1] + model.missing)
        ids = model.best([chunk])[0]
        raw = b"".join(model._parts[i] for i in ids).decode()
        uncovered = sum(c not in table for c in chunk)
        assert raw == chunk
        got = sum(model.scores[i] for i in ids if model.kinds[i] == 1) + uncovered * model.missing
        assert abs(got - best[-1]) < 1e-3


def test_edges_and_round_trip(spark):
    odd = ["", None, " ", "   ", "  two  blanks   three ", "a\nb\t c\r\n", "你好 world 🙂 é\x00x ﷐ y", "▁already ▁▁marked", "x" * 100_000, "ab " * 60_000]
    rows = list(enumerate(odd)) + [(3, "   "), (None, "null id")]
    df = spark.createDataFrame([(*r, [1]) for r in rows], "doc_id long, text string, ids array<int>")
    coded = pieces.encode_and_decode(df, PATH)
    out = coded.collect()
    assert len(out) == len(rows) and all(r["round_trip"] for r in out)
    assert sorted((r["doc_id"] is None, r["doc_id"], r["text"]) for r in pieces.decode(coded, PATH).collect()) == sorted(
        (d is None, d, (t or "").replace("▁", " ")) for d, t in rows)
    assert [r["ids"] for r in out if r["doc_id"] in (0, 1)] == [[], []]
    assert pieces.encode(df.limit(0), PATH).collect() == [] and pieces.decode(coded.limit(0), PATH).collect() == []


def test_every_noncharacter(spark):
    """No character is free to stand for a border."""
    odd = "".join(map(chr, range(0xFDD0, 0xFDF0))) + " a\u2581\u2581b " + "".join(chr(0x10000 * k + 0xFFFF) for k in range(1, 17)) + "\u2581"
    df = spark.createDataFrame([(i, odd * (i + 1)) for i in range(3)] + [(7, "\u2581"), (8, "plain text")], "doc_id long, text string")
    out = {r["doc_id"]: r for r in pieces.encode_and_decode(df, PATH).collect()}
    assert len(out) == 5 and all(r["round_trip"] for r in out.values())
    alone = pieces.encode(df.filter("doc_id = 8"), PATH).first()["ids"]
    assert out[8]["ids"] == alone


def test_whole_table_round_trip(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert pieces.encode_and_decode(df, PATH).filter("not round_trip").count() == 0


def test_automaton_reports_every_piece_that_ends_at_a_position():
    a = pieces.Automaton.build([(p, i) for i, p in enumerate(["a", "ab", "bab", "bc", "bca", "c", "caa", "z"])])
    state, found = 0, []
    for c in "abccabz":
        state = int(a.step(np.array([state]), np.array([a.letters.get(c, 0)]))[0])
        at, here = (state if a.piece[state] >= 0 else a.out[state]), []
        while at:
            here.append(int(a.piece[at]))
            at = a.out[at]
        found.append(here)
    assert found == [[0], [1], [3, 5], [5], [0], [1], [7]]

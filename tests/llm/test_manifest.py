"""Merkle manifest: every column against a plain recursion, at several chunk heights."""

import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from murmur.llm import manifest
from murmur.llm.queries import _today

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, grp int, pos double, salt int"


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return H(*(field(x) for x in (r[0], r[3], r[2], r[4], text)))


def climb(nodes, i, digest):
    """(root, root with ``digest`` in place i, siblings of the way)"""
    sib = ""
    while len(nodes) > 1:
        lo = i // 8 * 8
        run = nodes[lo:lo + 8]
        sib += "".join(run[:i - lo] + run[i - lo + 1:])
        digest = H(*run[:i - lo], digest, *run[i - lo + 1:])
        nodes = [H(*nodes[k:k + 8]) for k in range(0, len(nodes), 8)]
        i //= 8
    return nodes[0], digest, sib


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        groups[r[2]].append((r[0], leaf(r, r[1]), leaf(r, lower(r[1]) if hit else r[1])))
    for g in groups.values():
        g.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    subs = [climb([x[1] for x in groups[g]], 0, "")[0] for g in langs]
    out = []
    for k, g in enumerate(langs):
        nodes = [x[1] for x in groups[g]]
        for i, (d, own, now) in enumerate(groups[g]):
            _, folded, sib = climb(nodes, i, now)
            root, folded, more = climb(subs, k, folded)
            out.append((d, own, subs[k], root, H(sib + more), folded, folded == root))
    return sorted(out, key=str)


def made():
    rows = [(i, f"Text {i} İÄ Ñ", "en", f"src{i % 3}", i) for i in range(1, 601)]
    rows += [(i, "ABC" if i % 2 else None, "de", None, None) for i in range(1000, 1009)]
    rows += [(2000, "Lone", None, "s", 4), (2001, "", "", "s", 0), (2002, "X", "", "s", 1), (2003, "x" * 300_000 + "Z", "été", "", -5)]
    rows += [(None, "No Id", "en", "s", 1), (None, "Another", "en", "s", 2), (7, "Text again", "en", "s", 3), (7, "Text again", "en", "s", 3)]
    rows += [(3000 + i, "One of a kind", f"l{i}", "s", i) for i in range(12)]
    return rows


@pytest.mark.parametrize("height", [1, 2, 4])
def test_brute_force(spark, height):
    rows = made()
    docs = spark.createDataFrame([(*r, "clash", 1, 0.5, 3) for r in rows], SCHEMA).repartition(5)
    out = manifest.manifest(docs, now={"text": _today(F.col("doc_id"), F.col("text"))}, height=height)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == brute(rows)
    assert {v for *_, v in got} == {True, False}


def test_one_row_repeated_and_unchanged(spark):
    rows = [(5, "same", "en", "s", 4)] * 700 + [(i, "other", "en", "s", 5) for i in range(300)]
    docs = spark.createDataFrame([(*r, "", 0, 0.0, 0) for r in rows], SCHEMA)
    out = manifest.manifest(docs, height=1, siblings=True).collect()
    assert len(out) == 1000 and all(r["verified"] for r in out) and len({r["root"] for r in out}) == 1
    assert all(H(*r["proof"]) == r["proof_sha256"] and [len(x) for x in r["proof"]][:1] == [7 * 64] for r in out)


def test_empty_and_lone(spark):
    docs = spark.createDataFrame([(1, "A", "en", "s", 1, "", 0, 0.0, 0)], SCHEMA)
    assert manifest.manifest(docs.limit(0)).collect() == []
    r = manifest.manifest(docs).collect()[0]
    assert r["leaf"] == r["subroot"] == r["root"] == r["folded_root"] and r["verified"] and r["proof_sha256"] == H("")


def test_fold_resumes_with_the_right_siblings_only():
    digests = [H(str(i)).encode() for i in range(20)]
    tree = manifest.Tree(digests, 2, 8)
    assert tree.root.decode() == climb([d.decode() for d in digests], 0, "")[0]
    for i in (0, 7, 8, 19):
        tree.left = None               # nothing to the left is read again
        assert tree.fold(i, b"new").decode() == climb([d.decode() for d in digests], i, "new")[1]

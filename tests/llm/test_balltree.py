"""Ranked lexical search: against a plain scorer, the tree's bounds, pruning, edge rows."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from murmur.llm import balltree

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    found = [(d, c) for d, t in docs if (c := Counter(terms(t)))]
    n, words = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(terms(t))
    out = []
    for i, q in asked.items():
        scored = []
        for d, c in found:
            m = 10 + 90 * sum(c.values()) * n // words
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in q if c[t])
            if s:
                scored.append((-s, d is None, d or 0, d))
        out += [(i, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def made(seed=3, documents=700):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["Été", "ñ", "İstanbul", "don't", "a_b", "x\ty"]
    skew = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, skew, k=rng.randint(1, 60)))) for i in range(documents)]
    docs += [(1000 + i, docs[5][1]) for i in range(30)]                    # ties
    docs += [(None, docs[6][1]), (2000, None), (2001, ""), (2002, " ., "), (7, docs[8][1]), (7, "w1 other"), (2003, "w2 " * 60_000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 20)))) for i in range(60)]
    items += [(70, docs[5][1]), (71, None), (72, ""), (73, "nowhere"), (None, "w1 w2"), (None, "w3"), (5, "w9 W10"), (74, "w0 " * 9000)]
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame([(*d, 1, 2, "x") for d in docs], "doc_id long, text string, score int, rank int, terms string").repartition(4),
            spark.createDataFrame([(*i, "y", 0) for i in items], "item_id long, text string, doc_id string, n int"))


@pytest.mark.parametrize("limits", [(200, 12_000, 400_000, 4096), (7, 40, 90, 50)])
def test_brute_force(spark, monkeypatch, limits):
    for name, value in zip(("ITEMS", "PAIRS", "VOCABULARY", "DOCUMENTS"), limits):
        monkeypatch.setattr(balltree, name, value)
    docs, items = made()
    got = sorted((tuple(r) for r in balltree.rank(*frames(spark, docs, items)).collect()), key=str)
    assert got == brute(docs, items)


def test_empty_tables(spark):
    docs, items = frames(spark, *made(documents=20))
    assert balltree.rank(docs.limit(0), items).collect() == []
    assert balltree.rank(docs, items.limit(0)).collect() == []
    assert balltree.rank(docs.filter("doc_id > 2000 and doc_id < 2003"), items).collect() == []


def sparse(seed, rows, size):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(0, 20, rows)
    ids = np.concatenate([rng.choice(size, n, replace=False) for n in lengths])
    return np.concatenate([[0], np.cumsum(lengths)]), ids, rng.integers(1, 1_000_000, len(ids))


def test_bounds_hold_in_every_node():
    starts, ids, values = sparse(1, 500, 80)
    tree = balltree.BallTree(starts, ids, values.astype(float), 80, leaf=8)
    dense = np.zeros((500, 80))
    dense[np.repeat(np.arange(500), np.diff(starts)), ids] = values
    queries = (np.random.default_rng(2).random((80, 30)) < 0.2).astype(float)
    for node, (lo, hi, left, right) in enumerate(tree.nodes):
        best = (dense[tree.rows[lo:hi]] @ queries).max(axis=0)
        assert (tree.bounds(node, queries, np.sqrt(queries.sum(axis=0))) >= best).all()
        assert (left < 0) == (right < 0) == (hi - lo <= 8)
    assert sorted(tree.rows) == list(range(500))


def test_half_of_the_scores_are_left_out_in_a_corpus():
    """Documents of the test table against its benchmark items."""
    import pyarrow.parquet as pq
    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pydict()["text"]]
    items = [set(terms(t)) for t in pq.read_table("/root/testdata/sf0.01/benchmark.parquet").to_pydict()["text"]]
    number = {t: i for i, t in enumerate(sorted(set().union(*items)))}
    rows = [[(number[w], c) for w, c in Counter(terms(t)).items() if w in number] for t in texts]
    ids, tf = (np.array([x[k] for r in rows for x in r]) for k in (0, 1))
    df = np.bincount(ids, minlength=len(number))
    queries = np.zeros((len(number), len(items)), np.int64)
    for q, x in enumerate(items):
        queries[[number[t] for t in x], q] = 1
    weights = np.array([balltree.weight(len(texts), int(n)) for n in df])
    best = balltree.Best(len(items), 10)
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    scored = balltree.search(np.arange(len(rows)), starts, ids, 10**9 * tf // (1000 * tf + 800), weights, queries, best)
    assert scored < 0.6 * len(rows) * len(items), scored / (len(rows) * len(items))


def test_subtrees_are_left_out():
    """Two far clusters: queries about one leave the other's subtrees unscored."""
    starts = np.arange(0, 2001 * 4, 4)
    ids = np.concatenate([np.tile([0, 1, 2, 3], 1000), np.tile([4, 5, 6, 7], 1000)])
    values = np.random.default_rng(0).integers(900_000, 1_000_000, 8000)
    queries = np.zeros((8, 2), np.int64)
    queries[:4, 0] = queries[4:, 1] = 1
    best = balltree.Best(2, 10)
    scored = balltree.search(np.arange(2000), starts, ids, values, np.full(8, 50), queries, best)
    assert scored < 2 * 2000 * 0.6
    sums = values.reshape(2000, 4).sum(axis=1) * 50
    for q in (0, 1):
        part = np.arange(1000) + 1000 * q
        assert best.doc[q].tolist() == part[np.lexsort((part, -sums[part]))][:10].tolist()

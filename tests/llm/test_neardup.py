"""Embedding near-dedup against brute force: links, components, recall of the index."""

import numpy as np
import pyarrow.parquet as pq

from murmur.llm import neardup


def brute(rows, threshold=0.98):
    """rows: (id, vector, label) -> {id: (links, component)}; ids are distinct."""
    good = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = (label, np.array(v) / np.linalg.norm(v))
    out = {i: (0, i) for i, _, _ in rows}
    comp = {i: i for i in good}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    links = dict.fromkeys(good, 0)
    ids = sorted(good)
    for a in ids:
        for b in ids:
            if a != b and good[a][0] == good[b][0] and len(good[a][1]) == len(good[b][1]) and good[a][1] @ good[b][1] >= threshold:
                links[a] += 1
                x, y = sorted((root(a), root(b)))
                comp[y] = x
    out.update({i: (links[i], root(i)) for i in good})
    return out


def got(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in df.collect()}


def test_whole_table(spark):
    t = pq.read_table("/root/testdata/sf0.01/embeddings.parquet").to_pydict()
    want = brute(list(zip(t["vec_id"], t["embedding"], t["label"])))
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert got(neardup.near_duplicates(df)) == want
    assert got(neardup.near_duplicates(df, target_recall=1.0, per_cell=4)) == want


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 4, 16))
    x = base[rng.integers(0, len(base), n)] + rng.normal(size=(n, 16)) * 0.09
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_recall_against_brute_force(spark):
    x = clustered(1200, 2)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    want = brute(rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = got(neardup.near_duplicates(df, per_cell=8))
    total = sum(n for n, _ in want.values())
    assert total > 500 and all(found[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _ in found.values()) >= 0.99 * total
    assert got(neardup.near_duplicates(df, per_cell=8, target_recall=1.0)) == want


def test_edges_and_copies(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0, 0.5], 1) for i in range(40, 20, -1)] + [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0, 0.0], 1), (4, [0.0, 0.0, 0.0], 1), (5, [nan, 1.0, 1.0], 1), (6, [None, 1.0, 1.0], 1),
        (7, [inf, 1.0, 1.0], 1), (8, [1.0, 0.0, 0.5], None), (9, [1.0, 0.0, 0.5], 2), (10, [2e200, 0.0, 1e200], 1),
        (11, [1.0, 0.0], 1), (12, [1.0, 0.0], 1), (13, [5.0], 3), (14, [2.0], 3), (15, [-2.0], 3), (16, [1.0, 0.01, 0.5], 1)]
    df = spark.createDataFrame([(*r, True) for r in rows], "vec_id long, embedding array<double>, label int, kept boolean")
    scaled = [(i, [x / 1e200 for x in v] if i == 10 else v, b) for i, v, b in rows]
    assert got(neardup.near_duplicates(df)) == brute(scaled)
    assert {r["vec_id"]: r["kept"] for r in neardup.near_duplicates(df).collect()} == {i: i == c for i, (_, c) in brute(scaled).items()}
    assert neardup.near_duplicates(df.limit(0)).collect() == []
    one = neardup.near_duplicates(spark.createDataFrame([(None, [1.0], 1)], df.drop("kept").schema)).collect()
    assert [tuple(r) for r in one] == [(None, 0, None, True)]


def test_cells_longer_than_a_block(spark):
    rng = np.random.default_rng(9)
    a, b = rng.normal(size=8), rng.normal(size=8)
    x = np.concatenate([a + rng.normal(size=(2600, 8)) * 0.002, b + rng.normal(size=(300, 8)) * 0.002])
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert got(neardup.near_duplicates(df, per_cell=3000)) == {
        i: (2599, 0) if i < 2600 else (299, 2600) for i in range(2900)}


def test_multi_sequence_order():
    a, b = [0.0, 0.2, 0.5], [0.0, 0.1, 0.9]
    cells = neardup._multi_sequence(a, b, [2, 0, 1], [1, 2, 0], 0.65, 3)
    all_cells = sorted((x + y, p * 3 + q) for x, p in zip(a, [2, 0, 1]) for y, q in zip(b, [1, 2, 0]) if x + y <= 0.65)
    assert cells == [c for _, c in all_cells]

"""SimHash near-dedup against brute force."""

import numpy as np
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import functions as F

from murmur.llm import simhash
from murmur.llm.common import Labels
from tests.conftest import SF_SMALL


def brute_fp(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    sh = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, bits=3):
    """rows: (id, fp) -> {id: smallest id reachable}."""
    ids, fps = [r[0] for r in rows], np.array([r[1] for r in rows], np.uint64)
    lab = Labels(len(ids))
    order = np.argsort(ids, kind="stable")
    fps = fps[order]
    for i in range(len(ids)):
        j = np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= bits)
        lab.join(np.full(len(j), i), j)
    return {ids[order[i]]: ids[order[lab.root[i]]] for i in range(len(ids))}


def got(df):
    return {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in df.collect()}


def test_whole_table_matches_brute_force(spark):
    t = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pydict()
    rows = [(d, brute_fp(x)) for d, x in zip(t["doc_id"], t["text"])]
    want = brute_components(rows)
    res = got(simhash.simhash_groups(spark.read.parquet(f"{SF_SMALL}/documents.parquet")))
    assert {d: v[0] for d, v in res.items()} == {d: f"{fp:016x}" for d, fp in rows}
    assert {d: v[1] for d, v in res.items()} == want
    assert any(d != c for d, c in want.items())


def test_nulls_empty_short_and_long_texts(spark):
    long = " ".join(f"w{i % 997}x{i}" for i in range(70_000))
    rows = [(1, None, "a"), (2, "", "b"), (3, " \t\n", "c"), (4, "One two", "d"), (5, "one TWO", "e"),
            (6, long, "f"), (7, long, None), (None, "one two", "g"), (9, "É É É", "h"), (9, "É É É", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    res = {}
    for r in simhash.simhash_groups(df).collect():
        res.setdefault(r["doc_id"], []).append((r["fingerprint"], r["component_id"]))
    assert [res[i][0][1] for i in (1, 2, 3)] == [1, 1, 1] and res[1][0][0] == "0" * 16
    assert res[4][0] == res[5][0] == (f"{brute_fp('one two'):016x}", 4) and res[None][0][1] == 4
    assert res[6][0] == res[7][0] == (f"{brute_fp(long):016x}", 6)
    assert len(res[9]) == 2 and res[9][0] == (f"{brute_fp('É É É'):016x}", 9)
    kept = simhash.simhash_dedup(df)
    assert kept.columns == df.columns and sorted(r[0] for r in kept.collect()) == [1, 4, 6, 9, 9]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_groups(df).collect() == [] and simhash.simhash_dedup(df).collect() == []


def test_index_finds_every_component_in_runs_longer_than_a_block(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    fps = [int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 6), replace=False))
           for b in base for _ in range(3500)]
    fps = sorted({*fps, *rng.integers(0, 1 << 63, 3000, dtype=np.uint64).tolist()})
    want = brute_components(list(enumerate(fps)))
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(i, x) for i, x in enumerate(signed)], "doc_id long, fp long")
    lab = Labels(len(fps))
    at = {x: i for i, x in enumerate(signed)}
    for r in simhash.links(df.select("fp")).collect():
        lab.join(np.array([at[r["u"]]]), np.array([at[r["v"]]]))
        assert bin((r["u"] ^ r["v"]) & (1 << 64) - 1).count("1") <= 60
    assert {i: int(lab.root[i]) for i in range(len(fps))} == want


def test_gray_rank_orders_neighbours_one_bit_apart(spark):
    x = spark.range(256).select((F.col("id").bitwiseXOR(F.shiftright("id", 1))).alias("x"))
    rows = x.select("x", simhash._gray_rank(F.col("x")).alias("r")).orderBy("r").collect()
    assert [r["r"] for r in rows] == list(range(256))
    assert all(bin(a["x"] ^ b["x"]).count("1") == 1 for a, b in zip(rows, rows[1:]))


def test_one_row_of_each_group_also_without_ids(spark):
    copy, other, third = (" ".join(f"{c}{i}" for i in range(40)) for c in "abc")
    rows = [(None, copy, 1), (7, copy, 2), (3, copy, 3), (3, copy, 4), (None, other, 5), (None, other, 6), (None, third, 7), (9, "alone", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(3)
    kept = simhash.one_of_each_group(df)
    assert kept.columns == df.columns
    got = sorted((r["text"], r["doc_id"]) for r in kept.collect())
    assert got == sorted([(copy, 3), (other, None), (third, None), ("alone", 9)])
    assert simhash.one_of_each_group(df.limit(0)).collect() == []


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b c", 33, "k", 1), (2, "a b c", 34, "l", 2), (3, "x y z", 35, "m", 3)],
                               "doc_id long, text string, _row int, row string, Key int")
    want = [(1, "a b c", 33, "k", 1), (3, "x y z", 35, "m", 3)]
    for out in (simhash.one_of_each_group(df), simhash.simhash_dedup(df)):
        assert out.columns == df.columns and sorted(tuple(r) for r in out.collect()) == want

"""Quality rules: held-out accuracy, the compiled column against a plain evaluation, edge rows."""

import math
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from murmur.llm import rules

SF = "/root/testdata/sf0.1"


def by_hand(model, row):
    total = model.base
    for r in model.rules:
        if all(row[s] > t if above else row[s] <= t for s, above, t in r.conditions):
            total += r.weight
    return 1 / (1 + math.exp(-total))


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r["doc_id"]: r for r in rules.quality(docs, labels).collect()}
    assert len(rows) == docs.count()
    l = pq.read_table(f"{SF}/labels.parquet").to_pydict()
    hits = {(t, p): 0 for t in (0, 1) for p in (0, 1)}
    for d, good in zip(l["doc_id"], l["quality"]):
        r = rows[d]
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if r["held_out"]:
            hits[good, r["predicted"]] += 1
    assert hits[1, 1] >= 0.99 * (hits[1, 0] + hits[1, 1]), hits
    assert hits[0, 0] >= 0.95 * (hits[0, 0] + hits[0, 1]), hits


def texts(n):
    rng = random.Random(1)
    out = []
    for i in range(n):
        words = [rng.choice(["ka", "lomi", "neru", "ta", "sovi", "hejo"]) + rng.choice("abcdefgh") for _ in range(rng.randint(5, 80))]
        good = i % 4 != 0
        if not good:
            words = [w + "%%" for w in words] if i % 8 == 0 else [words[0]] * len(words)
        out.append((i, " ".join(words), int(good)))
    return out


def frames(spark, made, extra=()):
    docs = spark.createDataFrame([(i, t, "x", 0.5, 3.0) for i, t, _ in made] + [(*e, "y", 0.1, 1.0) for e in extra],
                                 "doc_id long, text string, lang string, score double, word_bytes double")
    return docs, spark.createDataFrame([(i, g) for i, _, g in made] + [(4, 0), (900, None), (None, 1)], "doc_id long, quality int")


def test_edges_and_compiled_column(spark):
    made = texts(300)
    extra = [(900, None), (901, ""), (902, " \n"), (903, "ka%% " * 60_000), (None, "lomi ta"), (7, made[7][1]), (904, "\x00 \U0001F600 é")]
    docs, labels = frames(spark, made, extra)
    got = rules.quality(docs, labels).collect()
    assert len(got) == len(made) + len(extra)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert sum(by[i][0]["predicted"] == g for i, _, g in made) >= 295
    assert by[903][0]["predicted"] == 0 and by[None][0]["held_out"] is False and len(by[7]) == 2
    assert all(by[i][0]["score"] is not None for i in (900, 901, 902, 904))
    model = rules.train(docs, labels)
    assert model.rules and all(str(r) for r in model.rules)
    for r in rules.statistics(docs).withColumn("found", model.column()).collect():
        assert math.isclose(r["found"], by_hand(model, r), rel_tol=1e-9)


def test_without_labels_or_rows(spark):
    docs, labels = frames(spark, texts(40))
    assert {r["score"] for r in rules.quality(docs, labels.limit(0)).collect()} == {0.5}
    assert {r["predicted"] for r in rules.quality(docs, labels.filter("quality = 0")).collect()} == {0}
    assert rules.quality(docs.limit(0), labels).collect() == []


def test_statistics_of_the_whole_text():
    s = dict(zip(rules.STATISTICS, rules.statistics_of("Ab ab ab | 12\nAb ab ab | 12\n!?%% é.".encode())))
    n = len("Ab ab ab | 12\nAb ab ab | 12\n!?%% é.".encode())
    assert s["upper_share"] == 2 / 12 and s["digit_share"] == 4 / n and s["symbol_share"] == 4 / n and s["shout_share"] == 2 / n
    assert s["stop_share"] == 1 / n and s["other_share"] == 2 / n and s["distinct_words"] == 6 / 12 and s["repeated_words"] == 2 / 12
    assert s["top_word"] == 4 / 12 and s["bare_words"] == 3 / 12 and s["distinct_lines"] == 2 / 3 and s["word_bytes"] == 25 / 12


def test_rules_are_few_and_no_others_inputs():
    rng = np.random.default_rng(0)
    x = rng.random((600, len(rules.STATISTICS)))
    y = ((x[:, 3] > 0.5) & (x[:, 5] < 0.7)).astype(int)
    model = rules.fit(x, y)
    used = {s for r in model.rules for s, _, _ in r.conditions}
    assert {"upper_share", "symbol_share"} <= used and len(model.rules) < 120
    p = [by_hand(model, dict(zip(rules.STATISTICS, row))) >= 0.5 for row in x]
    assert np.mean(np.array(p) == y) > 0.98

"""Toxicity: held-out accuracy on labelled rows, edge rows, and the filter."""

import zlib

import pyarrow.parquet as pq

from murmur.llm import toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    """English rows only: in this table toxic rows of other languages hold no toxic word."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = {r["doc_id"]: r for r in toxicity.toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert len(rows) == docs.count()
    l = pq.read_table(f"{SF}/labels.parquet").to_pydict()
    hits = {(t, p): 0 for t in (0, 1) for p in (0, 1)}
    for d, toxic in zip(l["doc_id"], l["toxic"]):
        r = rows[d]
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if r["held_out"] and (lang[d] == "en" or not toxic):
            hits[toxic, r["predicted"]] += 1
    assert hits[1, 1] >= 0.8 * (hits[1, 0] + hits[1, 1])
    assert hits[0, 1] <= 0.02 * (hits[0, 0] + hits[0, 1])


def rows(n):
    out = []
    for i in range(n):
        words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "ru") for b in ("ta", "so", "vi")]
        text = " ".join(words[(i * 7 + k * k) % 15] for k in range(10 + i % 90))
        if i % 4 == 0:
            text += " zzgrumpf " + words[i % 15] + " blaxqor"
        out.append((i, text, i % 4 == 0))
    return out


def test_edges(spark):
    made = rows(200)
    bad = "zzgrumpf blaxqor " * 20_000
    extra = [(900, None), (901, ""), (902, " \n"), (903, bad), (904, "kata " * 50_000), (None, "zzgrumpf blaxqor"), (7, made[7][1])]
    docs = spark.createDataFrame([(i, t, "x", 0.5) for i, t, _ in made] + [(*r, "y", 0.1) for r in extra],
                                 "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(i, int(b)) for i, _, b in made] + [(4, 0), (900, None), (None, 1)], "doc_id long, toxic int")
    res = toxicity.toxicity(docs, labels)
    by = {}
    for r in res.collect():
        by.setdefault(r["doc_id"], []).append(r)
    assert sum(by[i][0]["predicted"] == int(b) for i, _, b in made) >= 180
    assert all(by[i][0]["predicted"] == 0 for i, _, b in made if not b)
    assert [by[i][0]["predicted"] for i in (900, 901, 902, 903, 904)] == [0, 0, 0, 1, 0]
    assert len(by[7]) == 2 and by[None][0]["held_out"] is False
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] == 0 for v in by.values() for r in v)
    none = toxicity.toxicity(docs, labels.filter("toxic = 0")).collect()
    assert {r["score"] for r in none} == {0.0}
    assert toxicity.toxicity(docs.limit(0), labels.limit(0)).collect() == []


def test_windows_cover_the_whole_line():
    line = toxicity._line("Some words of a longer text  with\nlines and averyveryveryveryveryveryveryverylongword at the end")
    for size in (1, 8, 48, 500):
        assert b"".join(toxicity.windows(line, size)) == line


def test_long_labelled_texts_train_in_sections(spark):
    """Toxic words that stand only in texts longer than a section are learnt."""
    made = rows(160)
    plain = [(i, t, 0) for i, t, bad in made if not bad]
    filler = " ".join(t for _, t, _ in plain[:4])
    long = [(1000 + i, (filler + " zzgrumpf blaxqor ") * 12, 1) for i in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in plain + long] + [(5000, "kata zzgrumpf blaxqor loso"), (5001, plain[3][1])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in plain + long], "doc_id long, toxic int")
    bounds = toxicity.Bounds(section=2_000)
    assert all(len(t) > 2_000 for _, t, _ in long)
    model = toxicity.train(docs, labels, bounds)
    assert b"zgrumpf" in model.toxic and b"laxqor" in model.toxic
    for size in (1, 7, 50, 10_000):
        parts = toxicity.sections(long[0][1][:5000], size)
        assert "".join(parts) == long[0][1][:5000] and all(len(p) >= size for p in parts[:-1])
    assert toxicity.sections(None, 5) == [""] and toxicity.sections("x" * 99, 5) == ["x" * 99]

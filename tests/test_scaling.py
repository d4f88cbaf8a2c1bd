"""Work that grows with the input: n-grams per word position, texts in bounded portions."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from murmur.functions import text
from murmur.operators import langid, ngrams
from tests.test_plans import plan


def test_ngrams_of_all_sizes_from_one_row_a_position(spark):
    rows = [("v", "a b c a b c"), ("v", "a  b c d"), (None, "a b c"), (None, None), ("w", ""), ("w", "x"), ("w", "x y"), ("v", " a b "), ("u", "é ü é ü é")]
    df = spark.createDataFrame(rows, "video_id string, text_clean string")
    for sizes in ((2, 3), (1, 2, 4), (3,)):
        want = Counter()
        for v, t in rows:
            words = (t or "").split(" ")
            for n in sizes:
                want.update((v, n, " ".join(words[i:i + n])) for i in range(len(words) - n + 1) if all(words[i:i + n]))
        got = ngrams.ngram_counts(df, sizes)
        assert Counter({(r["video_id"], r["n"], r["gram"]): r["count"] for r in got.collect()}) == want
        assert "HashAggregate" not in plan(got) and "Generate" not in plan(got)


def test_rows_to_shuffle_are_arrays_of_counted_positions():
    b = pa.RecordBatch.from_arrays([pa.array(["v"] * 1000), pa.array(["a b c d"] * 1000)], ["by", "text"])
    out = list(ngrams._positions((2, 3))(iter([b])))
    assert sum(r.num_rows for r in out) == 3
    assert Counter({w: n for r in out for w, n in zip(r.column(2).flatten().to_pylist(), r.column(4).flatten().to_pylist())}) == {"a b": 1000, "b c": 1000, "c d": 1000}


def test_texts_become_objects_in_portions():
    texts = pa.array(["x" * 100, None, "y" * 300, "z"] * 50)
    parts = text.portions(texts, 400)
    assert [lo for lo, _ in parts] == [0, *(hi for _, hi in parts[:-1])] and parts[-1][1] == 200
    assert all(sum(len(t or "") for t in texts.slice(lo, hi - lo).to_pylist()) <= 400 for lo, hi in parts)
    seen = []
    got = text.by_portions(texts, lambda part: seen.append(len(part)) or part)
    assert got.equals(texts) and len(seen) == len(text.portions(texts)) and text.by_portions(texts.slice(0, 0), list).to_pylist() == []


def test_language_counts_are_made_portion_by_portion(monkeypatch):
    held = []
    grams = langid._grams
    monkeypatch.setattr(langid, "_grams", lambda texts, sizes: held.append(sum(map(len, texts))) or grams(texts, sizes))
    monkeypatch.setattr(langid, "portions", lambda column: text.portions(column, 1000))
    b = pa.RecordBatch.from_arrays([pa.array(["en"] * 100), pa.array(["a long text " * 20] * 100)], ["lang", "text"])
    total = sum(sum(r.column(2).to_pylist()) for r in langid._counted(iter([b])))
    assert max(held) <= 1000 and total == 100 * (242 + 241 + 240)


def test_clean_text_spaces_and_links(spark):
    raw = ["a\x1c　b  c", " http://x.y/z?q  Iİ ", "see https://a b HTTP://K", None, "&amp;lt; é", "\x85", "httpx://a https:// b"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(raw)], "i int, t string")
    got = [r["c"] for r in df.select("i", text.clean_text(F.col("t")).alias("c")).orderBy("i").collect()]
    assert got == ["a b c", "ıi", "see b http://k", "", "&lt; é", "", "httpx://a https:// b"]


def test_packed_positions_take_few_bytes_and_keep_every_count():
    rng = np.random.default_rng(5)
    names = [f"wörd{k}" for k in range(20_000)]
    texts = [" ".join(names[k] for k in np.minimum(rng.zipf(1.3, 300), 20_000) - 1) for _ in range(600)]
    texts += ["a b c", "", None, " a  b c ", "x"] * 3
    videos = [f"v{i % 7}" if i % 50 else None for i in range(len(texts))]
    b = pa.RecordBatch.from_arrays([pa.array(videos), pc.fill_null(pa.array(texts), "")], ["by", "text"])
    want, positions = Counter(), 0
    for v, t in zip(videos, texts):
        words = (t or "").split(" ")
        for n in (2, 3):
            want.update((v, n, " ".join(words[i:i + n])) for i in range(len(words) - n + 1) if all(words[i:i + n]))
    for held in (1 << 20, 1000):
        packed = [r for lo in range(0, b.num_rows, 200) for r in ngrams._packed((2, 3), 256)(iter([b.slice(lo, 200)]))]
        whole = list(ngrams._packed((2, 3), 256)(iter([b])))
        sorted_rows = pa.Table.from_batches(packed).sort_by("part").combine_chunks().to_batches(7)
        before, ngrams.HELD = ngrams.HELD, held
        try:
            got = Counter({(v, n, g): c for r in ngrams._counted((2, 3))(iter(sorted_rows)) for v, n, g, c in zip(*(c.to_pylist() for c in r.columns))})
        finally:
            ngrams.HELD = before
        assert got == want
    positions = sum(r.column(c).nbytes for r in ngrams._positions((2, 3))(iter([b])) for c in range(1, 5))
    assert sum(r.nbytes for r in whole) < positions / 2

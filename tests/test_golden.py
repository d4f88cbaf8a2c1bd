"""Golden vectors for the per-row rules (text clean-up, labels, JSON booleans, counters)."""

import json

import pytest
from pyspark.sql import functions as F

from murmur.functions import labels
from murmur.functions.ontology import normalize_aspect, normalize_sentiment, normalize_topic
from murmur.functions.text import char_len, clean_text, token_count
from murmur.operators import annotate, langid
from murmur.plans import metrics

CLEAN = [
    (None, "", 0, 0),
    ("  \n ", "", 0, 0),
    ("IŞIK &amp; İZMİR", "ışık & izmir", 12, 3),
    ("Bak: https://x.co/a?b=1 SÜPER", "bak: süper", 10, 2),
    ("İstanbul", "istanbul", 8, 1),
    ("&lt;b&gt;Pil&lt;/b&gt; ÖMRÜ\xa0 kısa", "<b>pil</b> ömrü kısa", 20, 3),
    ("HTTP://X.CO kal", "http://x.co kal", 15, 2),
    ("a\x1cb", "a b", 3, 2),
    ("&amp;amp; x", "&amp; x", 7, 2),
    ("😀ok!", "😀ok!", 4, 1),
    ("https://only.url", "", 0, 0),
    ("BAĞLANTI KÖTÜ", "bağlantı kötü", 13, 2),
    ("&copy 2024", "© 2024", 6, 2),
]


def test_clean_text_golden(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CLEAN)], "i int, t string")
    t = clean_text(F.col("t"))
    rows = df.select("i", t.alias("c")).select("i", "c", char_len(F.col("c")).alias("n"),
                                              token_count(F.col("c")).alias("k")).orderBy("i").collect()
    for r, (_, want, n, k) in zip(rows, CLEAN):
        assert (r.c, r.n, r.k) == (want, n, k)


def test_clean_text_matches_python_reference_rules(spark):
    import html
    import re
    import unicodedata

    def py(text):  # the documented order: unescape, URLs, spaces, strip, NFC, Turkish lower
        t = html.unescape(text or "")
        t = re.sub(r"https?://\S+", " ", t)
        t = re.sub(r"\s+", " ", t).strip()
        t = unicodedata.normalize("NFC", t) if t else ""
        return t.replace("İ", "i").replace("I", "ı").lower()

    samples = ["é https://a.b/ć x", " A B　", "x &#39;y&#39; &nbsp;z",
               "ﬁ İI ı", "à̖b", "\x85line\x1ftab\x1e"]
    df = spark.createDataFrame([(s,) for s in samples], "t string")
    got = [r[0] for r in df.select(clean_text(F.col("t"))).collect()]
    assert got == [py(s) for s in samples]


LABELS = [
    ("aspect", "SES", "audio"), ("aspect", "Ses ", "audio"), ("aspect", "\xa0wifi\xa0", "connectivity"),
    ("aspect", "sd kart", "storage"), ("aspect", "Garanti", "customer_service"),
    ("aspect", "BAĞLANTI", "other"), ("aspect", "SERVİS", "other"), ("aspect", "HAFIZA", "other"),
    ("aspect", "DEPOLAMA", "storage"), ("aspect", "Fiyat", "other"), ("aspect", None, "other"),
    ("aspect", "", "other"), ("topic", "channel_quality", "channel_trust"),
    ("topic", " Comparison ", "comparison"), ("topic", "battery", "offtopic"),
    ("sentiment", "MIXED", "mixed"), ("sentiment", "olumlu", "neutral"), ("sentiment", None, "neutral"),
]


def test_label_normalisation_golden(spark):
    df = spark.createDataFrame([(i, k, v) for i, (k, v, _) in enumerate(LABELS)], "i int, k string, v string")
    v = F.col("v")
    out = df.select("i", F.when(F.col("k") == "aspect", normalize_aspect(v))
                    .when(F.col("k") == "topic", normalize_topic(v))
                    .otherwise(normalize_sentiment(v)).alias("n")).orderBy("i").collect()
    assert [r.n for r in out] == [w for _, _, w in LABELS]


def test_turkish_option_maps_dotless_aliases(spark):
    df = spark.createDataFrame([("BAĞLANTI",), ("HAFIZA",)], "v string")
    got = [r[0] for r in df.select(normalize_aspect(F.col("v"), turkish=True)).collect()]
    assert got == ["connectivity", "storage"]


BOOLS = [("true", True), ("false", False), ("null", False), (None, False), ('"Evet "', True), ('"YES"', True),
         ('"1"', True), ('"true"', True), ('"2"', False), ('"no"', False), ('""', False), ('"hayır"', False),
         ("1", True), ("2", True), ("0.5", True), ("[0]", True), ("0", False), ("[]", False), ("{}", False)]


def test_to_bool_golden(spark):
    docs = [(i, '{"x": ' + v + "}" if v is not None else "{}") for i, (v, _) in enumerate(BOOLS)]
    df = spark.createDataFrame(docs, "i int, j string")
    out = df.select("i", labels.to_bool(labels.json_field(F.parse_json("j"), "x")).alias("b")).orderBy("i").collect()
    assert [r.b for r in out] == [w for _, w in BOOLS]


def test_lenient_long_golden(spark):
    vals = [(None, 0), ("1,234", 1234), (" 12 ", 12), ("12.5", 0), ("x", 0), ("7", 7), ("+7", 7), ("1_000", 1000)]
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(vals)], "i int, v string")
    out = df.select("i", labels.lenient_long(F.col("v")).alias("n")).orderBy("i").collect()
    assert [r.n for r in out] == [w for _, w in vals]


def test_comment_type_and_intent_golden(spark):
    ct = [("A", "A", False, True, "Creator reply"), (None, "A", True, False, "Reply"), ("A", None, None, None, "Top-level")]
    df = spark.createDataFrame(ct, "a string, c string, r boolean, want_cr boolean, want string")
    out = df.select(labels.is_creator_reply(F.col("a"), F.col("c")).alias("cr"),
                    labels.comment_type(F.col("a"), F.col("c"), F.col("r")).alias("t"), "want_cr", "want").collect()
    assert all(r.cr == r.want_cr and r.t == r.want for r in out)
    ic = [(True, True, True, None, None, "Pre-Purchase Intent"), (False, True, True, None, None, "Comparison"),
          (False, False, True, None, None, "Information Seeking"),
          (False, False, False, "negative", "channel_trust", "Complaint"),
          (False, False, False, "negative", "comparison", "Other"),
          (False, False, False, "negative", None, "Irrelevant"),
          (False, False, False, "positive", "battery_discussion", "Post-Purchase"),
          (False, False, False, "positive", "price_discussion", "Other"),
          (False, False, False, "mixed", "product_review", "Other"),
          (False, False, False, None, "offtopic", "Irrelevant")]
    df = spark.createDataFrame(ic, "p boolean, c boolean, q boolean, s string, t string, want string")
    out = df.select(labels.intent_category(F.col("p"), F.col("c"), F.col("q"), F.col("s"), F.col("t")).alias("i"),
                    "want").collect()
    assert [r.i for r in out] == [r.want for r in out]


def _tagging(spark, rows):
    return spark.createDataFrame([(c, v, "ch", "m", r, None, j) for c, v, r, j in rows],
                                 "comment_id string, video_id string, channel_id string, model_name string, inference_run_id string, inference_ts timestamp, tagging_json string")


def test_predictions_join_once_on_the_run_id(spark):
    names = '{"aspect_names": ["battery", "wifi", "price"]}'
    tag = _tagging(spark, [("c1", "v", "r1", names), ("c1", "v", "r2", names), ("c2", "v", None, names), ("c3", "v", "r3", "{}")])
    replies = spark.createDataFrame([("r1", 0, '{"sentiment":"positive"}'), ("r1", 1, '{"sentiment":"mixed","aspect":"audio"}'), ("r1", 2, "{}"), ("r1", 2, "{}"),
                                     ("r2", 2, '{"sentiment":"negative","evidence":" x "}'), ("r2", 0, "{bad"), (None, 0, "{}"), ("r9", 0, "{}")],
                                    "inference_run_id string, pos long, aspect_json string")
    df = annotate.prediction_rows(tag, replies)
    got = {r.inference_run_id: r for r in df.collect()}
    assert [(a.aspect, a.sentiment) for a in got["r1"].aspects] == [("battery", "positive"), ("audio", "mixed"), ("price", "neutral")] and not got["r1"].had_error
    assert [(a.aspect, a.sentiment, a.evidence) for a in got["r2"].aspects][2] == ("price", "negative", "x") and got["r2"].had_error
    assert len(got[None].aspects) == 3 and got[None].had_error and got["r3"].aspects == [] and not got["r3"].had_error
    assert annotate.prediction_rows(tag, replies)._jdf.queryExecution().executedPlan().toString().count("Join") == 1
    assert {"inference_ts", "inference_run_id", "model_name"} <= set(df.columns)


def test_missing_key_columns_raise(spark):
    from murmur.plans import reports
    tag = _tagging(spark, [("c1", "v", "r1", "{}")])
    replies = spark.createDataFrame([], "inference_run_id string, pos int, aspect_json string")
    with pytest.raises(ValueError, match="inference_run_id"):
        annotate.prediction_rows(tag.drop("inference_run_id"), replies)
    with pytest.raises(ValueError, match="pos"):
        annotate.prediction_rows(tag, replies.drop("pos"))
    with pytest.raises(ValueError, match="inference_run_id"):
        annotate.aspect_work_items(tag.drop("inference_run_id"))
    with pytest.raises(ValueError, match="fetched_at"):
        reports.newest_first(tag, "fetched_at", ())


def test_tied_snapshots_give_one_answer_in_any_order(spark, scratch):
    from murmur.plans import reports
    from murmur.sources import storage
    import datetime as dt
    ts = dt.datetime(2024, 5, 1)
    rows = [("v", "ch", t, "C", n, n // 2, 3, None, ts) for t, n in (("a", 10), ("b", 12), ("c", 12), (None, 12))]
    schema = "video_id string, channel_id string, video_title string, channel_title string, view_count long, like_count long, comment_count long, published_at timestamp, fetched_at timestamp"
    seen = set()
    for i, order in enumerate((rows, rows[::-1], rows[2:] + rows[:2])):
        df = spark.createDataFrame(order, schema).repartition(3)
        seen.add(tuple(reports.video_stats_latest(df).collect()[0]))
        root = f"{scratch}/{i}"
        storage.ensure_tables(spark, root)
        for r in order:
            storage.append(spark.createDataFrame([r], schema), root, "raw.video_stats")
        seen.add(tuple(reports.video_stats_latest(storage.read(spark, root, "raw.video_stats")).collect()[0]))
    assert len(seen) == 1 and list(seen)[0][2] == "c"


def test_forced_choice_of_an_aspect_does_not_offer_neutral(spark):
    items = spark.createDataFrame([("c1", "v", "r1", 0, "battery")], "comment_id string, video_id string, inference_run_id string, pos int, aspect_name string")
    texts = spark.createDataFrame([("c1", "v", "iyi")], "comment_id string, video_id string, text_clean string")
    system = {f: annotate.aspect_requests(items, texts, f).first().messages[0].content for f in (False, True)}
    assert "(one of: positive, negative, mixed)" in system[True] and "Do not answer neutral" in system[True]
    assert "neutral" in system[False] and "Do not answer neutral" not in system[False]


def test_pending_inference_of_one_video_and_first_rows(spark):
    cur = spark.createDataFrame([(f"c{i}", f"v{i % 3}", "ch", "" if i == 4 else "x") for i in range(9)], "comment_id string, video_id string, channel_id string, text_clean string")
    done = spark.createDataFrame([("c0", "m0"), ("c1", "m1")], "comment_id string, model_name string")
    got = lambda **kw: [(r.video_id, r.comment_id) for r in annotate.pending_inference(cur, done, "m0", **kw).collect()]
    assert sorted(got(video_id="v1")) == [("v1", "c1"), ("v1", "c7")]
    assert got(limit=3) == [("v0", "c3"), ("v0", "c6"), ("v1", "c1")]
    assert len(got(limit=0)) == 7


def test_pending_curation_takes_the_oldest_rows(spark):
    from murmur.operators import curate
    raw = spark.createDataFrame([(i, "v", "ch", "t", None, None, 0, n) for i, n in (("b", 2), ("a", 2), ("c", 1), ("d", None), ("e", 3))],
                                "comment_id string, video_id string, channel_id string, text_original string, parent_id string, author_channel_id string, like_count long, ingested_at long")
    assert [r.comment_id for r in curate.pending_curation(raw, raw.where("comment_id = 'e'"), limit=3).collect()] == ["c", "a", "b"]


def test_aspect_name_preparation_and_no_dedup_after_normalisation(spark):
    reply = json.dumps({"aspect_names": ["battery", " battery ", "Battery", "", 5, "wifi", "bluetooth"]})
    tag = _tagging(spark, [("c1", "v", "r1", reply)])
    items = annotate.aspect_work_items(tag).orderBy("pos").collect()
    assert [r.aspect_name for r in items] == ["battery", "Battery", "wifi", "bluetooth"]
    replies = spark.createDataFrame([("r1", i, "{}") for i in range(4)], "inference_run_id string, pos int, aspect_json string")
    rows = annotate.prediction_rows(tag, replies).collect()
    assert [a.aspect for a in rows[0].aspects] == ["battery", "battery", "connectivity", "connectivity"]
    assert [a.evidence for a in rows[0].aspects] == ["(alıntı yok)"] * 4


def test_run_without_video_keeps_its_aspects(spark):
    tag = _tagging(spark, [("c1", None, "r1", '{"aspect_names": ["battery"]}')])
    replies = spark.createDataFrame([("r1", 0, "{}")], "inference_run_id string, pos int, aspect_json string")
    r = annotate.prediction_rows(tag, replies).collect()
    assert [(x.comment_id, x.video_id, [a.aspect for a in x.aspects], x.had_error) for x in r] == [("c1", None, ["battery"], False)]


def test_language_of_rows_without_id(spark):
    seen = spark.createDataFrame([("en", "the cat sat on the mat with the hat"), ("fr", "le chat est sur la table avec le chien")], "lang string, text_clean string")
    text = "the cat with the hat"
    df = spark.createDataFrame([("x", text), (None, text), (None, text), ("", text), (None, None)], "comment_id string, text_clean string")
    got = langid.predict(df, "text_clean", langid.fit(seen)).collect()
    assert sorted((r.comment_id or "-", r.language) for r in got) == [("-", "en")] * 3 + [("-", "unknown"), ("x", "en")]


TURKISH = ["bu telefonun kamerası çok güzel ama bataryası kötü", "fiyatı biraz yüksek olsa da kaliteli bir ürün",
           "videoyu çok beğendim emeğine sağlık hocam", "bunu alsam mı yoksa diğerini mi beklesem bilemedim",
           "ekranı gerçekten çok parlak ve renkleri canlı görünüyor", "şarjı bir gün bile gitmiyor maalesef"]


def test_turkish_is_told_from_the_documents_languages(spark):
    from murmur.operators import curate
    from murmur.sources import fixtures as fx
    from tests.conftest import SF_SMALL
    seen = fx.language_training(spark, SF_SMALL).union(spark.createDataFrame([(t, "tr") for t in TURKISH[:4]], "text string, lang string"))
    model = curate.language_model(seen)
    assert {"tr", "en", "de"} <= set(model.languages)
    rows = [(f"c{i}", t) for i, t in enumerate(["EKRANI ÇOK PARLAK VE GÜZEL", "Şarjı çok kötü, bir gün gitmiyor", "the thing and the other", "kısa"[:3]])]
    raw = spark.createDataFrame([(i, "v", "ch", t, None, None, 0) for i, t in rows],
                                "comment_id string, video_id string, channel_id string, text_original string, parent_id string, author_channel_id string, like_count long")
    got = {r.comment_id: (r.language, r.is_turkish) for r in curate.curate(raw, model).collect()}
    assert got["c0"] == got["c1"] == ("tr", True) and got["c2"] == ("en", False) and got["c3"] == ("unknown", False)


def test_language_weights_and_sums_by_hand(spark):
    import math
    from collections import Counter
    seen = [("en", "the cat"), ("en", "a hat"), ("fr", "le chat 😀"), (None, "zzz")]
    model = langid.fit(spark.createDataFrame(seen, "lang string, text_clean string"))
    grams = lambda t: [f" {t} "[i:i + k] for k in (1, 2, 3) for i in range(len(t) + 3 - k)]
    counts = {lang: Counter(g for x, t in seen if x == lang for g in grams(t)) for lang in ("en", "fr")}
    distinct = {k: {g for c in counts.values() for g in c if len(g) == k} for k in (1, 2, 3)}
    total = {(lang, k): sum(n for g, n in c.items() if len(g) == k) for lang, c in counts.items() for k in (1, 2, 3)}

    def best(text):
        known = [g for g in grams(text) if g in distinct[len(g)]]
        if len(text) < 5 or not known:
            return "unknown"
        of = {lang: sum(math.floor(1000 * math.log((counts[lang][g] + 0.5) / (total[lang, len(g)] + 0.5 * len(distinct[len(g)])))) for g in known)
              for lang in ("en", "fr")}
        return min(of, key=lambda x: (-of[x], x))

    texts = ["the chat", "le hat ", "chat 😀", "tttttt", "qqqqqq", "", "abc", "the cat " * 40_000]
    assert len(model.codes) == sum(map(len, distinct.values()))
    assert model.best(texts) == [best(t) for t in texts]
    assert langid.Model(("en",), model.codes[:0], model.weights[:0, :1]).best(["hello there"]) == ["unknown"]


def test_language_model_without_rows_and_with_a_bound(spark):
    none = langid.fit(spark.createDataFrame([], "lang string, text_clean string"))
    df = spark.createDataFrame([("hello there",), (None,)], "text_clean string")
    assert {r.language for r in langid.predict(df, "text_clean", none).collect()} == {"unknown"}
    few = langid.fit(spark.createDataFrame([("en", "aaaa b")], "lang string, text_clean string"), max_grams=2)
    assert len(few.codes) == 2


def test_sentiment_choices_are_sorted_and_all_keeps_every_row(spark):
    f5 = spark.createDataFrame([("v", s, "t", "x", False) for s in ("positive", "negative", None, "mixed", "negative")],
                               "video_id string, general_sentiment string, topic string, text_clean string, purchase_intent boolean")
    assert [r.general_sentiment for r in metrics.sentiment_choices(f5).collect()] == ["mixed", "negative", "positive"]
    assert metrics.comments_by_sentiment(f5).count() == 5
    assert metrics.comments_by_sentiment(f5, "negative").count() == 2


def test_forced_choice_request_does_not_offer_neutral():
    assert "(one of: positive, negative, mixed)" in annotate.TAGGING_SYSTEM_FORCED


def test_dedup_keeps_the_newest_row_of_an_id_and_every_row_without_one(spark):
    from murmur.operators import curate
    rows = [("a", "old", 1), ("a", "new", 2), (None, "one", 1), (None, "two", 1), (None, "two", 1), ("b", "done", 1)]
    raw = spark.createDataFrame([(i, "v", "ch", t, None, None, 0, n, n) for i, t, n in rows],
                                "comment_id string, video_id string, channel_id string, text_original string, parent_id string, "
                                "author_channel_id string, like_count long, ingested_at long, updated_at long")
    done = spark.createDataFrame([("b",), (None,)], "comment_id string")
    got = sorted((r.comment_id or "", r.text_clean) for r in curate.curate_dedup(raw, done).collect())
    assert got == [("", "one"), ("", "two"), ("", "two"), ("a", "new")]


def test_malformed_reply_keeps_row_with_defaults(spark):
    tag = _tagging(spark, [("c1", "v", "r1", '{"general_sentiment": "pos')])
    replies = spark.createDataFrame([], "inference_run_id string, pos int, aspect_json string")
    r = annotate.prediction_rows(tag, replies).collect()[0]
    assert (r.general_sentiment, r.topic, r.purchase_intent, r.had_error) == ("neutral", "offtopic", False, True)
    assert r.aspects == []


def test_lexicon_tagger_question_purchase_and_evidence(spark):
    df = spark.createDataFrame([("c1", "v1", "ch1", "kamerası harika ama batarya kötü. bunu alsam mı?")],
                               "comment_id string, video_id string, channel_id string, text_clean string")
    t = annotate.lexicon_tags(df).collect()[0]
    assert t.is_question and t.purchase_intent
    assert t.general_sentiment == "mixed"
    assert "battery" in t.aspect_names
    ev = {r.aspect: r.evidence for r in annotate.aspect_evidence(annotate.lexicon_tags(df)).collect()}
    assert ev["battery"] == ev["camera"] == "kamerası harika ama batarya kötü"


TAGGED = [
    ("fiyatı yüksek ama bataryası iyi. x markayla kıyaslar mısınız?", ["price", "battery", "comparison"]),
    ("sessiz bir yer. ses kötü", ["audio"]),
    ("sessiz bir yer", []),
    ("dayanıklılığı ve sağlamlığı", ["build_quality", "durability"]),
    ("fotoğrafları, ekranından; 128 gb", ["camera", "display", "storage"]),
    ("fiyat/performans oranı süper", ["value_for_money"]),
    ("x ile y arasında hangisi", ["comparison"]),
    ("arkadaşım ile gittim", []),
    ("pil ömrünü merak ediyorum", ["battery"]),
    ("ses ses ses", ["audio"]),
    ("müşteri hizmetlerinden ve garantisinden", ["customer_service"]),
    ("the screens and cameras", ["camera", "display"]),
    ("sesli sessizlik paneller", ["display"]),
    ("", []), (None, []), ("?!.", []),
    ("kalitesi " * 3000, ["build_quality", "durability"]),
]


def test_turkish_phrases_with_endings(spark):
    df = spark.createDataFrame([(f"c{i}", "v", "ch", t) for i, (t, _) in enumerate(TAGGED)],
                               "comment_id string, video_id string, channel_id string, text_clean string")
    got = {r.comment_id: sorted(r.aspect_names) for r in annotate.lexicon_tags(df).collect()}
    assert got == {f"c{i}": sorted(want) for i, (_, want) in enumerate(TAGGED)}


EVIDENCE = [
    ("sessiz bir yer. ses kötü", "audio", "ses kötü"),
    ("bataryalı. batarya iyi! bataryası kötü", "battery", "batarya iyi"),
    ("bir " + "çok " * 30 + "ucuz", "price", " ".join(["bir"] + ["çok"] * 19)),
    ("ilk cümle\nx ile y arasında fark var. karşılaştırma", "comparison", "x ile y arasında fark var"),
]


def test_evidence_is_the_sentence_of_the_match(spark):
    df = spark.createDataFrame([(f"c{i}", "v", "ch", t) for i, (t, _, _) in enumerate(EVIDENCE)],
                               "comment_id string, video_id string, channel_id string, text_clean string")
    got = {(r.comment_id, r.aspect): r.evidence for r in annotate.aspect_evidence(annotate.lexicon_tags(df)).collect()}
    for i, (_, aspect, want) in enumerate(EVIDENCE):
        assert got[f"c{i}", aspect] == want


def test_own_lexicon(spark):
    df = spark.createDataFrame([("c", "v", "ch", "tadı güzel, kokusu kötü")], "comment_id string, video_id string, channel_id string, text_clean string")
    r = annotate.lexicon_tags(df, lexicon={"taste": ["tad", "tat"], "smell": ["koku"]}).collect()[0]
    assert r.aspect_names == ["taste", "smell"] and r.general_sentiment == "mixed"


def test_every_hint_is_reachable(spark):
    rows = [(f"{i}.{j}", "v", "ch", "a ile b arasında" if p == annotate.COMPARED else p)
            for i, (_, phrases) in enumerate(annotate.ASPECT_HINTS) for j, p in enumerate(phrases)]
    df = spark.createDataFrame(rows, "comment_id string, video_id string, channel_id string, text_clean string")
    for r in annotate.lexicon_tags(df).collect():
        assert set(annotate.ASPECT_HINTS[int(r.comment_id.split(".")[0])][0]) <= set(r.aspect_names), r


def test_reply_rejects(spark):
    df = spark.createDataFrame([("a", "{}"), ("b", "{oops"), ("c", None)], "comment_id string, tagging_json string")
    assert [r.comment_id for r in annotate.reply_rejects(df).collect()] == ["b"]

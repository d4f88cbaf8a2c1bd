"""Table loads, layer reset, incremental streams and the annotator hook."""

import json
import os

from pyspark.sql import functions as F

from murmur import schemas
from murmur.operators import annotate
from murmur.sources import fixtures as fx
from murmur.sources import payloads, storage
from murmur.streaming import incremental
from tests.conftest import SF_SMALL


def test_ensure_append_reset(spark, scratch):
    storage.ensure_tables(spark, scratch)
    storage.ensure_tables(spark, scratch)  # idempotent
    raw = fx.raw_comments(spark, SF_SMALL)
    storage.append(raw, scratch, "raw.comments")
    storage.append(raw, scratch, "raw.comments")  # no dedup: rows are appended twice
    n = raw.count()
    assert storage.read(spark, scratch, "raw.comments").count() == 2 * n
    assert storage.read(spark, scratch, "raw.comments").schema == schemas.RAW_COMMENTS
    ins = fx.insights(spark, SF_SMALL)
    storage.append(ins, scratch, "ml.comment_insights")
    storage.reset(spark, scratch, "ml.comment_insights")
    back = storage.read(spark, scratch, "ml.comment_insights")
    assert back.count() == 0 and back.schema == schemas.COMMENT_INSIGHTS
    storage.register_views(spark, scratch)
    assert spark.table("ml_comment_insights_report").count() == 0


def test_pending_curation_then_append_leaves_nothing_pending(spark, scratch):
    from murmur.operators import curate
    raw = fx.raw_comments(spark, SF_SMALL)
    cur = fx.curated(spark, SF_SMALL)
    pending = curate.pending_curation(raw, cur)
    assert pending.count() > 0
    after = cur.unionByName(curate.curate(pending))
    assert curate.pending_curation(raw, after).count() == 0
    limited = curate.pending_curation(raw, cur, limit=3)
    assert limited.count() == 3


def test_curate_stream_is_incremental(spark, scratch):
    raw_dir = os.path.join(scratch, "raw")
    out_dir = os.path.join(scratch, "curated")
    ck = os.path.join(scratch, "ck")
    raw = fx.raw_comments(spark, SF_SMALL)
    first, second = raw.where(F.col("like_count") < 25), raw.where(F.col("like_count") >= 25)
    first.write.parquet(os.path.join(raw_dir, "part=1"))
    incremental.curate_stream(spark, raw_dir, out_dir, ck).awaitTermination()
    n1 = spark.read.parquet(out_dir).count()
    assert n1 == first.count()
    second.write.parquet(os.path.join(raw_dir, "part=2"))
    first.write.parquet(os.path.join(raw_dir, "part=3"))  # re-delivered rows are not curated again
    incremental.curate_stream(spark, raw_dir, out_dir, ck).awaitTermination()
    out = spark.read.parquet(out_dir)
    assert out.count() == raw.count()
    assert out.select("comment_id").distinct().count() == raw.count()


def test_retried_batch_and_late_rows_lose_nothing(spark, scratch):
    out_dir = os.path.join(scratch, "curated")
    rows = [("a", "hello there", "2024-05-10 00:00:00"), (None, "no id, one", "2024-05-10 00:00:00"),
            (None, "no id, two", "2024-05-10 00:00:00"), ("b", "much later", "2024-05-01 00:00:00")]
    raw = spark.createDataFrame([(i, t, ts, "v", "c") for i, t, ts in rows],
                                "comment_id string, text_original string, ts string, video_id string, channel_id string")
    raw = raw.select("*", F.to_timestamp("ts").alias("ingested_at"), F.lit(None).cast("string").alias("parent_id"),
                     F.lit(None).cast("string").alias("author_channel_id"), F.lit(0).cast("bigint").alias("like_count")).drop("ts")
    write = incremental.curate_batch_writer(spark, out_dir)
    write(raw.where("text_original <> 'much later'"), 0)
    write(raw.where("text_original <> 'much later'"), 0)          # the same batch again
    assert spark.read.parquet(out_dir).count() == 3
    write(raw.where("text_original = 'much later'"), 1)           # nine days older than the others
    write(raw.where("text_original = 'much later'"), 1)
    write(raw.where("comment_id = 'a'"), 2)                       # delivered again in a later file
    out = spark.read.parquet(out_dir)
    assert sorted(r.text_clean for r in out.collect()) == ["hello there", "much later", "no id, one", "no id, two"]


def test_annotate_stream_labels_each_comment_once(spark, scratch):
    cur_dir = os.path.join(scratch, "cur")
    ins_dir = os.path.join(scratch, "ins")
    ck = os.path.join(scratch, "ck2")
    cur = fx.curated(spark, SF_SMALL).drop("curated_at")
    cur.write.parquet(os.path.join(cur_dir, "b=1"))
    incremental.annotate_stream(spark, cur_dir, ins_dir, ck).awaitTermination()
    ins = spark.read.parquet(ins_dir)
    want = cur.where(F.col("text_clean") != "").count()
    assert ins.count() == want
    assert set(ins.columns) >= {f.name for f in schemas.COMMENT_INSIGHTS.fields}


def test_retried_annotation_batch_and_other_models(spark, scratch):
    ins_dir = os.path.join(scratch, "ins")
    cur = spark.createDataFrame([(f"c{i}", "v", "ch", "batarya iyi") for i in range(5)] + [(None, "v", "ch", "x")],
                                "comment_id string, video_id string, channel_id string, text_clean string")
    write = incremental.annotate_batch_writer(spark, ins_dir)
    write(cur, 0)
    write(cur, 0)                                                 # retried: its own output is no finished work
    assert spark.read.parquet(ins_dir).count() == 6
    write(cur, 1)                                                 # delivered again: only the row without id, never found done
    assert spark.read.parquet(ins_dir).count() == 7
    incremental.annotate_batch_writer(spark, ins_dir, "other")(cur, 2)
    rows = spark.read.parquet(ins_dir).groupBy("model_name").count().collect()
    assert {r["model_name"]: r["count"] for r in rows} == {"lexicon": 7, "other": 6}


def test_batch_reads_its_own_buckets_only(spark, scratch):
    out_dir = os.path.join(scratch, "ins")
    cur = spark.createDataFrame([(f"c{i}", "v", "ch", "batarya") for i in range(400)], "comment_id string, video_id string, channel_id string, text_clean string")
    incremental.annotate_batch_writer(spark, out_dir)(cur, 0)
    batch = cur.where("comment_id in ('c7', 'c8')")
    seen = incremental.done(batch, out_dir, "comment_id string, model_name string", 1, F.col("model_name") == "lexicon")
    own = {r[0] for r in batch.select(incremental.bucket("comment_id")).collect()}
    p = seen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in p and "bucket" in p.split("PartitionFilters")[1] and "model_name" in p.split("PartitionFilters")[1]
    files = {int(f.split("bucket=")[1].split("/")[0]) for f in spark.read.parquet(out_dir).inputFiles()}
    assert len(files) > 150 and seen.select(incremental.bucket("comment_id")).distinct().count() <= len(own) == 2
    assert annotate.pending_inference(batch, seen, "lexicon").count() == 0


def test_anti_joins_shuffle_only_the_new_side(spark, scratch):
    """Bucketed tables: no exchange of what is stored, also once files of several appends lie there."""
    from murmur.operators import curate
    storage.ensure_bucketed(spark, scratch, 8)
    raw, cur, ins = fx.raw_comments(spark, SF_SMALL), fx.curated(spark, SF_SMALL), fx.insights(spark, SF_SMALL)
    for part in (0, 1):
        storage.append_bucketed(cur.where(F.crc32("comment_id") % 2 == part), "core.comments_curated")
        storage.append_bucketed(ins.where(F.crc32("comment_id") % 2 == part), "ml.comment_insights")
    storage.ensure_bucketed(spark, scratch, 8)
    stored, done = storage.read_bucketed(spark, "core.comments_curated"), storage.read_bucketed(spark, "ml.comment_insights")
    assert stored.schema == schemas.CURATED_COMMENTS and stored.count() == cur.count() and done.count() == ins.count()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pending = curate.pending_curation(raw, stored)
        p = pending._jdf.queryExecution().executedPlan().toString()
        assert "LeftAnti" in p and p.count("Exchange ") == 1 and "Bucketed: true" in p
        todo = annotate.pending_inference(stored, done, "m0")
        p = todo._jdf.queryExecution().executedPlan().toString()
        assert "LeftAnti" in p and "Exchange " not in p and "PartitionFilters: [isnotnull(model_name" in p
        assert sorted(map(str, pending.collect())) == sorted(map(str, curate.pending_curation(raw, cur).collect()))
        assert todo.count() == annotate.pending_inference(cur, ins, "m0").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        for t in storage.BUCKETED:
            spark.sql(f"DROP TABLE {storage.bucketed_name(t)}")


PENDING = [("c1", "v", "ch", "batarya iyi ses kötü"), ("c2", "v", "ch", "merhaba"), ("c3", "v", "ch", "fail tagging"), ("c3", "v2", "ch", "fail aspect"),
           (None, "v", "ch", "no id")]


def _chain(spark, folder, log, broken=()):
    """Functions that answer from the messages and note every call in the folder ``log``."""
    def note(stage, messages):
        with open(os.path.join(log, stage), "a") as f:
            f.write(messages[-1]["content"].replace("\n", " ") + "\n")

    def reason(messages):
        note("reasoning", messages)
        return "free text, no JSON"

    def tag(messages):
        note("tagging", messages)
        text = messages[1]["content"]
        assert [m["role"] for m in messages] == ["system", "user", "assistant", "user"] and messages[2]["content"] == "free text, no JSON"
        if "fail tagging" in text and "tagging" in broken:
            return "{broken"
        return json.dumps({"general_sentiment": "mixed", "topic": "product_review", "aspect_names": [a for a, w in (("battery", "batarya"), ("audio", "ses"), ("other", "fail")) if w in text]})

    def judge(messages):
        note("aspect", messages)
        if "fail aspect" in messages[1]["content"] and "aspect" in broken:
            raise RuntimeError("model unavailable")
        return json.dumps({"sentiment": "negative", "evidence": "kötü"})

    return annotate.Chain(spark, folder, reason, tag, judge, "m9", "run1", slices=3)


def _calls(log, stage):
    path = os.path.join(log, stage)
    return len(open(path).read().splitlines()) if os.path.exists(path) else 0


def test_chain_feeds_prediction_rows_and_resumes(spark, scratch):
    folder, log = os.path.join(scratch, "chain"), scratch
    pending = spark.createDataFrame(PENDING, "comment_id string, video_id string, channel_id string, text_clean string")
    first = {(r.comment_id, r.video_id): r for r in _chain(spark, folder, log, ("tagging", "aspect")).run(pending).collect()}
    assert set(first) == {("c1", "v"), ("c2", "v"), ("c3", "v2"), (None, "v")}
    assert [(a.aspect, a.sentiment, a.evidence) for a in first["c1", "v"].aspects] == [("battery", "negative", "kötü"), ("audio", "negative", "kötü")]
    assert first["c3", "v2"].had_error and not first["c1", "v"].had_error and first["c1", "v"].inference_ts is not None
    assert first["c1", "v"].model_name == "m9" and first["c1", "v"].inference_run_id.startswith("run1-")
    again = _chain(spark, folder, log)
    assert [r.error.split(":")[0] for r in again.rejects("tagging").collect()] == ["JSONDecodeError"]
    assert [r.error for r in again.rejects("aspect").collect()] == ["RuntimeError: model unavailable"]
    asked = {s: _calls(log, s) for s in ("reasoning", "tagging", "aspect")}
    assert asked == {"reasoning": 5, "tagging": 4 + 2, "aspect": 2 + 2}
    more = pending.union(spark.createDataFrame([("c4", "v", "ch", "yeni")], pending.schema))
    second = {(r.comment_id, r.video_id): r for r in again.run(more).collect()}
    assert set(second) == set(first) | {("c3", "v"), ("c4", "v")} and not any(r.had_error for r in second.values())
    # only what had no answer was asked: the failed calls and the new comment
    assert _calls(log, "reasoning") == 6 and _calls(log, "tagging") == asked["tagging"] + 2 and _calls(log, "aspect") == asked["aspect"] + 2
    assert again.rejects("tagging").count() == again.rejects("aspect").count() == 0
    assert again.run(more).count() == 6 and _calls(log, "reasoning") == 6


def test_killed_stage_repeats_no_finished_reply(spark, scratch):
    folder, log = os.path.join(scratch, "chain"), scratch
    pending = spark.createDataFrame([(f"c{i}", "v", "ch", f"text {i}") for i in range(30)], "comment_id string, video_id string, channel_id string, text_clean string")
    chain = _chain(spark, folder, log)
    real = chain.spark
    writes = {"n": 0}

    class Stop(Exception):
        pass

    inner = annotate.call

    def dies(*args, **kw):
        writes["n"] += 1
        if writes["n"] == 3:          # two of three slices of the first stage are written
            raise Stop
        return inner(*args, **kw)

    annotate.call = dies
    try:
        chain.run(pending)
        raise AssertionError
    except Stop:
        pass
    finally:
        annotate.call = inner
    done = chain.good("reasoning").count()
    assert 0 < done < 30 and _calls(log, "reasoning") == done
    assert _chain(real, folder, log).run(pending).count() == 30
    assert _calls(log, "reasoning") == 30


def test_annotator_hook_retries_and_rejects(spark):
    calls = {"n": 0}

    def labeller(text):
        if "x" in text:
            raise RuntimeError("model unavailable")
        if text.startswith("bad"):
            return "{not json"
        return json.dumps({"general_sentiment": "positive", "topic": "product_review"})

    df = spark.createDataFrame([("1", "good one"), ("2", "xx"), ("3", "bad reply")], "comment_id string, text_clean string")
    out = {r.comment_id: r for r in annotate.annotate(df, labeller, attempts=2, partitions=2).collect()}
    assert out["1"].error is None and json.loads(out["1"].reply_json)["topic"] == "product_review"
    assert out["2"].error.startswith("RuntimeError") and out["2"].attempts == 2
    assert out["3"].error.startswith("JSONDecodeError") and out["3"].reply_json is None


def test_thread_rejects_and_flatten(spark):
    good = {"items": [{"snippet": {"channelId": "c", "videoId": "v", "topLevelComment": {
        "id": "t1", "snippet": {"textOriginal": "hi", "likeCount": 2, "publishedAt": "2024-01-02T03:04:05Z"}}},
        "replies": {"comments": [{"id": "r1", "snippet": {"textOriginal": "yo", "authorChannelId": {"value": "c"}}}]}},
        {"replies": {"comments": []}}]}
    pages = spark.createDataFrame([(json.dumps(good),)], "page_json string")
    rows = {r.comment_id: r for r in payloads.flatten_threads(pages).collect()}
    assert set(rows) == {"t1", "r1"}
    assert rows["r1"].parent_id == "t1" and rows["r1"].is_top_level is False
    assert rows["t1"].ingested_at == rows["r1"].ingested_at
    assert [tuple(r) for r in payloads.thread_rejects(pages).collect()] == [("thread", '{"replies":{"comments":[]}}')]


def test_payload_is_kept_as_it_came(spark):
    """Fields that no schema names, their order, blanks and number forms survive in raw_payload."""
    reply = '{"etag":"x1", "id":"r1","snippet":{"textOriginal":"yo \\u00e9","likeCount":"7","extra":[1.50,{"z":null,"a":1}]}}'
    item = '{"kind":"t","snippet":{"videoId":"v","unknown":{"b":2},"topLevelComment":{"id":"t1","snippet":{"textOriginal":"hi"}}},"replies":{"comments":[' + reply + ']}}'
    pages = spark.createDataFrame([('{"kind":"list","items":[' + item + '],"nextPageToken":"n"}',)], "page_json string")
    rows = {r.comment_id: r for r in payloads.flatten_threads(pages).collect()}
    assert json.loads(rows["t1"].raw_payload) == json.loads(item) and json.loads(rows["r1"].raw_payload) == json.loads(reply)
    assert list(json.loads(rows["r1"].raw_payload)) == ["etag", "id", "snippet"]
    assert rows["r1"].like_count == 7 and rows["t1"].like_count is None
    assert payloads.thread_rejects(pages).count() == 0


def test_every_faulty_payload_lands_in_the_rejects(spark, scratch):
    ok = '{"snippet":{"videoId":"v","topLevelComment":{"id":"t","snippet":{}}}}'
    pages = ['{"items":[{"snippet"', "", "[1]", '"x"', '{"items":5}', None, '{"items":[' + ok + ',{"id":"n"},null,7,{"snippet":{"topLevelComment":{"id":"q"}}}]}',
             '{"items":[{"snippet":{"topLevelComment":{"id":"u","snippet":{}}},"replies":{"comments":[{"id":"r"},{"id":"s","snippet":{}}]}}]}',
             '{"items":[{"snippet":{"topLevelComment":{"id":"w","snippet":{}}},"replies":{"comments":9}}]}', '{"items":[]}', "{}", '{"nextPageToken":"z"}']
    df = spark.createDataFrame([(p,) for p in pages], "page_json string")
    assert sorted(r.comment_id for r in payloads.flatten_threads(df).collect()) == ["s", "t", "u"]
    found = [(r.reason, r.payload) for r in payloads.thread_rejects(df).collect()]
    assert sorted((p or "") for why, p in found if why == "page") == sorted(p or "" for p in pages[:6])
    assert sorted((p or "") for why, p in found if why == "reply") == ['{"id":"r"}']
    assert len([1 for why, _ in found if why == "thread"]) == 5
    path = os.path.join(scratch, "pages")
    df.where("page_json is not null").coalesce(1).write.text(path)
    assert payloads.flatten_threads(payloads.read_pages(spark, path)).count() == 3


def test_language_model_accuracy(spark):
    from murmur.operators import langid
    q = __import__("__spark_entry__").queries()["language_id"](spark, SF_SMALL)
    acc = langid.accuracy(q).collect()
    n = sum(r.n for r in acc)
    ok = sum(r.n_correct for r in acc)
    assert ok / n > 0.95
    held = langid.accuracy(q.where("held_out")).agg(F.sum("n").alias("n"), F.sum("n_correct").alias("ok")).first()
    assert held["n"] > 20 and held["ok"] / held["n"] > 0.95


def test_request_export_roundtrip(spark, scratch):
    pending = annotate.pending_inference(fx.curated(spark, SF_SMALL), fx.insights(spark, SF_SMALL), "m0")
    req = annotate.tagging_requests(pending, forced_choice=True, stage="reasoning")
    path = os.path.join(scratch, "requests")
    annotate.export_requests(req, path)
    back = spark.read.json(path)
    assert back.count() == pending.count()
    first = back.select(F.col("messages")[0]["content"].alias("s"), F.col("messages")[1]["role"].alias("r")).first()
    assert "Do not answer neutral" in first.s and first.r == "user"

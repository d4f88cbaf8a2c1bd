"""Annotation as table jobs.

The original annotates one comment at a time with remote model calls.  Here
the data work around the labeller is relational and distributed:

* ``pending_inference``  curated rows not yet labelled by a model (left-anti
                         join with the model constant pushed into the right side)
* ``aspect_work_items``  tagging replies -> one row per (run, aspect name):
                         non-strings dropped, Python-strip, blanks dropped,
                         ordered case-sensitive dedup, ``posexplode``
* ``prediction_rows``    tagging replies + per-aspect replies -> insight rows
                         normalised to the ontology (sentiment/topic/aspect,
                         evidence default, lenient booleans); unparsable
                         replies keep their row with defaults and ``had_error``
* ``lexicon_tags``       an offline labeller: one suffix-aware scan for all phrases
* ``aspect_evidence``    first sentence mentioning the aspect, <= 20 words
* ``tagging_requests`` / ``aspect_requests``  chat-message tables for an
                         external labeller (exported as JSON lines)
* ``annotate``           user hook: partitions -> ``mapInPandas(fn)`` with retries;
                         failures become reject rows, good rows are kept
* ``Chain``              reasoning -> tagging -> aspects, every stage stored and resumable
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmur.functions import labels
from murmur.functions.ontology import (ASPECTS, SENTIMENTS, TOPICS, normalize_aspect,
                                       normalize_sentiment, normalize_topic, py_strip)
from murmur.sources.storage import exists

#: One run of one model on one comment; the id alone identifies it, the others are carried along.
RUN_ID = "inference_run_id"
RUN_COLUMNS = ["comment_id", "video_id", "channel_id", "model_name", RUN_ID]


# -- C2 pending work -------------------------------------------------------------

def pending_inference(curated: DataFrame, insights: DataFrame, model_name: str,
                      video_id: str | None = None, limit: int = 0) -> DataFrame:
    """Curated comments with text that ``model_name`` has not labelled yet.

    ``limit`` <= 0 means no limit; a positive limit keeps the first rows by
    (video_id, comment_id).
    """
    c = curated.where(F.col("text_clean").isNotNull() & (F.col("text_clean") != ""))
    if video_id:
        c = c.where(F.col("video_id") == F.lit(video_id))
    done = insights.where(F.col("model_name") == F.lit(model_name)).select("comment_id")
    out = c.select("comment_id", "video_id", "channel_id", "text_clean").join(done, "comment_id", "left_anti")
    if limit > 0:
        out = out.orderBy("video_id", "comment_id").limit(limit)
    return out


# -- L2 aspect work items -----------------------------------------------------------

def _parsed(json_col: str) -> Column:
    return F.try_parse_json(F.col(json_col))


def _require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"replies need the columns {', '.join(missing)}")


def aspect_names(reply: Column) -> Column:
    """Cleaned, de-duplicated (first occurrence, case-sensitive) aspect names of a
    parsed tagging reply.  A non-array ``aspect_names`` gives no names."""
    raw = F.try_variant_get(reply, "$.aspect_names", "array<variant>")
    strings = F.filter(raw, lambda x: labels.json_kind(x) == "string")
    cleaned = F.transform(strings, lambda x: py_strip(F.try_variant_get(x, "$", "string")))
    return F.coalesce(F.array_distinct(F.filter(cleaned, lambda x: x != F.lit(""))), F.array().cast("array<string>"))


def aspect_work_items(tagging: DataFrame, reply_col: str = "tagging_json", keep: tuple = ()) -> DataFrame:
    """One row per (run, position, aspect name) to send to the aspect stage."""
    _require(tagging, *RUN_COLUMNS, reply_col)
    return tagging.select(*RUN_COLUMNS, *keep, F.posexplode(aspect_names(_parsed(reply_col))).alias("pos", "aspect_name"))


# -- L3 prediction rows ---------------------------------------------------------------

def _label_text(v: Column, field: str) -> Column:
    """String value of ``field`` (Python-stripped); non-strings and missing -> NULL."""
    return labels.json_string(labels.json_field(v, field))


def _aspect(name: Column, reply: Column) -> Column:
    """Normalised aspect of a requested name and its parsed reply (NULL where there is none)."""
    v = F.coalesce(reply, F.parse_json(F.lit("{}")))
    # a falsy reply value falls back to the requested name; a truthy non-string is no label
    aspect = F.when(labels.json_truthy(labels.json_field(v, "aspect")), _label_text(v, "aspect")).otherwise(name)
    evidence = py_strip(_label_text(v, "evidence"))
    return F.struct(normalize_aspect(aspect).alias("aspect"),
                    normalize_sentiment(_label_text(v, "sentiment")).alias("sentiment"),
                    F.when(F.coalesce(evidence, F.lit("")) == "", F.lit(labels.NO_EVIDENCE)).otherwise(evidence).alias("evidence"))


def prediction_rows(tagging: DataFrame, aspect_replies: DataFrame,
                    reply_col: str = "tagging_json", aspect_col: str = "aspect_json") -> DataFrame:
    """Insight rows (``ml.comment_insights`` columns + ``had_error``).

    ``tagging`` has ``RUN_COLUMNS``, ``inference_ts`` and the reply; ``aspect_replies`` has the run id, the
    position of the work item and the reply.  The aspect replies are gathered per run (one row per
    requested aspect) and joined once on ``inference_run_id``; every tagging reply is parsed once and gives its
    aspect names in the row.  A run without id, and an aspect without reply, keep defaults and
    ``had_error``; of several replies to one work item the smallest text counts.
    """
    _require(tagging, *RUN_COLUMNS, "inference_ts", reply_col)
    _require(aspect_replies, RUN_ID, "pos", aspect_col)
    by_run = (aspect_replies.where(F.col(RUN_ID).isNotNull()).groupBy(RUN_ID, "pos").agg(F.min(aspect_col).alias("reply"))
              .groupBy(RUN_ID).agg(F.collect_list(F.struct(F.col("pos").cast("int").alias("pos"), "reply")).alias("replies")))
    t = tagging.select(*RUN_COLUMNS, "inference_ts", _parsed(reply_col).alias("reply"))
    t = t.withColumn("names", aspect_names(F.col("reply")))
    j = t.join(by_run, RUN_ID, "left")
    no_replies = F.array().cast("array<struct<pos:int,reply:string>>")

    def of_item(name: Column, pos: Column) -> Column:
        mine = F.filter(F.coalesce("replies", no_replies), lambda r: r.getField("pos") == pos)
        return F.struct(name.alias("name"), F.try_parse_json(F.try_element_at(mine, F.lit(1)).getField("reply")).alias("reply"))

    j = j.withColumn("items", F.transform("names", of_item))
    v = F.coalesce("reply", F.parse_json(F.lit("{}")))
    return j.select(
        *RUN_COLUMNS, "inference_ts",
        normalize_sentiment(_label_text(v, "general_sentiment")).alias("general_sentiment"),
        normalize_topic(_label_text(v, "topic")).alias("topic"),
        F.transform("items", lambda x: _aspect(x.getField("name"), x.getField("reply"))).cast(T.ArrayType(labels_struct())).alias("aspects"),
        labels.to_bool(labels.json_field(v, "purchase_intent")).alias("purchase_intent"),
        labels.to_bool(labels.json_field(v, "is_question")).alias("is_question"),
        labels.to_bool(labels.json_field(v, "competitor_mention")).alias("competitor_mention"),
        (F.col("reply").isNull() | F.exists("items", lambda x: x.getField("reply").isNull())).alias("had_error"))


def labels_struct() -> T.StructType:
    from murmur.schemas import ASPECT
    return ASPECT


def aspects_text(c: Column) -> Column:
    """'aspect|sentiment|evidence' items joined by ';' (flat form for hashing/export)."""
    return F.array_join(F.transform(c, lambda a: F.concat_ws("|", a.getField("aspect"), a.getField("sentiment"),
                                                               a.getField("evidence"))), ";")


# -- L4 lexicon labeller ------------------------------------------------------------

# ---------------------------------------------------------------------------
# The phrase -> aspect hints and purchase phrases given to the
# labeller in the original prompt (Turkish), in its order; cleaned text is
# lower-case, so they are too.  "X ile Y" is a pattern, see ``COMPARED``.
# ---------------------------------------------------------------------------
ASPECT_HINTS = [
    (["price"], ["fiyat", "pahalı", "ucuz", "bütçe"]),
    (["value_for_money"], ["fiyat/performans oranı", "değer", "paranın hakkı"]),
    (["performance"], ["performans", "hız", "donanım", "oyun"]),
    (["camera"], ["kamera", "fotoğraf", "çekim"]),
    (["battery"], ["batarya", "şarj", "pil ömrü"]),
    (["display"], ["ekran", "görüntü", "panel"]),
    (["audio"], ["ses", "mikrofon", "hoparlör", "kulaklık çıkışı"]),
    (["design"], ["tasarım", "görünüm"]),
    (["build_quality", "durability"], ["dayanıklılık", "kalite", "ömür"]),
    (["software"], ["yazılım", "arayüz", "güncelleme"]),
    (["thermal"], ["ısınma", "termal"]),
    (["connectivity"], ["5g", "wifi", "bluetooth", "bağlantı"]),
    (["sponsorship"], ["sponsorluk", "reklam", "güven"]),
    (["channel_trust"], ["kanal", "sunum", "anlatım"]),
    (["comparison"], ["karşılaştırma", "X ile Y"]),
    (["storage"], ["sd kart", "hafıza kartı", "depolama", "gb"]),
    (["customer_service"], ["servis", "garanti", "müşteri hizmetleri"]),
]
PURCHASE_PHRASES = ["alacağım", "almalı mıyım", "alsam mı", "tavsiye eder misiniz"]
# ---------------------------------------------------------------------------

# Our own additions (not from the original): further phrases, a small polarity
# lexicon and the aspect -> topic priority used to pick one topic.
MORE_HINTS = {
    "price": ["price", "expensive", "cheap", "budget", "pahalıca"],
    "value_for_money": ["fiyat/performans", "value for money", "worth it"],
    "performance": ["hızlı", "performanslı", "performance", "speed", "fast", "slow", "game"],
    "camera": ["camera", "photo", "video quality"],
    "battery": ["pil", "battery", "charge", "charging"],
    "display": ["screen", "display"],
    "audio": ["sound", "audio", "speaker", "microphone"],
    "design": ["design", "look"],
    "build_quality": ["kaliteli", "build quality", "quality"],
    "durability": ["dayanıklı", "sağlam", "durable", "durability"],
    "software": ["software", "update", "interface"],
    "thermal": ["ısınıyor", "heat", "overheat", "thermal"],
    "connectivity": ["signal", "connection"],
    "sponsorship": ["sponsor", "sponsored", "advert"],
    "channel_trust": ["channel", "presentation"],
    "comparison": ["kıyas", "kıyaslama", "karşılaştır", "karşılaştırır", "compare", "comparison", "versus", "vs"],
    "storage": ["hafıza", "storage", "memory card"],
    "customer_service": ["service", "warranty", "support"],
}
POSITIVE_WORDS = ["iyi", "güzel", "harika", "mükemmel", "süper", "good", "great", "excellent", "love", "best"]
NEGATIVE_WORDS = ["kötü", "berbat", "rezalet", "sorun", "bad", "terrible", "awful", "worst", "hate", "problem"]
ASPECT_TOPIC = [
    ("price", "price_discussion"), ("value_for_money", "price_discussion"),
    ("performance", "performance_discussion"), ("thermal", "performance_discussion"),
    ("camera", "camera_discussion"), ("battery", "battery_discussion"),
    ("software", "software_ui"), ("sponsorship", "sponsorship_trust"),
    ("channel_trust", "channel_trust"), ("comparison", "comparison"),
]


def default_lexicon() -> dict[str, list[str]]:
    lex: dict[str, list[str]] = {a: [] for a in ASPECTS}
    for aspects, phrases in ASPECT_HINTS:
        for a in aspects:
            lex[a] += phrases
    for a, extra in MORE_HINTS.items():
        lex[a] += extra
    return {a: phrases for a, phrases in lex.items() if phrases}


POSITIVE, NEGATIVE, PURCHASE = "+", "-", "buy"
COMPARED = "X ile Y"
#: "X with Y" compares if a word of comparing follows in the sentence (matched in doubled text).
COMPARED_PATTERN = r"[\p{L}\p{N}_] +ile +[\p{L}\p{N}_].*[^\p{L}\p{N}_](?:arasında|fark|hangi|kıyas|karşılaştır)"
EDGE = r"[^\p{L}\p{N}_]"

# Inflectional endings of Turkish nouns (number, possessive, case, -ki, copula) and the English plural.
# Endings that make another word of the stem (-siz "without", -li "with", -ci) are left out on purpose.
_ENDINGS = (
    "l[ae]r", "(?:[ıiuü]|s[ıiuü])(?:n[ıiuü]n|n[ıiuü]|n[ae]|nd[ae]n|nd[ae]|yl[ae])?", "[ıiuü]m[ıiuü]z", "[ıiuü]n[ıiuü]z", "[ıiuü][mn]", "m[ıiuü]z",
    "n[ıiuü]z", "[mn]", "n?[ıiuü]n", "[yn][ıiuü]", "[yn]?[ae]", "[dt][ae]n?", "y?l[ae]", "ki", "[dt][ıiuü]r", "y?[dt][ıiuü]", "e?s")


def _escape(phrase: str) -> str:
    return "".join("\\" + ch if ch in "\\.^$*+?()[]{}|" else ch for ch in phrase)


def _stems(phrase: str) -> list[str]:
    """The phrase and, if its last consonant softens before a vowel, the softened form."""
    soft = {"k": "ğ", "p": "b", "ç": "c", "t": "d"}.get(phrase[-1])
    return [phrase, phrase[:-1] + soft] if soft and not phrase.isascii() or soft == "ğ" and len(phrase) > 4 else [phrase]


def stem_tags(lexicon: dict[str, list[str]] | None = None) -> dict[str, list[str]]:
    """Every stem -> its tags: aspects, ``POSITIVE``, ``NEGATIVE``, ``PURCHASE``."""
    groups = {**(lexicon or default_lexicon()), POSITIVE: POSITIVE_WORDS, NEGATIVE: NEGATIVE_WORDS, PURCHASE: PURCHASE_PHRASES}
    out: dict[str, list[str]] = {}
    for tag, phrases in groups.items():
        for p in phrases:
            for stem in _stems(p) if p != COMPARED else []:
                if tag not in out.setdefault(stem, []):
                    out[stem].append(tag)
    return out


def stem_pattern(stems: list[str]) -> str:
    """One alternation over all stems, each a whole word with up to three endings; group 1 is the stem.

    Written without look-around, so that other regex engines take it as well: it consumes the
    characters around the word, which is why ``spaced`` doubles them.  Stems are grouped by their first
    letter and the longest comes first.
    """
    by_letter: dict[str, list[str]] = {}
    for s in sorted(set(stems), key=lambda s: (-len(s), s)):
        by_letter.setdefault(s[0], []).append(s)
    words = "|".join(_escape(first) + "(?:" + "|".join(_escape(s[1:]).replace(" ", " +").replace("/", "/+") for s in group) + ")"
                     for first, group in sorted(by_letter.items()))
    return f"{EDGE}({words})(?:{'|'.join(_ENDINGS)}){{0,3}}{EDGE}"


def spaced(sentence: Column) -> Column:
    """The sentence between blanks, every character that is no part of a word doubled."""
    return F.regexp_replace(F.concat(F.lit(" "), sentence, F.lit(" ")), f"({EDGE})", "$1$1")


SENTENCE_SPLIT = r"[.!?\n]+"
MAX_EVIDENCE_WORDS = 20


def sentences(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, SENTENCE_SPLIT), lambda s: F.trim(s)), lambda s: s != "")


def mentions(text: Column, lexicon: dict[str, list[str]] | None = None) -> Column:
    """array<struct<sentence, tags>> in the order of the text: what every sentence with a
    phrase of the lexicon mentions.  Labels and evidence both come from this one matcher."""
    tags = stem_tags(lexicon)
    of_stem = F.create_map(*[x for stem, t in tags.items() for x in (F.lit(stem), F.array(*map(F.lit, t)))])
    pattern = stem_pattern(list(tags))
    compared = [a for a, phrases in (lexicon or default_lexicon()).items() if COMPARED in phrases]

    def found(sentence: Column) -> Column:
        wide = spaced(sentence)
        # a stem of several words was matched with doubled blanks
        stems = F.transform(F.regexp_extract_all(wide, F.lit(pattern), F.lit(1)),
                            lambda x: F.regexp_replace(F.regexp_replace(x, " +", " "), "/+", "/"))
        own = F.flatten(F.transform(stems, lambda x: F.element_at(of_stem, x)))
        more = F.when(wide.rlike(COMPARED_PATTERN), F.array(*map(F.lit, compared))).otherwise(F.array().cast("array<string>"))
        return F.array_distinct(F.concat(own, more))

    each = F.transform(sentences(F.coalesce(text, F.lit(""))), lambda x: F.struct(x.alias("sentence"), found(x).alias("tags")))
    return F.filter(each, lambda m: F.size(m.getField("tags")) > 0)


def _tag_columns(comments: DataFrame, text_col: str, lexicon: dict[str, list[str]] | None) -> DataFrame:
    """``comments`` with mentions, all their tags, and the aspects among them in the lexicon's order."""
    aspects = F.array(*map(F.lit, lexicon or default_lexicon()))
    return (comments.withColumn("mentions", mentions(F.col(text_col), lexicon))
            .withColumn("tags", F.array_distinct(F.flatten(F.transform("mentions", lambda m: m.getField("tags")))))
            .withColumn("aspect_names", F.filter(aspects, lambda a: F.array_contains(F.col("tags"), a))))


def lexicon_tags(comments: DataFrame, text_col: str = "text_clean",
                 lexicon: dict[str, list[str]] | None = None) -> DataFrame:
    """Offline labels in one projection (no shuffle): aspects, purchase and polarity by one scan of the
    text for inflected phrases, question by '?', topic by the first aspect with a topic in
    priority order (else product review when some aspect matched, else offtopic)."""
    t = F.col(text_col)
    tagged = _tag_columns(comments.select("comment_id", "video_id", "channel_id", t), text_col, lexicon)
    has = lambda tag: F.array_contains(F.col("tags"), tag)
    found = F.col("aspect_names")
    sentiment = (F.when(has(POSITIVE) & has(NEGATIVE), F.lit("mixed"))
                 .when(has(POSITIVE), F.lit("positive")).when(has(NEGATIVE), F.lit("negative"))
                 .otherwise(F.lit("neutral")))
    topic = F.lit(None).cast("string")
    for a, tp in reversed(ASPECT_TOPIC):
        topic = F.when(F.array_contains(found, F.lit(a)), F.lit(tp)).otherwise(topic)
    topic = F.coalesce(topic, F.when(F.size(found) > 0, F.lit("product_review")), F.lit("offtopic"))
    return tagged.select(
        "comment_id", "video_id", "channel_id", t,
        sentiment.alias("general_sentiment"), topic.alias("topic"),
        found, has(PURCHASE).alias("purchase_intent"),
        F.coalesce(t.contains("?"), F.lit(False)).alias("is_question"),
        F.array_contains(found, F.lit("comparison")).alias("competitor_mention"), "mentions")


# -- L5 evidence span -------------------------------------------------------------------

def evidence_span(found: Column, aspect: Column) -> Column:
    """First sentence of ``found`` (``mentions``) that mentions the aspect, cut to its first 20 words;
    the fixed no-evidence phrase when none does."""
    hit = F.filter(found, lambda m: F.array_contains(m.getField("tags"), aspect))
    words = F.slice(F.split(F.try_element_at(hit, F.lit(1)).getField("sentence"), " "), 1, MAX_EVIDENCE_WORDS)
    return F.coalesce(F.when(F.size(hit) > 0, F.array_join(words, " ")), F.lit(labels.NO_ASPECT_PHRASE))


def aspect_evidence(tags: DataFrame) -> DataFrame:
    """One row per (comment, found aspect) of ``lexicon_tags`` with its evidence span."""
    rows = tags.select("comment_id", "video_id", "mentions", F.posexplode("aspect_names").alias("pos", "aspect"))
    return rows.select("comment_id", "video_id", "pos", "aspect",
                       evidence_span(F.col("mentions"), F.col("aspect")).alias("evidence"))


# -- L7 request tables ------------------------------------------------------------------

TAGGING_SYSTEM = (
    "Label one viewer comment posted under a technology video. Reply with a single JSON object "
    "with the keys general_sentiment (one of: " + ", ".join(SENTIMENTS) + "), topic (one of: "
    + ", ".join(TOPICS) + "), aspect_names (a list drawn from: " + ", ".join(ASPECTS)
    + "; empty when none), purchase_intent, is_question and competitor_mention (true or false). "
    "Use mixed only when the comment is clearly both positive and negative."
)
TAGGING_SYSTEM_FORCED = TAGGING_SYSTEM.replace(
    "Use mixed only when the comment is clearly both positive and negative.",
    "Do not answer neutral: choose positive, negative or mixed.").replace(
    ", ".join(SENTIMENTS), ", ".join(s for s in SENTIMENTS if s != "neutral"))
REASONING_USER = "Think through the comment step by step (topic, aspects, tone, signals); do not write JSON yet.\n\nComment:\n"
JSON_USER = "Comment:\n"
JSON_AFTER_REASONING = "Now give only the JSON object described above."
ASPECT_SYSTEM = (
    "You judge one aspect of one viewer comment. Reply with a single JSON object with the keys "
    "aspect, sentiment (one of: " + ", ".join(SENTIMENTS) + ") and evidence: a quote of 3 to 20 words "
    "from the comment, or the phrase " + labels.NO_ASPECT_PHRASE + " when the comment says nothing clear about it."
)

ASPECT_SYSTEM_FORCED = ASPECT_SYSTEM.replace(
    ", ".join(SENTIMENTS), ", ".join(s for s in SENTIMENTS if s != "neutral")) + " Do not answer neutral: choose the dominant tone."


def _msg(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def tagging_requests(pending: DataFrame, forced_choice: bool = False, stage: str = "single",
                     keys: tuple[str, ...] = ("comment_id", "video_id", "channel_id")) -> DataFrame:
    """Chat messages per comment.  ``stage``: 'single' (one JSON call) or
    'reasoning' (first call of the two-step chain)."""
    system = F.lit(TAGGING_SYSTEM_FORCED if forced_choice else TAGGING_SYSTEM)
    prefix = REASONING_USER if stage == "reasoning" else JSON_USER
    msgs = F.array(_msg("system", system), _msg("user", F.concat(F.lit(prefix), F.col("text_clean"))))
    return pending.select(*keys, msgs.alias("messages"))


def tagging_requests_after_reasoning(pending_with_reasoning: DataFrame, forced_choice: bool = False,
                                     keys: tuple[str, ...] = ("comment_id", "video_id", "channel_id")) -> DataFrame:
    """Second call of the chain: the reasoning reply is included as an assistant turn."""
    system = F.lit(TAGGING_SYSTEM_FORCED if forced_choice else TAGGING_SYSTEM)
    msgs = F.array(_msg("system", system),
                   _msg("user", F.concat(F.lit(REASONING_USER), F.col("text_clean"))),
                   _msg("assistant", F.col("reasoning")),
                   _msg("user", F.lit(JSON_AFTER_REASONING)))
    return pending_with_reasoning.select(*keys, msgs.alias("messages"))


def _aspect_messages(forced_choice: bool) -> Column:
    user = F.concat(F.lit('Aspect: "'), F.col("aspect_name"), F.lit('"\n\nComment:\n'), F.col("text_clean"))
    return F.array(_msg("system", F.lit(ASPECT_SYSTEM_FORCED if forced_choice else ASPECT_SYSTEM)), _msg("user", user))


def aspect_requests(items: DataFrame, texts: DataFrame, forced_choice: bool = False) -> DataFrame:
    """Chat messages per (run, aspect name) work item."""
    j = items.join(texts.select("comment_id", "video_id", "text_clean"), ["comment_id", "video_id"])
    return j.select("comment_id", "video_id", RUN_ID, "pos", "aspect_name", _aspect_messages(forced_choice).alias("messages"))


def export_requests(requests: DataFrame, path: str) -> None:
    """Write request tables as JSON lines (one request with its ``messages`` per line),
    compressed, one file per task; an external batch labeller reads them as is."""
    requests.write.mode("overwrite").option("compression", "gzip").json(path)


def messages_rows(requests: DataFrame, *keys: str) -> DataFrame:
    """Requests flattened to (keys..., turn, role, content) rows."""
    return requests.select(*keys, F.posexplode("messages").alias("turn", "m")).select(
        *keys, "turn", F.col("m.role").alias("role"), F.col("m.content").alias("content"))


# -- L6 user annotator hook -------------------------------------------------------------

def call(requests: DataFrame, fn: Callable, keys: list[str], input_col: str, attempts: int = 2, json_reply: bool = True) -> DataFrame:
    """(keys..., reply, error, attempts): the caller's ``fn(input)`` over every row, batch by batch.

    The partition is the unit of concurrency.  A call that raises, returns no text or, with ``json_reply``,
    no JSON is repeated up to ``attempts`` times and then recorded with its error, so one bad row never loses the others.
    """
    src = requests.select(*keys, input_col)
    out = T.StructType([*src.schema.fields[:-1], T.StructField("reply", T.StringType()), T.StructField("error", T.StringType()),
                        T.StructField("attempts", T.IntegerType())])

    def one(value):
        error = None
        for n in range(1, attempts + 1):
            try:
                reply = fn(value)
                if not isinstance(reply, str):
                    raise TypeError("the reply is no text")
                if json_reply:
                    json.loads(reply)
                return reply, None, n
            except Exception as e:  # recorded as a reject after the last attempt
                error = f"{type(e).__name__}: {e}"
        return None, error, attempts

    def run(batches):
        for pdf in batches:
            done = pd.DataFrame([one(v) for v in pdf[input_col]], columns=["reply", "error", "attempts"], index=pdf.index)
            yield pd.concat([pdf[keys], done], axis=1)

    return src.mapInPandas(run, out)


def annotate(requests: DataFrame, fn: Callable[[str], str], text_col: str = "text_clean",
             attempts: int = 2, partitions: int | None = None) -> DataFrame:
    """One stage: ``fn(text) -> JSON text`` over every row; all other columns of ``requests`` are kept as keys.

    Split the result with ``good = out.where(error IS NULL)`` / ``rejects = out.where(error IS NOT NULL)``.
    """
    keys = [c for c in requests.columns if c != text_col]
    src = requests.repartition(partitions) if partitions else requests
    return call(src, fn, keys, text_col, attempts).withColumnRenamed("reply", "reply_json")


class Chain:
    """The labeller as a chain of stages over pending comments: reasoning, tagging JSON, one JSON per aspect.

    ``folder`` (shared storage) keeps what every stage has answered.  A stage asks only for what
    has no answer there (anti-join on the run id and position) and writes in ``slices`` by hash of
    the run id, each committed by itself: a stage that is killed repeats at most the slice it was
    in, and the next run with the same folder goes on from there.  Failed requests are asked again then.

    The functions take the chat messages (a list of {role, content}) and return text: ``reason`` free text,
    ``tag`` and ``judge`` JSON.
    """

    def __init__(self, spark: SparkSession, folder: str, reason: Callable, tag: Callable, judge: Callable,
                 model_name: str, run: str, attempts: int = 2, slices: int = 16, forced_choice: bool = False):
        self.spark, self.folder, self.model_name, self.run_name = spark, folder, model_name, run
        self.functions = {"reasoning": reason, "tagging": tag, "aspect": judge}
        self.attempts, self.slices, self.forced_choice = attempts, slices, forced_choice

    def runs(self, pending: DataFrame) -> DataFrame:
        """One run per pending comment; its id is the run's name and a hash of the comment's keys."""
        key = F.sha2(F.to_json(F.struct("comment_id", "video_id", "channel_id"), {"ignoreNullFields": "false"}), 256)
        rows = pending.select("comment_id", "video_id", "channel_id", F.lit(self.model_name).alias("model_name"),
                              F.concat(F.lit(f"{self.run_name}-"), F.substring(key, 1, 32)).alias(RUN_ID), "text_clean")
        return rows.groupBy(*RUN_COLUMNS).agg(F.min("text_clean").alias("text_clean"))     # rows that repeat a comment are one run

    def answered(self, stage: str) -> DataFrame:
        """Everything ``stage`` has answered so far: run id, pos, reply, error, attempts, answered_at."""
        schema = f"{RUN_ID} string, pos int, reply string, error string, attempts int, answered_at timestamp"
        path = os.path.join(self.folder, stage)
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)

    def good(self, stage: str) -> DataFrame:
        return self.answered(stage).where("error is null")

    def rejects(self, stage: str) -> DataFrame:
        """The last failure of every request that has no answer."""
        failed = self.answered(stage).where("error is not null").join(self.good(stage).select(RUN_ID, "pos"), [RUN_ID, "pos"], "left_anti")
        return failed.groupBy(RUN_ID, "pos").agg(F.max_by(F.struct("error", "attempts"), F.struct("answered_at", "error")).alias("x")).select(RUN_ID, "pos", "x.*")

    def _ask(self, stage: str, requests: DataFrame) -> None:
        """Answers the requests (run id, pos, messages) that have no answer yet."""
        todo = requests.join(self.good(stage).select(RUN_ID, "pos"), [RUN_ID, "pos"], "left_anti")
        for s in range(self.slices):
            part = todo.where(F.pmod(F.xxhash64(RUN_ID), F.lit(self.slices)) == s)
            replies = call(part, self.functions[stage], [RUN_ID, "pos"], "messages", self.attempts, stage != "reasoning")
            replies.withColumn("answered_at", F.current_timestamp()).write.parquet(os.path.join(self.folder, stage, f"{uuid.uuid4().hex}-{s}"))

    def run(self, pending: DataFrame) -> DataFrame:
        """All stages; the insight rows of the runs that got a tagging reply (see ``prediction_rows``)."""
        runs = self.runs(pending)
        first = tagging_requests(runs, self.forced_choice, "reasoning", keys=(RUN_ID,))
        self._ask("reasoning", first.withColumn("pos", F.lit(0)))
        thought = runs.join(self.good("reasoning").select(RUN_ID, F.col("reply").alias("reasoning")), RUN_ID)
        second = tagging_requests_after_reasoning(thought, self.forced_choice, keys=(RUN_ID,))
        self._ask("tagging", second.withColumn("pos", F.lit(0)))
        tagging = runs.join(self.good("tagging").select(RUN_ID, F.col("reply").alias("tagging_json"), F.col("answered_at").alias("inference_ts")), RUN_ID)
        items = aspect_work_items(tagging, keep=("text_clean",))
        self._ask("aspect", items.select(RUN_ID, "pos", _aspect_messages(self.forced_choice).alias("messages")))
        return prediction_rows(tagging, self.good("aspect").select(RUN_ID, "pos", F.col("reply").alias("aspect_json")))


# -- K9-K11 label normalisation over every label string seen ---------------------------

def label_normalization(tagging: DataFrame, aspect_replies: DataFrame,
                        reply_col: str = "tagging_json", aspect_col: str = "aspect_json") -> DataFrame:
    """(kind, raw_value, normalized, n) for every string label in the replies.

    One pass per source: each reply contributes an array of (kind, value)
    pairs that is exploded and counted, so no source is scanned twice.
    """
    tv = F.coalesce(_parsed(reply_col), F.parse_json(F.lit("{}")))
    av = F.coalesce(_parsed(aspect_col), F.parse_json(F.lit("{}")))
    pair = lambda kind, v, field: F.struct(F.lit(kind).alias("kind"), _label_text(v, field).alias("raw_value"))
    t = tagging.select(F.inline(F.array(pair("sentiment", tv, "general_sentiment"), pair("topic", tv, "topic"))))
    a = aspect_replies.select(F.inline(F.array(pair("aspect", av, "aspect"), pair("sentiment", av, "sentiment"))))
    raw = F.col("raw_value")
    return (t.unionByName(a).where(raw.isNotNull())
            .groupBy("kind", "raw_value").agg(F.count(F.lit(1)).alias("n"))
            .select("kind", "raw_value",
                    F.when(F.col("kind") == "topic", normalize_topic(raw))
                    .when(F.col("kind") == "aspect", normalize_aspect(raw))
                    .otherwise(normalize_sentiment(raw)).alias("normalized"), "n"))


def lexicon_insight_rows(pending: DataFrame, model_name: str = "lexicon",
                         lexicon: dict[str, list[str]] | None = None) -> DataFrame:
    """Pending comments labelled offline, shaped as ``ml.comment_insights`` rows.

    Each found aspect carries the comment's overall sentiment and its evidence
    span; one projection, no shuffle.
    """
    from murmur import schemas
    tags = lexicon_tags(pending, "text_clean", lexicon)
    aspects = F.transform("aspect_names", lambda a: F.struct(
        a.alias("aspect"), F.col("general_sentiment").alias("sentiment"),
        evidence_span(F.col("mentions"), a).alias("evidence")))
    rows = tags.select(
        "comment_id", "video_id", "channel_id", F.lit(model_name).alias("model_name"),
        "general_sentiment", "topic", aspects.alias("aspects"), "purchase_intent", "is_question",
        "competitor_mention", F.current_timestamp().alias("inference_ts"))
    return rows.select(*[F.col(f.name).cast(f.dataType) if f.name in rows.columns
                         else F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.COMMENT_INSIGHTS.fields])


def reply_rejects(replies: DataFrame, reply_col: str = "tagging_json") -> DataFrame:
    """Replies that are not valid JSON (kept aside for inspection or a retry run)."""
    return replies.where(F.col(reply_col).isNotNull() & _parsed(reply_col).isNull())

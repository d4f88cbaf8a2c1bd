"""Report-level derived columns and JSON value helpers (all native expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from murmur.functions.ontology import COMPLAINT_TOPICS, PRODUCT_TOPICS, py_strip

# ---------------------------------------------------------------------------
# Labels and truthy words that reports and stored rows must use
# verbatim.
# ---------------------------------------------------------------------------
TRUTHY_WORDS = ["true", "1", "yes", "evet"]
NO_EVIDENCE = "(alıntı yok)"
NO_ASPECT_PHRASE = "(aspect ile ilgili açık ifade yok)"
COMMENT_TYPES = ["Creator reply", "Reply", "Top-level"]
INTENTS = ["Pre-Purchase Intent", "Comparison", "Information Seeking", "Complaint",
           "Post-Purchase", "Irrelevant", "Other"]
NO_VALUE = "—"
# ---------------------------------------------------------------------------


# -- JSON values (Variant) ---------------------------------------------------

def json_field(v: Column, name: str) -> Column:
    """Sub-value of a parsed JSON object as VARIANT (NULL when missing)."""
    return F.try_variant_get(v, f"$.{name}", "variant")


def json_kind(v: Column) -> Column:
    """'null', 'boolean', 'string', 'number', 'array', 'object' or NULL (missing)."""
    s = F.upper(F.schema_of_variant(v))
    return (F.when(v.isNull(), F.lit(None))
            .when(s == "VOID", "null")
            .when(s == "BOOLEAN", "boolean")
            .when(s == "STRING", "string")
            .when(s.startswith("ARRAY"), "array")
            .when(s.startswith("OBJECT"), "object")
            .otherwise("number"))


def json_string(v: Column) -> Column:
    """The value if it is a JSON string, else NULL."""
    return F.when(json_kind(v) == "string", F.try_variant_get(v, "$", "string"))


def json_truthy(v: Column) -> Column:
    """Python truthiness of a decoded JSON value (missing/null -> false)."""
    k = json_kind(v)
    return (F.when(k.isNull() | (k == "null"), F.lit(False))
            .when(k == "boolean", F.try_variant_get(v, "$", "boolean"))
            .when(k == "string", F.try_variant_get(v, "$", "string") != F.lit(""))
            .when(k == "number", F.try_variant_get(v, "$", "double") != F.lit(0.0))
            .when(k == "array", F.size(F.try_variant_get(v, "$", "array<variant>")) > 0)
            .when(k == "object", F.size(F.coalesce(F.try_variant_get(v, "$", "map<string,variant>"),
                                                   F.create_map())) > 0)
            .otherwise(F.lit(False)))


def to_bool(v: Column) -> Column:
    """Lenient boolean of a JSON value: strings by word list, others by truthiness."""
    word = F.lower(py_strip(F.try_variant_get(v, "$", "string")))
    return F.when(json_kind(v) == "string", word.isin(*TRUTHY_WORDS)).otherwise(json_truthy(v))


def lenient_long(c: Column) -> Column:
    """Counter text -> bigint like Python ``int(str(v).replace(',', ''))``: surrounding
    blanks and a sign allowed, '_' between digits allowed, anything else (incl.
    '12.5') -> 0; NULL -> 0."""
    t = F.regexp_replace(c, ",", "")
    t = F.when(t.rlike(r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"), F.regexp_replace(t, "_", ""))
    return F.coalesce(t.try_cast("bigint"), F.lit(0).cast("bigint"))


# -- report columns ----------------------------------------------------------

def is_creator_reply(author: Column, channel: Column) -> Column:
    """Author is the channel owner; NULL when the channel is unknown (three-valued)."""
    return author.isNotNull() & (author == channel)


def comment_type(author: Column, channel: Column, is_reply: Column) -> Column:
    return (F.when(is_creator_reply(author, channel), F.lit(COMMENT_TYPES[0]))
            .when(is_reply, F.lit(COMMENT_TYPES[1]))
            .otherwise(F.lit(COMMENT_TYPES[2])))


def intent_category(purchase: Column, competitor: Column, question: Column,
                    sentiment: Column, topic: Column) -> Column:
    """Business intent; the first matching rule wins."""
    return (F.when(purchase == F.lit(True), F.lit(INTENTS[0]))
            .when(competitor == F.lit(True), F.lit(INTENTS[1]))
            .when(question == F.lit(True), F.lit(INTENTS[2]))
            .when((sentiment == "negative") & topic.isin(*COMPLAINT_TOPICS), F.lit(INTENTS[3]))
            .when(topic.isin(*PRODUCT_TOPICS) & sentiment.isin("positive", "negative"),
                  F.lit(INTENTS[4]))
            .when((topic == "offtopic") | topic.isNull(), F.lit(INTENTS[5]))
            .otherwise(F.lit(INTENTS[6])))


def thousands(c: Column) -> Column:
    """1234567 -> '1,234,567'; NULL -> '—'."""
    return F.coalesce(F.format_number(c.cast("bigint"), 0), F.lit(NO_VALUE))


def day_text(c: Column) -> Column:
    """First ten characters of the timestamp text (YYYY-MM-DD); NULL -> '—'."""
    return F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit(NO_VALUE))

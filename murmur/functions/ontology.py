"""Closed label ontology and the normalisers that map free model output onto it.

Every normaliser is a native Column expression (map lookup + coalesce), so it
runs inside whole-stage codegen; nothing here needs Python at execution time.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These lists and alias maps must equal the reference ontology
# exactly (membership and order), because stored labels and reports use them.
# ---------------------------------------------------------------------------
SENTIMENTS = ["positive", "negative", "neutral", "mixed"]

TOPICS = [
    "product_review",
    "price_discussion",
    "performance_discussion",
    "camera_discussion",
    "battery_discussion",
    "software_ui",
    "sponsorship_trust",
    "channel_trust",
    "comparison",
    "offtopic",
]

ASPECTS = [
    "price",
    "value_for_money",
    "performance",
    "camera",
    "battery",
    "display",
    "audio",
    "design",
    "build_quality",
    "software",
    "thermal",
    "connectivity",
    "durability",
    "storage",
    "customer_service",
    "sponsorship",
    "channel_trust",
    "comparison",
    "other",
]

TOPIC_ALIASES = {
    "channel_quality": "channel_trust",
}

ASPECT_ALIASES = {
    "channel_quality": "channel_trust",
    "value": "value_for_money",
    "fiyat_performans": "value_for_money",
    "microphone": "audio",
    "ses": "audio",
    "hoparlör": "audio",
    "bağlantı": "connectivity",
    "wifi": "connectivity",
    "bluetooth": "connectivity",
    "dayanıklılık": "durability",
    "ömür": "durability",
    "sd kart": "storage",
    "sdcard": "storage",
    "hafıza kartı": "storage",
    "hafıza": "storage",
    "depolama": "storage",
    "servis": "customer_service",
    "garanti": "customer_service",
    "garanti süresi": "customer_service",
    "müşteri hizmetleri": "customer_service",
    "müşteri hizmeti": "customer_service",
}

DEFAULT_TOPIC = "offtopic"
DEFAULT_ASPECT = "other"
DEFAULT_SENTIMENT = "neutral"

# Topics used by the business-intent rules of the comment report.
COMPLAINT_TOPICS = [
    "product_review", "performance_discussion", "price_discussion", "battery_discussion",
    "camera_discussion", "software_ui", "sponsorship_trust", "channel_trust",
]
PRODUCT_TOPICS = [
    "product_review", "performance_discussion", "battery_discussion", "camera_discussion",
    "software_ui",
]
# ---------------------------------------------------------------------------

# Python's str.strip() removes every character with str.isspace(); in Java
# regex terms that is the Unicode White_Space class plus U+001C..U+001F.
PY_SPACE_CLASS = r"[\s\x1c-\x1f]"
_STRIP_RE = r"(?U)^" + PY_SPACE_CLASS + r"+|" + PY_SPACE_CLASS + r"+$"


def py_strip(c: Column) -> Column:
    """Same characters removed as Python ``str.strip()``."""
    return F.regexp_replace(c, _STRIP_RE, "")


def _lookup_map(members: list[str], aliases: dict[str, str]) -> Column:
    pairs = [(m, m) for m in members] + list(aliases.items())
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs)])


def _turkish_lower(c: Column) -> Column:
    return F.lower(F.replace(F.replace(c, F.lit("İ"), F.lit("i")), F.lit("I"), F.lit("ı")))


def _key(c: Column, turkish: bool) -> Column:
    v = py_strip(c)
    return _turkish_lower(v) if turkish else F.lower(v)


def normalize_topic(c: Column, turkish: bool = False) -> Column:
    """Member -> itself, alias -> target, anything else (incl. NULL/blank) -> offtopic."""
    return F.coalesce(F.element_at(_lookup_map(TOPICS, TOPIC_ALIASES), _key(c, turkish)),
                      F.lit(DEFAULT_TOPIC))


def normalize_aspect(c: Column, turkish: bool = False) -> Column:
    """Member -> itself, alias -> target, anything else (incl. NULL/blank) -> other."""
    return F.coalesce(F.element_at(_lookup_map(ASPECTS, ASPECT_ALIASES), _key(c, turkish)),
                      F.lit(DEFAULT_ASPECT))


def normalize_sentiment(c: Column, turkish: bool = False) -> Column:
    """Member of the four sentiments, else neutral (no aliases)."""
    return F.coalesce(F.element_at(_lookup_map(SENTIMENTS, {}), _key(c, turkish)),
                      F.lit(DEFAULT_SENTIMENT))


def sql_list(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)

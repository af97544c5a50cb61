"""HTML entities and NFKC, the two text steps Spark has no built-in for.

Common entities are decoded by column functions. Only rows that hold others, or characters NFKC can change, go to
Python: the Arrow UDF is fed NULL for all others.
"""

from __future__ import annotations

from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from chatterlens.functions.text import drop_urls

# An ampersand that may open an entity.
ENTITY_START = r"&[#A-Za-z]"

# Entities that are decoded without Python, to characters that NFKC leaves alone. The ampersand is last,
# so that nothing is decoded twice.
COMMON_ENTITIES = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "#39": "'", "copy": "©", "reg": "®", "middot": "·", "ndash": "–",
    "mdash": "—", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "bull": "•", "euro": "€", "amp": "&",
}
COMMON_ENTITY = "&(" + "|".join(COMMON_ENTITIES) + ");"

# Characters beyond ASCII that NFKC leaves alone wherever they stand: the Latin letters and signs that
# have no compatibility form, common dashes, quotes, the bullet, rupee and euro signs, pictographs.
NFKC_STABLE = (
    r"\x80-\x9f¡-§©«-®°±¶·»¿-ı"
    r"Ĵ-ľŁ-ňŊ-ž–—‘’“”•€₹"
    r"\x{1f300}-\x{1f5ff}\x{1f600}-\x{1f64f}\x{1f680}-\x{1f6c5}"
)
# The range comes first: ASCII is then told by one comparison, not by one for each part of the class.
NFKC_MAY_CHANGE = rf"[\x80-\x{{10ffff}}&&[^{NFKC_STABLE}]]"


@cache
def _udf(entities: bool, urls: bool, fold: bool):
    """Arrow UDF of the chosen steps. Its body is nested so that it is shipped by value: executors
    need nothing but the standard library."""

    @F.pandas_udf(StringType())
    def apply(texts: pd.Series) -> pd.Series:
        import html
        import re
        import unicodedata

        url = re.compile(r"https?://\S+|www\.\S+", re.IGNORECASE)

        def one(text: str) -> str:
            text = html.unescape(text) if entities else text
            text = url.sub("", text) if urls else text
            return unicodedata.normalize("NFKC", text) if fold else text

        return texts.map(one, na_action="ignore")

    return apply


def may_hold_entity(text: Column) -> Column:
    return text.contains("&") & text.rlike(ENTITY_START)


def may_hold_rare_entity(text: Column) -> Column:
    """Whether an entity may be left once the common ones are taken out."""
    return may_hold_entity(text) & F.regexp_replace(text, COMMON_ENTITY, "").rlike(ENTITY_START)


def decode_common(text: Column) -> Column:
    """Common entities decoded; right for texts that hold no other."""
    out = text
    for name, char in COMMON_ENTITIES.items():
        out = F.replace(out, F.lit(f"&{name};"), F.lit(char))
    return F.when(text.contains("&"), out).otherwise(text)


def may_change_form(text: Column) -> Column:
    """ASCII text, told by its length in bytes, is never looked at closer."""
    return (F.octet_length(text) != F.length(text)) & text.rlike(NFKC_MAY_CHANGE)


def unescape_html(text: Column) -> Column:
    return F.coalesce(_udf(True, False, False)(F.when(may_hold_rare_entity(text), text)), decode_common(text))


def nfkc(text: Column) -> Column:
    return F.coalesce(_udf(False, False, True)(F.when(may_change_form(text), text)), text)


def decode_strip_fold(text: Column) -> Column:
    """Entities, then URLs, then NFKC, in that order; one trip to Python at most."""
    needed = may_hold_rare_entity(text) | may_change_form(text)
    return F.coalesce(_udf(True, True, True)(F.when(needed, text)), drop_urls(decode_common(text)))

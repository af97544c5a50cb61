"""Text primitives built on Spark's own regular-expression functions.

``WORD`` and ``SPACE`` are the bodies of character classes: Unicode letters, digits and
underscore; every character Unicode counts as white space, control separators included.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"\p{L}\p{N}_"
SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"

TOKEN = rf"[{WORD}]+"
NON_SPACE_RUN = rf"[^{SPACE}]+"
URL = rf"(?i)https?://[^{SPACE}]+|www\.[^{SPACE}]+"
CONTROL = r"[\x00-\x1f\x7f-\x9f]"
# Every character of SPACE, for trimming without a regular expression.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# White space other than the plain blank. Letters of ASCII are told by two ranges, without a look at their class.
ODD_SPACE = r"[\t-\r\x1c-\x1f[\x80-\x{10ffff}&&[\x85\p{Z}]]]"
HASHTAG = rf"#([{WORD}]+)"
MENTION = rf"@([{WORD}]+)"


def once(value: Column, step: Callable[[Column], Column]) -> Column:
    """``step`` of a value that is computed once, however often the step names it."""
    return F.get(F.transform(F.array(value), step), F.lit(0))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARS))


def is_blank(text: Column) -> Column:
    """True for NULL, empty and white-space-only text."""
    return F.coalesce(~text.rlike(rf"[^{SPACE}]"), F.lit(True))


def collapse_space(text: Column) -> Column:
    """Runs of white space as one blank; a text of single blanks is searched for others, but not put together anew."""

    def collapsed(t: Column) -> Column:
        return F.when(t.contains("  ") | t.rlike(ODD_SPACE), F.regexp_replace(t, rf"[{SPACE}]+", " ")).otherwise(t)

    return once(text, collapsed)


def drop_urls(text: Column) -> Column:
    """Texts that hold neither ``://`` nor ``www.`` in any case are not searched for URLs."""

    def dropped(t: Column) -> Column:
        return F.when(t.contains("://") | F.lower(t).contains("www."), F.regexp_replace(t, URL, "")).otherwise(t)

    return once(text, dropped)


def drop_controls(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, "")


def tokens(text: Column) -> Column:
    """Lower-case word runs."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(NON_SPACE_RUN))


def find_tags(text: Column, pattern: str) -> Column:
    """Lower-case captures in text order, repeats kept. The pattern begins with the tags' mark."""
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lower)
    return F.when(~text.contains(pattern[0]), F.array().cast("array<string>")).otherwise(found)


def unique_tags(text: Column, pattern: str) -> Column:
    """Lower-case captures, first occurrence of each."""
    return F.array_distinct(find_tags(text, pattern))


def normalise_tags(tags: Column, mark: str) -> Column:
    """Strip white space and leading marks, lower the case, drop what is then blank."""

    def one(tag: Column) -> Column:
        return F.lower(strip(F.ltrim(strip(tag), F.lit(mark))))

    return F.filter(F.transform(F.coalesce(tags, F.array().cast("array<string>")), one), lambda t: t != "")

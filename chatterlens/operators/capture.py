"""Captured search-result cards to posts, and the checks on captured pages.

Each card field is turned into a post column by an expression; nothing here drives a browser.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from chatterlens.functions.numbers import parse_count
from chatterlens.functions.text import HASHTAG, MENTION, collapse_space, find_tags, is_blank, strip
from chatterlens.functions.times import ISO_OFFSET, ISO_SHAPE, iso_utc, parse_iso
from chatterlens.functions.unicode import unescape_html
from chatterlens.operators.dedup import first_per_key
from chatterlens.operators.ranking import first_n
from chatterlens.schema import CAPTURE_SCHEMA, POST_COLUMNS, require_columns

HANDLE = r"@([A-Za-z0-9_]{1,15})"
STATUS_ID = r"/status/([0-9]+)"

# What marks a page as a login wall, as rate limited, as usable.
LOGIN_PATH = "/login"
LOGIN_MARKS = ("loginButton", "sheetDialog")
HOME_MARKS = ("AppTabBar_Home_Link", "SideNav_AccountSwitcher_Button")
POST_MARK = "tweet"
RATE_LIMIT_PHRASES = ("rate limit exceeded", "something went wrong", "try again later")
# Elements that do not break a line of text.
INLINE_TAGS = (
    "a", "abbr", "b", "bdi", "bdo", "cite", "code", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark",
    "q", "s", "samp", "small", "span", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
)
UNSEEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
INLINE = rf"(?i)</?(?:{'|'.join(INLINE_TAGS)})(?:\s[^>]*)?/?>"


def has_test_id(*values: str) -> str:
    """Pattern of a test id attribute, its value in either kind of quotes or none."""
    return rf"""\s(?i:data-testid)\s*=\s*["']?(?:{"|".join(values)})["'\s>/]"""


LOGIN_LINK = r"""<(?i:a)\s(?:[^>]*\s)?(?i:href)\s*=\s*(?:"[^"]*/login|'[^']*/login|[^\s"'>]*/login)"""
LOGIN_WALL = f"{has_test_id(*LOGIN_MARKS)}|{LOGIN_LINK}"
USABLE_MARK = rf"{has_test_id(*HOME_MARKS)}|<(?i:article)(?:\s[^>]*)?{has_test_id(POST_MARK)}"


def handle(user_text: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(user_text, HANDLE, 1), F.lit("")), F.lit("unknown"))


def card_time(time_attr: Column, as_of: Column) -> Column:
    """Instant of the card, ``as_of`` when it has none that can be read.

    A readable time without an offset cannot be compared with the cutoff: NULL, and the card is dropped.
    """
    naive = time_attr.rlike(ISO_SHAPE) & ~time_attr.rlike(ISO_OFFSET)
    parsed = parse_iso(time_attr)
    return F.when(parsed.isNull(), as_of).when(~naive, parsed)


def card_content(body_text: Column, full_text: Column) -> Column:
    """Body text, or the card's own lines without those that open with a handle."""
    lines = F.filter(F.split(strip(full_text), "\n"), lambda x: ~is_blank(x) & ~x.startswith("@"))
    fallback = F.array_join(F.transform(lines, strip), " ")
    return F.coalesce(F.nullif(strip(body_text), F.lit("")), fallback, F.lit(""))


def status_id(href: Column) -> Column:
    return F.nullif(F.regexp_extract(href, STATUS_ID, 1), F.lit(""))


def ingest_key(status: Column, username: Column, timestamp: Column, content: Column) -> Column:
    """SHA-256 of the status id, or of name, time and text as written."""
    return F.sha2(F.coalesce(status, F.concat_ws(":", F.lower(username), iso_utc(timestamp), content)), 256)


def metric_source(text: Column, aria: Column) -> Column:
    """Where a count is read from: the text if there is any, else the label."""
    return F.coalesce(F.nullif(strip(text), F.lit("")), aria)


def metric(text: Column, aria: Column, strict_suffix: bool = False) -> Column:
    """Count shown on a card."""
    return parse_count(metric_source(text, aria), strict_suffix)


def recent_cards(timed: DataFrame, as_of: datetime | Column, cutoff_hours: int) -> DataFrame:
    """Cards whose ``timestamp`` is at most ``cutoff_hours`` before ``as_of``."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return timed.filter(F.col("timestamp") >= now - F.make_interval(hours=F.lit(cutoff_hours)))


def usable_cards(named: DataFrame) -> DataFrame:
    """Cards with a text or a known name."""
    return named.filter((F.col("username") != "unknown") | (F.col("content") != ""))


def parse_cards(
    cards: DataFrame,
    as_of: datetime | Column,
    cutoff_hours: int,
    seen_status: DataFrame | None = None,
    strict_suffix: bool = False,
) -> DataFrame:
    """Recent, non-empty cards as post columns plus ``hashtag``, ``status_id`` and ``ingest_key``.

    ``seen_status(status_id)`` holds ids already parsed. Cards without an id never match it, so they
    stay out of that join instead of meeting in one shuffle partition.
    """
    require_columns(cards, CAPTURE_SCHEMA.fieldNames(), "parse_cards")
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    with_id = cards.withColumn("status_id", status_id(F.col("status_href")))
    if seen_status is not None:
        with_id = drop_seen(with_id, seen_status)
    timed = recent_cards(with_id.withColumn("timestamp", card_time(F.col("time_attr"), now)), now, cutoff_hours)
    named = timed.withColumns(
        {
            "username": handle(F.col("user_text")),
            "content": card_content(F.col("body_text"), F.col("full_text")),
        }
    )
    return usable_cards(named).select(
        F.col("ingest_seq").alias("post_id"),
        "ingest_seq",
        "username",
        "timestamp",
        "content",
        metric(F.col("like_text"), F.col("like_aria"), strict_suffix).alias("likes"),
        metric(F.col("reply_text"), F.col("reply_aria"), strict_suffix).alias("replies"),
        metric(F.col("repost_text"), F.col("repost_aria"), strict_suffix).alias("reposts"),
        find_tags(F.col("content"), HASHTAG).alias("hashtags"),
        find_tags(F.col("content"), MENTION).alias("mentions"),
        "hashtag",
        "status_id",
        ingest_key(F.col("status_id"), F.col("username"), F.col("timestamp"), F.col("content")).alias("ingest_key"),
    )


def drop_seen(cards: DataFrame, seen_status: DataFrame) -> DataFrame:
    """Cards whose status id is not in ``seen_status``; one join, cards read once.

    Cards without an id get a stand-in that no id (all digits) can equal, spread over many values.
    """
    stand_in = F.concat(F.lit("-"), F.pmod(F.xxhash64("ingest_seq"), F.lit(4096)).cast("string"))
    keyed = cards.withColumn("_seen_key", F.coalesce("status_id", stand_in))
    seen = seen_status.select(F.col("status_id").alias("_seen_key"))
    return keyed.join(seen, "_seen_key", "left_anti").select(cards.columns)


def first_capture(parsed: DataFrame) -> DataFrame:
    """The earliest card of each ingest key, over all hashtags."""
    return first_per_key(parsed, "ingest_key")


def capture_counts(parsed: DataFrame) -> DataFrame:
    """One row: cards parsed, kept and skipped as duplicates."""
    per_key = parsed.groupBy("ingest_key").count()
    cards = F.coalesce(F.sum("count"), F.lit(0)).cast("bigint")
    return per_key.agg(
        cards.alias("cards"),
        F.count(F.lit(1)).alias("saved"),
        (cards - F.count(F.lit(1))).alias("duplicates"),
    )


def hashtag_quota(max_posts: int, hashtags: int) -> int:
    return max(1, max_posts // hashtags)


def cap_per_hashtag(df: DataFrame, quota: int, order: str = "ingest_seq", then: Sequence[str] = ()) -> DataFrame:
    """The first ``quota`` posts of every search hashtag; ``then`` settles equal values of ``order``."""
    return first_n(df, quota, "hashtag", order, then)


def cap_total(df: DataFrame, max_posts: int, order: str = "ingest_seq", then: Sequence[str] = ()) -> DataFrame:
    return first_n(df, max_posts, None, order, then)


def union_captures(captures: Iterable[DataFrame]) -> DataFrame:
    """Cards of several searches as one table."""
    merged: DataFrame | None = None
    for part in captures:
        merged = part if merged is None else merged.unionByName(part)
    if merged is None:
        raise ValueError("union_captures needs at least one table")
    return merged


def collect_posts(
    cards: DataFrame,
    search_tags: list[str],
    max_posts: int | None,
    as_of: datetime | Column,
    cutoff_hours: int,
    seen_status: DataFrame | None = None,
    observation: Observation | None = None,
    distinct: Observation | None = None,
    parsed_cards: Observation | None = None,
) -> DataFrame:
    """Cards of the searched hashtags to posts: parse, first per key, quota per hashtag, total cap.

    Without ``max_posts`` all are kept. Once an action has run, ``parsed_cards`` has the ``cards`` read,
    ``distinct`` the ``unique`` ones among them, and ``observation`` the posts ``saved``.
    """
    tags = normalise_search_tags(search_tags)
    parsed = parse_cards(cards.filter(F.col("hashtag").isin(tags)), as_of, cutoff_hours, seen_status)
    if parsed_cards is not None:
        parsed = parsed.observe(parsed_cards, F.count(F.lit(1)).alias("cards"))
    posts = first_capture(parsed)
    if distinct is not None:
        posts = posts.observe(distinct, F.count(F.lit(1)).alias("unique"))
    if max_posts is not None:
        quota = hashtag_quota(max_posts, len(tags))
        posts = cap_per_hashtag(posts, quota)
        if quota * len(tags) > max_posts:  # otherwise the quotas already keep the total
            posts = cap_total(posts, max_posts)
    posts = posts.select(POST_COLUMNS)
    if observation is not None:
        posts = posts.observe(observation, F.count(F.lit(1)).alias("saved"))
    return posts


def normalise_search_tags(tags: Iterable[str]) -> list[str]:
    """Trimmed tags with a leading ``#``; blanks are dropped, nothing left is an error."""
    trimmed = [t.strip() for t in tags if isinstance(t, str) and t.strip()]
    if not trimmed:
        raise ValueError("at least one search hashtag is needed")
    return [t if t.startswith("#") else f"#{t}" for t in trimmed]


def with_topic(df: DataFrame, tags: Iterable[str]) -> DataFrame:
    """Posts that carry one of the search tags."""
    wanted = [t.lstrip("#").lower() for t in normalise_search_tags(tags)]
    return df.filter(F.arrays_overlap("hashtags", F.array(*[F.lit(t) for t in wanted])))


def without_unseen(html: Column) -> Column:
    """The page without scripts, styles and comments."""
    return F.regexp_replace(html, UNSEEN, "")


def visible_text(html: Column) -> Column:
    """Lower-case text as a reader sees it: inline tags vanish, other tags and all white space are one space."""
    text = F.regexp_replace(F.regexp_replace(html, INLINE, ""), "<[^>]*>", " ")
    return F.lower(collapse_space(unescape_html(text)))


def page_checks(pages: DataFrame) -> DataFrame:
    """Adds ``page_status`` (OK, LOGIN_REQUIRED, RATE_LIMITED) and ``usable`` to ``(url, html)`` rows."""
    require_columns(pages, ["url", "html"], "page_checks")
    # One-element explodes: page and text are made once, whatever filters follow.
    seen = pages.withColumn("_page", F.explode(F.array(without_unseen(F.col("html")))))
    seen = seen.withColumn("_text", F.explode(F.array(visible_text(F.col("_page")))))
    # A NULL page still tells by its address.
    walled = F.coalesce(F.lower("url").contains(LOGIN_PATH), F.lit(False)) | F.coalesce(
        F.col("_page").rlike(LOGIN_WALL), F.lit(False)
    )
    limited = F.coalesce(F.col("_text").rlike("|".join(RATE_LIMIT_PHRASES)), F.lit(False))
    return seen.withColumns(
        {
            "page_status": F.when(walled, "LOGIN_REQUIRED").when(limited, "RATE_LIMITED").otherwise("OK"),
            "usable": ~walled & F.coalesce(F.col("_page").rlike(USABLE_MARK), F.lit(False)),
        }
    ).drop("_page", "_text")

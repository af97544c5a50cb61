"""Table schemas and the column sets the operators agree on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

POST_SCHEMA = T.StructType(
    [
        T.StructField("post_id", T.LongType()),
        T.StructField("ingest_seq", T.LongType()),
        T.StructField("username", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("content", T.StringType()),
        T.StructField("likes", T.LongType()),
        T.StructField("replies", T.LongType()),
        T.StructField("reposts", T.LongType()),
        T.StructField("hashtags", T.ArrayType(T.StringType())),
        T.StructField("mentions", T.ArrayType(T.StringType())),
    ]
)

CAPTURE_SCHEMA = T.StructType(
    [T.StructField("ingest_seq", T.LongType())]
    + [
        T.StructField(name, T.StringType())
        for name in (
            "hashtag",
            "status_href",
            "user_text",
            "time_attr",
            "body_text",
            "full_text",
            "reply_text",
            "reply_aria",
            "repost_text",
            "repost_aria",
            "like_text",
            "like_aria",
        )
    ]
)

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

HASH_SCHEMA = T.StructType([T.StructField("fingerprint", T.StringType())])

KEYWORD_SCHEMA = T.StructType(
    [T.StructField("keyword", T.StringType()), T.StructField("score", T.DoubleType())]
)

VOCAB_SCHEMA = T.StructType(
    [
        T.StructField("term", T.StringType()),
        T.StructField("total", T.LongType()),
        T.StructField("df", T.LongType()),
        T.StructField("idf", T.DoubleType()),
    ]
)

POST_COLUMNS = [f.name for f in POST_SCHEMA.fields]

FEATURE_COLUMNS = [
    "engagement_score",
    "tweet_length",
    "word_count",
    "hashtag_count",
    "mention_count",
    "sentiment_score",
    "bullish_keyword_count",
    "bearish_keyword_count",
]


def require_columns(df: DataFrame, names: list[str], what: str) -> None:
    """Fail while the plan is being built, not inside a task."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"{what} needs columns {missing}, got {df.columns}")

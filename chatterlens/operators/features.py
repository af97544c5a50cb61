"""Row-local features of a post."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterlens.functions.text import tokens, word_count
from chatterlens.functions.words import BEARISH_WORDS, BULLISH_WORDS
from chatterlens.schema import FEATURE_COLUMNS, require_columns


def engagement_score(likes: Column, replies: Column, reposts: Column) -> Column:
    """A repost weighs 1.5 likes, a reply 2."""
    return likes * F.lit(1.0) + reposts * F.lit(1.5) + replies * F.lit(2.0)


def in_lexicon(words: Column, lexicon: Sequence[str]) -> Column:
    """The words a lexicon holds; ``isin`` over a list of literals is a hash lookup."""
    entries = list(lexicon)
    return F.filter(words, lambda w: w.isin(entries))


def hits(words: Column, lexicon: Sequence[str]) -> Column:
    """How many of the words, repeats included, the lexicon holds."""
    return F.size(in_lexicon(words, lexicon))


def polarity(bull: Column, bear: Column) -> Column:
    total = bull + bear
    return F.when(total == 0, F.lit(0.0)).otherwise((bull - bear) / total)


def with_sentiment(
    df: DataFrame,
    bullish: Sequence[str] = BULLISH_WORDS,
    bearish: Sequence[str] = BEARISH_WORDS,
) -> DataFrame:
    """Keyword hits on both sides and their polarity in [-1, 1].

    Words outside both lexicons are dropped first, so the text is tokenised and scanned once.
    """
    require_columns(df, ["content"], "with_sentiment")
    found = in_lexicon(tokens(F.coalesce("content", F.lit(""))), [*bullish, *bearish])
    return (
        df.withColumn("_found", found)
        .withColumns(
            {
                "bullish_keyword_count": hits(F.col("_found"), bullish),
                "bearish_keyword_count": hits(F.col("_found"), bearish),
            }
        )
        .withColumn("sentiment_score", polarity(F.col("bullish_keyword_count"), F.col("bearish_keyword_count")))
        .drop("_found")
    )


def extract_features(
    df: DataFrame,
    bullish: Sequence[str] = BULLISH_WORDS,
    bearish: Sequence[str] = BEARISH_WORDS,
) -> DataFrame:
    """Post columns followed by the eight feature columns in their fixed order."""
    require_columns(df, ["content", "likes", "replies", "reposts", "hashtags", "mentions"], "extract_features")
    content = F.coalesce("content", F.lit(""))
    featured = with_sentiment(df.withColumn("content", content), bullish, bearish).withColumns(
        {
            "engagement_score": engagement_score(F.col("likes"), F.col("replies"), F.col("reposts")),
            "tweet_length": F.length("content"),
            "word_count": word_count(F.col("content")),
            "hashtag_count": F.coalesce(F.size("hashtags"), F.lit(0)),
            "mention_count": F.coalesce(F.size("mentions"), F.lit(0)),
        }
    )
    return featured.select(*df.columns, *FEATURE_COLUMNS)

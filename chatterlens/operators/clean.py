"""Text cleaning and tag extraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from chatterlens.functions.text import HASHTAG, MENTION, collapse_space, drop_controls, normalise_tags, unique_tags
from chatterlens.functions.unicode import decode_strip_fold
from chatterlens.schema import require_columns


def clean_text(text: Column, newline_to_space: bool = False) -> Column:
    """Entities, URLs, NFKC, control characters, white space: in this order.

    Control characters are deleted before white space is collapsed, so a line break joins the words
    around it; ``newline_to_space`` keeps them apart.
    """
    folded = decode_strip_fold(F.coalesce(text, F.lit("")))
    if newline_to_space:
        folded = F.regexp_replace(folded, r"[\t\n\r]+", " ")
    return F.trim(collapse_space(drop_controls(folded)))


def merge_tags(content: Column, existing: Column, pattern: str, mark: str) -> Column:
    """Tags found in the text joined with those already known, distinct and sorted."""
    return F.sort_array(F.array_union(unique_tags(content, pattern), normalise_tags(existing, mark)))


def clean_posts(
    df: DataFrame,
    drop_empty: bool = True,
    newline_to_space: bool = False,
    observation: Observation | None = None,
) -> DataFrame:
    """Clean every post and merge its tags; posts left without text are dropped by default.

    ``observation`` receives ``total`` and ``retained`` once an action has run.
    """
    require_columns(df, ["content", "hashtags", "mentions"], "clean_posts")
    text = clean_text(F.col("content"), newline_to_space)
    if observation is not None:
        # The text is computed below the metrics, which keep the filter from being pushed under it.
        kept = F.count_if(F.col("content") != "") if drop_empty else F.count(F.lit(1))
        counted = df.withColumn("content", text).observe(
            observation, F.count(F.lit(1)).alias("total"), kept.alias("retained")
        )
        cleaned = counted.filter(F.col("content") != "") if drop_empty else counted
    elif drop_empty:
        # As a generator, not a filter: a filter would be pushed down and clean every text twice.
        present = F.explode(F.array_remove(F.array(text), "")).alias("content")
        cleaned = df.select(*[present if c == "content" else F.col(c) for c in df.columns])
    else:
        cleaned = df.withColumn("content", text)
    return cleaned.withColumns(
        {
            "hashtags": merge_tags(F.col("content"), F.col("hashtags"), HASHTAG, "#"),
            "mentions": merge_tags(F.col("content"), F.col("mentions"), MENTION, "@"),
        }
    )

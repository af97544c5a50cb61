"""Engagement-weighted signal and its statistical summary."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterlens.functions.times import hour_utc
from chatterlens.schema import require_columns

Z_95 = 1.96


def weighted_signal(df: DataFrame) -> Column:
    """sentiment x (ln(1 + engagement) + 1) x keyword multiplier, the last never below one half."""
    require_columns(df, ["sentiment_score", "engagement_score"], "weighted_signal")

    def count(name: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(0)

    lead = count("bullish_keyword_count") - count("bearish_keyword_count")
    multiplier = F.greatest(F.lit(0.5), F.lit(1.0) + F.lit(0.05) * lead)
    return F.col("sentiment_score") * (F.log1p("engagement_score") + F.lit(1.0)) * multiplier


def with_weighted_signal(df: DataFrame) -> DataFrame:
    return df.withColumn("weighted_signal", weighted_signal(df))


def is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def signal_label(mean: Column, buy: float, sell: float) -> Column:
    return F.when(mean >= F.lit(buy), "BUY").when(mean <= F.lit(sell), "SELL").otherwise("HOLD")


def statistics(signal: Column) -> list[Column]:
    """All moments in one pass over the rows, merged from per-task partial results."""
    return [
        F.count(signal).alias("n"),
        F.coalesce(F.avg(signal), F.lit(0.0)).alias("mean"),
        F.coalesce(F.stddev_samp(signal), F.lit(0.0)).alias("std"),
        F.count_if(signal > 0).alias("bulls"),
        F.count_if(signal < 0).alias("bears"),
    ]


def _summary_columns(buy: float, sell: float) -> list[Column]:
    n, mean, std = F.col("n"), F.col("mean"), F.col("std")
    margin = F.coalesce(F.lit(Z_95) * F.try_divide(std, F.sqrt(n.cast("double"))), F.lit(0.0))
    confidence = F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.abs(mean) / (std + F.lit(1e-6)) * F.lit(100.0)))

    def share(part: str) -> Column:
        return F.coalesce(F.try_divide(F.col(part).cast("double"), n.cast("double")) * F.lit(100.0), F.lit(0.0))

    return [
        n.alias("total_tweets"),
        F.round(mean, 4).alias("mean_signal"),
        F.round(std, 4).alias("std_dev"),
        F.round(mean - margin, 4).alias("ci_95_lower"),
        F.round(mean + margin, 4).alias("ci_95_upper"),
        signal_label(mean, buy, sell).alias("signal_label"),
        F.round(confidence, 2).alias("confidence_score"),
        F.round(share("bulls"), 2).alias("bullish_percentage"),
        F.round(share("bears"), 2).alias("bearish_percentage"),
    ]


def summarise(
    df: DataFrame,
    by: Sequence[str | Column] = (),
    buy_threshold: float = 0.05,
    sell_threshold: float = -0.05,
) -> DataFrame:
    """Signal summary of all rows, or of each group of ``by``.

    ``weighted_signal`` is used when present and computed otherwise. Without groups the result is
    always one row: zeros and HOLD when no finite signal exists. The label looks at the unrounded mean.
    """
    if "weighted_signal" not in df.columns:
        df = with_weighted_signal(df)
    # NULL instead of a filter: a filter on the signal would be pushed down and compute it twice.
    signal = F.when(is_finite(F.col("weighted_signal")), F.col("weighted_signal"))
    grouped = df.withColumn("weighted_signal", signal).groupBy(*by).agg(*statistics(F.col("weighted_signal")))
    if by:
        grouped = grouped.filter(F.col("n") > 0)
    keys = [c for c in grouped.columns if c not in ("n", "mean", "std", "bulls", "bears")]
    return grouped.select(*keys, *_summary_columns(buy_threshold, sell_threshold))


def summarise_by_hashtag(df: DataFrame, **thresholds: float) -> DataFrame:
    """One summary per hashtag; a post counts once under each of its tags."""
    return summarise(df.withColumn("hashtag", F.explode(F.array_distinct("hashtags"))), ["hashtag"], **thresholds)


def summarise_by_hour(df: DataFrame, **thresholds: float) -> DataFrame:
    return summarise(df.withColumn("hour", hour_utc(F.col("timestamp"))), ["hour"], **thresholds)


def _micros(df: DataFrame, length: str) -> int:
    """Microseconds of an interval such as ``15 minutes``."""
    row = df.sparkSession.sql(f"SELECT unix_micros(timestamp_micros(0) + INTERVAL {length}) AS micros").first()
    if row["micros"] <= 0:
        raise ValueError(f"{length!r} is no length of time")
    return row["micros"]


def _merged(panes: str) -> Column:
    """Moments of several groups of rows as those of one: n, mean, sum of squares about the mean, bulls, bears."""
    zero = F.struct(
        F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"),
        F.lit(0).cast("bigint").alias("bulls"), F.lit(0).cast("bigint").alias("bears"),
    )

    def both(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        share = F.coalesce(F.try_divide(b["n"].cast("double"), n.cast("double")), F.lit(0.0))
        apart = b["mean"] - a["mean"]
        return F.struct(
            n.alias("n"),
            (a["mean"] + apart * share).alias("mean"),
            (a["m2"] + b["m2"] + apart * apart * a["n"].cast("double") * share).alias("m2"),
            (a["bulls"] + b["bulls"]).alias("bulls"),
            (a["bears"] + b["bears"]).alias("bears"),
        )

    # In order of time, so that sums are added alike in every run.
    return F.aggregate(F.array_sort(panes), zero, lambda a, b: both(a, b["moments"]))


def rolling_summary(
    df: DataFrame,
    length: str = "1 hour",
    slide: str = "15 minutes",
    buy_threshold: float = 0.05,
    sell_threshold: float = -0.05,
) -> DataFrame:
    """One summary per sliding window; works on a stream once it has a watermark.

    Posts are counted once, in panes that divide every window; a window merges the moments of its panes. On a stream
    both steps keep state, that of a pane until the watermark has passed it.
    """
    framed = df if "weighted_signal" in df.columns else with_weighted_signal(df)
    signal = F.when(is_finite(F.col("weighted_signal")), F.col("weighted_signal"))
    narrow = framed.select("timestamp", signal.alias("weighted_signal"))
    pane = math.gcd(_micros(df, length), _micros(df, slide))
    x = F.col("weighted_signal")
    m2 = F.coalesce(F.var_pop(x), F.lit(0.0)) * F.count(x).cast("double")
    counted = narrow.groupBy(F.window("timestamp", f"{pane} microseconds").alias("pane")).agg(
        *statistics(x), m2.alias("m2")
    )
    moments = F.struct("n", "mean", "m2", "bulls", "bears").alias("moments")
    panes = counted.select(F.window_time("pane").alias("at"), F.col("pane.start").alias("start"), moments, "pane")
    merged = (
        panes.groupBy(F.window("at", length, slide).alias("window"))
        .agg(F.collect_list(F.struct("start", "moments")).alias("panes"))  # at most length / pane of them
        .withColumn("all", _merged("panes"))
        .filter(F.col("all.n") > 0)
    )
    std = F.when(F.col("all.n") > 1, F.sqrt(F.col("all.m2") / (F.col("all.n") - 1).cast("double"))).otherwise(F.lit(0.0))
    flat = merged.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[F.col(f"all.{c}").alias(c) for c in ("n", "mean", "bulls", "bears")],
        std.alias("std"),
    )
    return flat.select("window_start", "window_end", *_summary_columns(buy_threshold, sell_threshold))

"""Chart-ready aggregates: the table behind each chart, a few rows whatever the input size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterlens.functions.times import hour_utc
from chatterlens.operators.signal import is_finite, summarise
from chatterlens.schema import require_columns


#: Hours that one row is expanded to.
HOURS = 1024


def posts_over_time(df: DataFrame) -> DataFrame:
    """Posts per UTC hour, hours without posts between the first and the last included.

    The span is cut into blocks of hours, which are spread over all tasks before they are expanded: one wild date
    costs many rows, but no long task. The counts are made once; the range and the join read the same shuffle.
    """
    counts = (
        df.filter(F.col("timestamp").isNotNull())
        .groupBy(F.unix_seconds(hour_utc(F.col("timestamp"))).alias("second"))
        .agg(F.count(F.lit(1)).alias("posts"))
    )
    span = counts.agg(F.min("second").alias("first"), F.max("second").alias("last"), F.sum("posts").alias("all")).filter("all > 0")
    hours = F.expr("(last - first) div 3600 + 1").alias("hours")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = span.select("first", hours).select("*", F.expr(f"explode(sequence(0, (hours - 1) div {HOURS}))").alias("block"))
    spread = blocks.repartition(parts, "block")
    each = spread.select("first", F.expr(f"explode(sequence(block * {HOURS}, least(hours, (block + 1) * {HOURS}) - 1))").alias("at"))
    return (
        each.select((F.col("first") + F.col("at") * 3600).alias("second"))
        .join(counts, "second", "left")
        .select(F.timestamp_seconds("second").alias("hour"), F.coalesce("posts", F.lit(0)).cast("bigint").alias("posts"))
    )


def top_hashtags(df: DataFrame, top_n: int = 10) -> DataFrame:
    """The most frequent hashtags with their ``#``, ties by name, most frequent last."""
    tag = F.regexp_replace("tag", "^#+", "")
    counted = (
        df.select(F.explode("hashtags").alias("tag"))
        .filter(F.col("tag") != "")
        .groupBy(F.concat(F.lit("#"), tag).alias("hashtag"))
        .agg(F.count(F.lit(1)).alias("frequency"))
    )
    top = counted.orderBy(F.desc("frequency"), F.asc("hashtag")).limit(top_n)
    return top.orderBy(F.asc("frequency"), F.desc("hashtag"))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal bins over [min, max], empty bins included, the last one closed.

    When all values are equal the range is widened by one half on both sides. The range comes from a
    scalar subquery, so binning itself is a projection and a partial aggregate.
    """
    values = df.select(F.col(column).cast("double").alias("x")).filter(is_finite(F.col("x")))
    spread = F.when(F.min("x") == F.max("x"), F.lit(0.5)).otherwise(F.lit(0.0))
    limits = F.struct((F.min("x") - spread).alias("lo"), (F.max("x") + spread).alias("hi"))
    box = values.agg(limits.alias("box")).scalar()  # one subquery, so one extra scan
    lo, hi = box["lo"], box["hi"]

    number = F.least(F.lit(bins).cast("bigint"), F.expr("width_bucket(x, lo, hi, bins)"))
    counted = (
        values.select("x", lo.alias("lo"), hi.alias("hi"), F.lit(bins).cast("bigint").alias("bins"))
        .groupBy(number.alias("bin"))
        .agg(F.count(F.lit(1)).alias("posts"))
    )
    frame = (
        df.sparkSession.range(1, bins + 1)
        .select(F.col("id").alias("bin"), lo.alias("lo"), hi.alias("hi"))
        .filter(F.col("lo").isNotNull())
    )
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    return frame.join(counted, "bin", "left").select(
        "bin",
        (F.col("lo") + width * (F.col("bin") - 1)).alias("bin_start"),
        (F.col("lo") + width * F.col("bin")).alias("bin_end"),
        F.coalesce("posts", F.lit(0)).cast("bigint").alias("posts"),
    )


def engagement_histogram(df: DataFrame, bins: int = 30) -> DataFrame:
    return histogram(df, "engagement_score", bins)


def signal_column(df: DataFrame) -> str:
    return "weighted_signal" if "weighted_signal" in df.columns else "sentiment_score"


def signal_histogram(df: DataFrame, bins: int = 30) -> DataFrame:
    """Distribution of the weighted signal, or of the raw sentiment where that is all there is."""
    require_columns(df, [signal_column(df)], "signal_histogram")
    return histogram(df, signal_column(df), bins)


def signal_overlay(summary: DataFrame) -> DataFrame:
    """The three vertical lines drawn over the signal histogram."""

    def line(label: str, column: str) -> Column:
        return F.struct(F.lit(label).alias("line"), F.col(column).alias("position"))

    lines = F.array(line("mean", "mean_signal"), line("ci_95_lower", "ci_95_lower"), line("ci_95_upper", "ci_95_upper"))
    return summary.select(F.inline(lines))


def signal_chart(df: DataFrame, summary: DataFrame | None = None, bins: int = 30) -> DataFrame:
    """Histogram bins with the overlay positions beside each, read by scalar subquery."""
    chart = signal_histogram(df, bins)
    if summary is None:
        return chart
    names = ("mean_signal", "ci_95_lower", "ci_95_upper")
    lines = summary.select(F.struct(*names)).scalar()
    return chart.select("*", *[lines[c].alias(c) for c in names])


def all_charts(df: DataFrame, summary: DataFrame | None = None, top_n: int = 10, bins: int = 30) -> dict[str, DataFrame]:
    """Every chart table the columns allow; a chart whose column is missing has no entry."""
    charts: dict[str, DataFrame] = {}
    if "timestamp" in df.columns:
        charts["posts_over_time"] = posts_over_time(df)
    if "hashtags" in df.columns:
        charts["top_hashtags"] = top_hashtags(df, top_n)
    if "engagement_score" in df.columns:
        charts["engagement_histogram"] = engagement_histogram(df, bins)
    if signal_column(df) in df.columns:
        if summary is None and "weighted_signal" in df.columns:
            summary = summarise(df)
        charts["signal_chart"] = signal_chart(df, summary, bins)
    return charts

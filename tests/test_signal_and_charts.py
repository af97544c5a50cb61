import math
import statistics
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from chatterlens.operators import charts, signal


def signals(spark, values):
    return spark.createDataFrame([(v,) for v in values], "weighted_signal double")


def test_weighted_signal(spark):
    df = spark.createDataFrame(
        [(1.0, 9.0, 2, 0), (-1.0, 0.0, 0, 20), (0.5, 3.0, 0, 0)],
        "sentiment_score double, engagement_score double, bullish_keyword_count int, bearish_keyword_count int",
    )
    got = [r.weighted_signal for r in signal.with_weighted_signal(df).collect()]
    assert got == pytest.approx([(math.log1p(9) + 1) * 1.1, -0.5, 0.5 * (math.log1p(3) + 1)])
    without = signal.with_weighted_signal(df.select("sentiment_score", "engagement_score"))
    assert without.first().weighted_signal == pytest.approx(math.log1p(9) + 1)
    with pytest.raises(ValueError, match="engagement_score"):
        signal.with_weighted_signal(df.select("sentiment_score"))


def test_summary(spark):
    values = [0.3, -0.2, 0.0, 0.9, float("nan"), float("inf"), None]
    got = signal.summarise(signals(spark, values)).first()
    finite = [0.3, -0.2, 0.0, 0.9]
    mean, std = statistics.mean(finite), statistics.stdev(finite)
    assert got.total_tweets == 4
    assert (got.mean_signal, got.std_dev) == (round(mean, 4), round(std, 4))
    assert got.ci_95_lower == round(mean - 1.96 * std / 2, 4)
    assert got.ci_95_upper == round(mean + 1.96 * std / 2, 4)
    assert got.confidence_score == round(mean / (std + 1e-6) * 100, 2)
    assert (got.bullish_percentage, got.bearish_percentage, got.signal_label) == (50.0, 25.0, "BUY")


@pytest.mark.parametrize("values", [[], [float("nan"), float("-inf")]])
def test_no_finite_signal(spark, values):
    rows = signal.summarise(signals(spark, values)).collect()
    assert [tuple(r) for r in rows] == [(0, 0.0, 0.0, 0.0, 0.0, "HOLD", 0.0, 0.0, 0.0)]


@pytest.mark.parametrize("mean, label", [(0.05, "BUY"), (-0.05, "SELL"), (0.04996, "HOLD")])
def test_label_uses_the_unrounded_mean(spark, mean, label):
    row = signal.summarise(signals(spark, [mean])).first()
    assert (row.signal_label, row.std_dev) == (label, 0.0)
    assert row.ci_95_lower == row.ci_95_upper == row.mean_signal


def test_groups_without_finite_signal_are_left_out(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", float("nan"))], "k string, weighted_signal double")
    assert [r.k for r in signal.summarise(df, ["k"]).collect()] == ["a"]


def test_result_does_not_depend_on_partitions(spark):
    df = spark.range(10_000).select((F.sin("id") * 3).alias("weighted_signal"))
    assert signal.summarise(df.repartition(13)).first() == signal.summarise(df.coalesce(1)).first()


def test_hours_are_filled(make_posts):
    posts = make_posts(
        {"timestamp": datetime(2024, 1, 1, 23, 10, tzinfo=UTC)}, {"timestamp": datetime(2024, 1, 2, 1, 50, tzinfo=UTC)}
    )
    rows = charts.posts_over_time(posts).orderBy("hour").select(F.unix_seconds("hour").alias("s"), "posts").collect()
    assert [(r.s % 86400 // 3600, r.posts) for r in rows] == [(23, 1), (0, 0), (1, 1)]
    assert charts.posts_over_time(posts.filter("false")).count() == 0


def test_a_long_span_is_filled_by_several_tasks(spark, make_posts):
    posts = make_posts({}, {"timestamp": datetime(2044, 1, 1, tzinfo=UTC)}, {"timestamp": None})
    hours = charts.posts_over_time(posts)
    by_task = hours.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()
    total = sum(r.n for r in by_task)
    assert total == 20 * 8766 + 1 and len(by_task) >= 4 and max(r.n for r in by_task) <= total // 2
    assert hours.filter("posts > 0").count() == 2 and hours.select("hour").distinct().count() == total


def test_rolling_windows_merge_panes(spark, capsys):
    """A slide that does not divide the length, values of one sign, none and not a number; posts are counted once."""
    rows = spark.range(400).select(
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 131).alias("timestamp"),
        F.when(F.col("id") % 50 < 30, F.sin("id") * 1e6 + 1e9).when(F.col("id") % 50 < 40, F.lit(float("nan"))).alias("weighted_signal"),
    )
    got = signal.rolling_summary(rows, "50 minutes", "20 minutes")
    got.explain()
    plan = capsys.readouterr().out
    assert "Expand" not in plan[plan.rindex("partial_avg") :]  # nothing is multiplied below the first count
    direct = signal.summarise(rows, [F.window("timestamp", "50 minutes", "20 minutes")])
    want = direct.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *[c for c in direct.columns if c != "window"])
    a, b = (sorted(map(tuple, df.collect())) for df in (got, want))
    assert len(a) == len(b) > 20
    for x, y in zip(a, b):
        assert x[:3] == y[:3] and x[7] == y[7] and x[9:] == y[9:]
        assert [float(v) for v in x[3:7]] == pytest.approx([float(v) for v in y[3:7]], rel=1e-9, abs=1e-2)


def test_top_hashtags(make_posts):
    posts = make_posts({"hashtags": ["a", "b"]}, {"hashtags": ["b", ""]}, {"hashtags": ["c"]})
    rows = charts.top_hashtags(posts, 2).collect()
    assert [tuple(r) for r in rows] == [("#a", 1), ("#b", 2)]


def test_histogram(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 30)], "x double")
    rows = charts.histogram(df, "x").orderBy("bin").collect()
    assert len(rows) == 30 and sum(r.posts for r in rows) == 4
    assert (rows[0].bin_start, rows[-1].bin_end, rows[-1].posts) == (0.0, 30.0, 1)
    same = charts.histogram(spark.createDataFrame([(5.0,), (5.0,)], "x double"), "x").orderBy("bin").collect()
    assert (same[0].bin_start, same[-1].bin_end, sum(r.posts for r in same)) == (4.5, 5.5, 2)
    assert charts.histogram(df.filter("false"), "x").count() == 0


def test_charts_follow_the_columns(spark, make_posts):
    df = spark.createDataFrame([(0.5,)], "sentiment_score double")
    assert list(charts.all_charts(df)) == ["signal_chart"]
    assert list(charts.all_charts(make_posts({}))) == ["posts_over_time", "top_hashtags"]
    scored = signals(spark, [0.1, 0.2])
    chart = charts.signal_chart(scored, signal.summarise(scored))
    assert chart.columns[-3:] == ["mean_signal", "ci_95_lower", "ci_95_upper"] and chart.count() == 30
    assert charts.signal_overlay(signal.summarise(scored)).count() == 3

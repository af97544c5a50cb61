"""Normalisation, deduplication, features."""

import hashlib
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from chatterlens.operators import dedup, features, normalize
from chatterlens.session import scratch_dir


def test_normalise(spark, make_posts):
    posts = make_posts(
        {"username": " 　Ann ", "content": "\tx ", "likes": -3, "hashtags": ["#NIFTY ", " ", "##x", "#", None], "mentions": ["@@Bob"]},
        {"hashtags": None, "likes": None},
    )
    first, second = normalize.normalise_posts(posts).orderBy("post_id").collect()
    assert (first.username, first.content, first.likes, first.hashtags, first.mentions) == ("Ann", "x", 0, ["nifty", "x"], ["bob"])
    assert (second.hashtags, second.likes) == ([], 0)


def test_quarantine(make_posts):
    posts = make_posts({}, {"username": None}, {"timestamp": None, "content": None})
    assert normalize.valid_posts(posts).count() == 1
    bad = normalize.rejected_posts(posts).orderBy("post_id").collect()
    assert [r.missing for r in bad] == [["username"], ["timestamp", "content"]]


def test_missing_column_fails_while_planning(spark):
    with pytest.raises(ValueError, match="content"):
        normalize.normalise_posts(spark.createDataFrame([("u",)], "username string"))


def python_print(name, moment, content):
    return hashlib.sha256(f"{name.lower()}:{moment.isoformat()}:{content.strip().lower()}".encode()).hexdigest()


def test_fingerprint_is_the_documented_digest(make_posts):
    moments = [datetime(2024, 1, 1, 5, tzinfo=UTC), datetime(2024, 1, 1, 5, 0, 0, 1500, tzinfo=UTC)]
    cases = [("Ann", m, t) for m in moments for t in (" Hello É ", "x")]
    posts = make_posts(*[{"username": n, "timestamp": m, "content": t} for n, m, t in cases])
    got = [r.fingerprint for r in dedup.with_fingerprint(posts).orderBy("post_id").collect()]
    assert got == [python_print(*c) for c in cases]


def test_first_occurrence_wins(make_posts):
    posts = make_posts(
        {"ingest_seq": 9, "username": "ANN", "content": "hi", "likes": 1},
        {"ingest_seq": 4, "username": "ann", "content": " HI ", "likes": 2},
        {"ingest_seq": 6, "username": "bob", "content": "hi"},
    )
    assert {r.ingest_seq for r in dedup.deduplicate(posts).collect()} == {4, 6}


def hot_posts(spark, make_posts, n=30_000):
    """A third of all rows are copies of one post."""
    one = make_posts({})
    return spark.range(n).withColumn("hot", F.col("id") < n // 3).crossJoin(one.drop("post_id", "ingest_seq", "username")).select(
        F.col("id").alias("post_id"),
        (F.lit(n) - F.col("id")).alias("ingest_seq"),
        F.when(F.col("hot"), "same").otherwise(F.concat(F.lit("u"), F.col("id"))).alias("username"),
        *[c for c in one.columns if c not in ("post_id", "ingest_seq", "username")],
    )


def test_hot_fingerprint(spark, make_posts):
    posts = hot_posts(spark, make_posts)
    unique = dedup.deduplicate(posts.repartition(7))
    assert unique.count() == 20_001
    assert unique.filter("username = 'same'").first().ingest_seq == 20_001
    counts = dedup.duplicate_counts(posts).first()
    assert (counts.total_posts, counts.unique_posts, counts.duplicate_posts) == (30_000, 20_001, 9_999)
    again = dedup.deduplicate(unique.drop("fingerprint").unionByName(unique.drop("fingerprint")))
    assert again.count() == 20_001


def test_copies_are_cut_before_the_shuffle(make_posts, capsys):
    dedup.deduplicate(make_posts({})).explain()
    plan = capsys.readouterr().out
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Partial") > plan.index("Exchange")


def test_known_fingerprints(spark, make_posts):
    posts = make_posts({"username": "a"}, {"username": "b"}, {"username": "a"})
    known = dedup.with_fingerprint(posts.filter("username = 'a'")).select("fingerprint")
    assert [r.username for r in dedup.deduplicate(posts, known).collect()] == ["b"]
    flags = dedup.flag_known(posts, known).orderBy("post_id").collect()
    assert [r.is_duplicate for r in flags] == [True, False, True]
    assert dedup.register(known, posts).count() == 2
    assert dedup.flag_known(hot_posts(spark, make_posts), known).filter("is_duplicate").count() == 0


def test_store_survives_a_repeated_batch(spark, make_posts):
    store = dedup.FingerprintStore(spark, scratch_dir(spark, "store"))
    assert store.known().count() == 0
    first = make_posts({"username": "a"}, {"username": "b"})
    second = make_posts({"username": "b"}, {"username": "c"})
    store.commit(store.new_posts(first, 0), 0)
    for _ in range(2):
        fresh = store.new_posts(second, 1)
        assert [r.username for r in fresh.collect()] == ["c"]
        store.commit(fresh.select("*"), 1)
    assert store.known().count() == 3
    assert store.known(before_batch=1).count() == 2


def prints(spark, first, last):
    return spark.range(first, last).select(F.sha2(F.col("id").cast("string"), 256).alias("fingerprint"))


def test_a_batch_reads_only_matching_ranges(spark):
    """1 % of the history as new posts, and seven known ones: files of their ranges and few others are read."""
    store = dedup.FingerprintStore(spark, scratch_dir(spark, "store"))
    store.commit(prints(spark, 0, 60_000), 0)
    store.commit(prints(spark, 60_000, 100_000), 1)
    known = prints(spark, 10, 15).unionByName(prints(spark, 70_000, 70_002))
    asked = prints(spark, 500_000, 501_000).unionByName(known)
    ranges = store.matching_ranges(asked)
    hit = {(b, r) for b, rs in ranges.items() for r in rs}
    must = {(0, r.r) for r in prints(spark, 10, 15).selectExpr("left(fingerprint, 2) r").collect()}
    must |= {(1, r.r) for r in prints(spark, 70_000, 70_002).selectExpr("left(fingerprint, 2) r").collect()}
    assert must <= hit and len(hit) <= 30
    read = store.known_among(asked)
    files = {r.f for r in read.select(F.input_file_name().alias("f")).distinct().collect()}
    folders = {(int(f.split("batch=")[1][0]), f.split("range=")[1][:2]) for f in files}
    assert folders <= hit and len(files) <= 30 < 512
    assert sorted(r.fingerprint for r in asked.join(read, "fingerprint").collect()) == sorted(r.fingerprint for r in known.collect())
    assert set(store.matching_ranges(known, before_batch=1)) == {0}


def test_a_store_keeps_its_ranges(spark):
    path = scratch_dir(spark, "store")
    dedup.FingerprintStore(spark, path, digits=1).commit(prints(spark, 0, 100), 0)
    store = dedup.FingerprintStore(spark, path, digits=3)
    assert store.digits == 1 and store.batches() == {0}
    asked = prints(spark, 90, 110)
    assert asked.join(store.known_among(asked), "fingerprint").count() == 10


def test_features(make_posts):
    posts = make_posts(
        {"content": "bull bull bear", "likes": 2, "reposts": 2, "replies": 1, "hashtags": ["a"], "mentions": ["b", "c"]},
        {"content": "bullishness"},
        {"content": None},
    )
    a, b, c = features.extract_features(posts).orderBy("post_id").collect()
    assert (a.bullish_keyword_count, a.bearish_keyword_count, a.engagement_score) == (2, 1, 7.0)
    assert a.sentiment_score == pytest.approx(1 / 3)
    assert (a.tweet_length, a.word_count, a.hashtag_count, a.mention_count) == (14, 3, 1, 2)
    assert (b.sentiment_score, b.bullish_keyword_count) == (0.0, 0)
    assert (c.content, c.tweet_length, c.word_count, c.sentiment_score) == ("", 0, 0, 0.0)


def test_feature_column_order_and_own_lexicon(make_posts):
    df = features.extract_features(make_posts({"content": "up down up"}), bullish=["up"], bearish=["down"])
    assert df.columns[8:] == [
        "hashtags", "mentions", "engagement_score", "tweet_length", "word_count", "hashtag_count", "mention_count",
        "sentiment_score", "bullish_keyword_count", "bearish_keyword_count",
    ]
    row = df.first()
    assert (row.bullish_keyword_count, row.bearish_keyword_count) == (2, 1)


def test_posts_are_not_shuffled_to_meet_known_fingerprints(spark, make_posts, capsys):
    """Of 600 stored fingerprints 5 are among the posts: what both have is small enough to be broadcast."""
    store = dedup.FingerprintStore(spark, scratch_dir(spark, "fingerprints"), digits=1)
    posts = dedup.with_fingerprint(make_posts(*[{"content": f"post {i}"} for i in range(40)]))
    capsys.readouterr()
    store.new_posts(posts, 0).explain()
    assert "Exchange" not in capsys.readouterr().out
    others = spark.range(595).select(F.sha2(F.col("id").cast("string"), 256).alias("fingerprint"))
    store.commit(others.unionByName(posts.filter("post_id < 5").select("fingerprint")), 0)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10_000)
    try:
        new = store.new_posts(posts, 1)
        capsys.readouterr()
        new.explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert new.columns == posts.columns and sorted(r.post_id for r in new.collect()) == list(range(5, 40))

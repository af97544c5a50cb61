import hashlib
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from chatterlens.functions.numbers import parse_count
from chatterlens.operators import capture
from chatterlens.operators.ranking import first_n
from chatterlens.schema import CAPTURE_SCHEMA

NOW = datetime(2024, 1, 31, tzinfo=UTC)


def cards(spark, *rows):
    base = dict.fromkeys(CAPTURE_SCHEMA.fieldNames())
    full = [{**base, "ingest_seq": i, "hashtag": "#a", "time_attr": "2024-01-30T00:00:00.000Z", **r} for i, r in enumerate(rows)]
    return spark.createDataFrame(full, CAPTURE_SCHEMA)


def parse(spark, *rows, **options):
    return capture.parse_cards(cards(spark, *rows), NOW, 168, **options).orderBy("ingest_seq").collect()


@pytest.mark.parametrize(
    "label, count",
    [
        ("1.2K", 1200), ("3.4M", 3_400_000), ("2B", 2_000_000_000), ("1,200", 1200), ("45", 45), ("34 Likes", 34),
        ("1.2.3", 0), (".", 0), ("n/a", 0), (None, 0), ("", 0), ("12 more", 12_000_000), ("45 bookmarks", 45_000_000_000),
        ("1.005K", 1004), ("9" * 400, 0), ("x 7k y 8m", 7000), ("5.", 5),
    ],
)
def test_counts(spark, label, count):
    df = spark.createDataFrame([(label,)], "t string")
    assert df.select(parse_count(F.col("t"))).first()[0] == count


def test_strict_suffix(spark):
    df = spark.createDataFrame([("12 more",), ("1.2K",), ("3 M likes",)], "t string")
    assert [r[0] for r in df.select(parse_count(F.col("t"), strict_suffix=True)).collect()] == [12, 1200, 3_000_000]


def test_fields(spark):
    row = parse(
        spark,
        {
            "status_href": "/x/status/123?s=20", "user_text": "Ann\n@Ann_1 2h", "body_text": " Buy #Gold #gold @Me ",
            "like_text": " ", "like_aria": "34 Likes", "repost_text": "1.5K", "reply_aria": None,
        },
    )[0]
    assert (row.username, row.content, row.status_id) == ("Ann_1", "Buy #Gold #gold @Me", "123")
    assert (row.likes, row.reposts, row.replies) == (34, 1500, 0)
    assert (row.hashtags, row.mentions) == (["gold", "gold"], ["me"])
    assert row.ingest_key == hashlib.sha256(b"123").hexdigest()


def test_content_fallback_and_key_without_id(spark):
    row = parse(spark, {"full_text": "A\n@b\n c \n @kept", "user_text": "@Zed"})[0]
    assert row.content == "A c @kept"
    key = "zed:2024-01-30T00:00:00+00:00:A c @kept"
    assert row.ingest_key == hashlib.sha256(key.encode()).hexdigest()


def test_times_and_cutoff(spark):
    edge = (NOW - timedelta(hours=168)).isoformat()
    rows = parse(
        spark,
        {"time_attr": None, "body_text": "x"},
        {"time_attr": "junk", "body_text": "x"},
        {"time_attr": edge, "body_text": "x"},
        {"time_attr": "2024-01-23T23:59:59Z", "body_text": "x"},
        {"time_attr": "2024-01-30T00:00:00", "body_text": "no offset"},
        {"time_attr": "2024-01-30T05:30:00+05:30", "body_text": "x"},
        {"time_attr": "2024-1-30", "body_text": "x"},
    )
    assert [r.ingest_seq for r in rows] == [0, 1, 2, 3, 5, 6] or [r.ingest_seq for r in rows] == [0, 1, 2, 5, 6]
    rows = {r.ingest_seq: r for r in rows}
    micros = {k: v.ingest_key for k, v in rows.items()}
    assert micros[0] == micros[1] == micros[6]  # all take the run's now
    assert 4 not in rows


def test_empty_cards_of_unknown_users_are_dropped(spark):
    rows = parse(spark, {"user_text": "nobody"}, {"user_text": "@x"}, {"user_text": None, "body_text": "t"})
    assert [(r.username, r.content) for r in rows] == [("x", ""), ("unknown", "t")]


def test_dedup_seen_and_counts(spark):
    rows = [
        {"status_href": "/status/1", "body_text": "a"},
        {"status_href": "/status/1", "body_text": "b", "hashtag": "#b"},
        {"status_href": "/status/2", "body_text": "c"},
        {"body_text": "d"},
        {"body_text": "d"},
    ]
    parsed = capture.parse_cards(cards(spark, *rows), NOW, 168)
    assert {r.content for r in capture.first_capture(parsed).collect()} == {"a", "c", "d"}
    assert tuple(capture.capture_counts(parsed).first()) == (5, 3, 2)
    seen = spark.createDataFrame([("1",)], "status_id string")
    left = capture.parse_cards(cards(spark, *rows), NOW, 168, seen_status=seen)
    assert sorted(r.content for r in left.collect()) == ["c", "d", "d"]


def test_collect_posts(spark):
    rows = [{"hashtag": f"#{'ab'[i % 2]}", "status_href": f"/status/{i}", "body_text": "t"} for i in range(20)]
    seen = Observation()
    posts = capture.collect_posts(cards(spark, *rows), ["a", "#b"], 6, NOW, 168, observation=seen)
    assert sorted(r.ingest_seq for r in posts.collect()) == [0, 1, 2, 3, 4, 5]
    assert seen.get == {"saved": 6}
    few = capture.collect_posts(cards(spark, *rows), ["a", "#b"], 1, NOW, 168)
    assert [r.ingest_seq for r in few.collect()] == [0]


def test_search_tags(make_posts):
    assert capture.normalise_search_tags([" x ", "#y", "", None]) == ["#x", "#y"]
    with pytest.raises(ValueError):
        capture.normalise_search_tags([" "])
    posts = make_posts({"hashtags": ["gold"]}, {"hashtags": ["tin"]}, {"hashtags": []})
    assert capture.with_topic(posts, ["#Gold"]).count() == 1
    with pytest.raises(ValueError):
        capture.union_captures([])


def test_pages(spark):
    wall, mark = '<button data-testid="loginButton">', '<article data-testid="tweet">'
    pages = spark.createDataFrame(
        [
            (1, "https://x/Login?next", mark),
            (2, "https://x/a", wall + "try again later"),
            (3, "https://x/a", "<p>Rate <b>limit</b> exceeded</p>"),
            (4, "https://x/a", "<script>something went wrong</script>" + mark),
            (5, None, None),
            (6, "https://x/a", '<a class="q" href="https://x/login">'),
        ],
        "page_id bigint, url string, html string",
    )
    got = {r.page_id: (r.page_status, r.usable) for r in capture.page_checks(pages).collect()}
    assert got[1] == got[2] == got[6] == ("LOGIN_REQUIRED", False)
    assert got[4] == ("OK", True) and got[5] == ("OK", False)
    assert got[3] == ("RATE_LIMITED", False)


@pytest.mark.parametrize(
    "html, status, usable",
    [
        ("<div>Try <b></b>again later</div>", "RATE_LIMITED", False),
        ("something\n went&nbsp;wrong", "RATE_LIMITED", False),
        ("<p>Rate</p><P>LIMIT</P>exceeded", "RATE_LIMITED", False),
        ("<i>some</i>thing went wrong", "RATE_LIMITED", False),
        ("some<br>thing went wrong", "OK", False),
        ("<!-- try again later --><article class=x data-testid='tweet'>", "OK", True),
        ("<ARTICLE DATA-TESTID=tweet>", "OK", True),
        ('<style>try again later</style><p data-testid="tweet">', "OK", False),
        ("<a href='/login'>", "LOGIN_REQUIRED", False),
        ("<A HREF = /i/login>", "LOGIN_REQUIRED", False),
        ("<script>'<a href=\"/login\">'</script>", "OK", False),
        ("<i data-testid='sheetDialog'>", "LOGIN_REQUIRED", False),
        ("<!-- never closed <a href='/login'>", "OK", False),
        ("", "OK", False),
    ],
)
def test_pages_as_a_reader_sees_them(spark, html, status, usable):
    row = capture.page_checks(spark.createDataFrame([("https://x/a", html)], "url string, html string")).first()
    assert (row.page_status, row.usable) == (status, usable)
    assert set(row.asDict()) == {"url", "html", "page_status", "usable"}


@pytest.mark.parametrize("n", [0 + 1, 3, 1500, 2999, 3000, 50_000])
@pytest.mark.parametrize("by", [None, "k"])
def test_first_n_is_exact_on_skewed_data(spark, n, by):
    """One key holds most rows, the order column is far from uniform, one key is NULL."""
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit("b")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.lit("hot")).alias("k"),
        F.when(F.col("id") < 10, F.col("id")).otherwise(F.lit(2**60) + F.hash("id").cast("bigint") * F.lit(7919) + F.col("id")).alias("ingest_seq"),
    )
    rows = sorted((r.ingest_seq, r.k) for r in df.collect()) if by is None else None
    if by is None:
        expected = rows[:n]
    else:
        groups = {}
        for r in df.collect():
            groups.setdefault(r.k, []).append(r.ingest_seq)
        expected = [(s, k) for k, v in groups.items() for s in sorted(v)[:n]]
    got = [(r.ingest_seq, r.k) for r in first_n(df, n, by, buckets=16).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def in_order(row):
    """Missing values first, NaN last."""
    return tuple((0, 0) if v is None else (2, 0) if v != v else (1, v) for v in row)


@pytest.mark.parametrize("n", [1, 700, 1200, 2500, 5200, 9000])
@pytest.mark.parametrize("by", [None, "k"])
@pytest.mark.parametrize("ranked_rows", [3, 100_000])
def test_ties_are_settled_by_the_next_column(spark, n, by, ranked_rows):
    """Few different values, missing, infinite and NaN ones; rows that tie in the second column too are alike."""
    value = (
        F.when(F.col("id") % 97 == 0, F.lit(None)).when(F.col("id") % 89 == 0, F.lit(float("nan")))
        .when(F.col("id") % 83 == 0, F.lit(float("-inf"))).when(F.col("id") % 79 == 0, F.lit(float("inf")))
        .when(F.col("id") % 3 == 0, F.lit(0.5)).otherwise(F.pmod(F.hash("id"), F.lit(5)).cast("double"))
    )
    df = spark.range(8000).select(
        F.when(F.col("id") % 4 == 0, F.lit("b")).otherwise(F.lit("hot")).alias("k"),
        value.alias("value"),
        F.pmod(F.hash(F.col("id") + 1), F.lit(40)).alias("second"),
        F.create_map(F.lit("a"), F.lit("b")).alias("unordered"),
    )
    rows, expected = [(r.value, r.second, r.k) for r in df.collect()], []
    for k in ("b", "hot") if by else (None,):
        mine = [r for r in rows if k is None or r[2] == k]
        expected += sorted(mine, key=lambda r: in_order(r[:2]))[:n]
    for parts in (1, 5):
        got = first_n(df.repartition(parts), n, by, "value", ["second"], buckets=16, ranked_rows=ranked_rows)
        assert got.columns == df.columns
        got = [(r.value, r.second, r.k) for r in got.collect()]
        if by is None:  # keys of rows that tie go by digest
            got, want = [r[:2] for r in got], [r[:2] for r in expected]
        else:
            want = expected
        assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_rows_that_tie_go_alike_in_every_partitioning(spark):
    df = spark.range(4000).select((F.col("id") % 3).alias("ingest_seq"), F.col("id").alias("post_id"), F.concat(F.lit("t"), "id").alias("content"))
    for n in (500, 1700):
        got = [sorted(r.post_id for r in first_n(df.repartition(p), n, ranked_rows=50).collect()) for p in (1, 3, 7)]
        assert len(got[0]) == n and got[0] == got[1] == got[2]


def test_what_is_ranked_does_not_grow(spark):
    """Of rows that all tie in the order column, a quota's end is ranked among few."""
    from chatterlens.operators import ranking

    for size in (20_000, 200_000):
        places = spark.range(size).select(F.lit(0).alias("key"), F.lit(7).cast("bigint").alias("l0"), F.xxhash64("id").alias("l1"))
        cut = ranking._cuts(places, size // 2, 64, 1000).collect()
        assert [(c.l0, c.take, c.alike) for c in cut] == [(7, 1, 1)]
        assert places.filter(F.col("l1") <= cut[0].l1).count() == size // 2


def test_large_quotas_need_numbers(spark):
    with pytest.raises(ValueError, match="numbers"):
        first_n(spark.range(10).select(F.col("id").cast("string").alias("ingest_seq")), 2000)

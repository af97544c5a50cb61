"""Post, card and page tables derived from the driver's tables; whole tables and whole texts.

``oracle.py`` states the same views as SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterlens.functions.times import ntz_to_utc
from chatterlens.operators.dedup import with_fingerprint
from chatterlens.operators.capture import status_id
from chatterlens.operators.normalize import normalise_posts
from chatterlens.schema import CAPTURE_SCHEMA, POST_COLUMNS

PHRASES = {
    "view": "Warehouse stock   counted twice, no change in the forecast #sensex",
    "click": "Parcel volumes up: bullish breakout for carriers, buy on dips https://example.com/a?b=1 #sensex",
    "signup": "New supplier joins; long term support for prices, profit expected #Nifty50 #intraday",
    "purchase": "Order filled at the low, target and stoploss noted @Desk #nifty50",
    "error": "Shipment lost again, traders sell and short the line: bearish, loss likely #BankNifty",
}

# Page endings that do, or only seem to, show a rate limit, a login wall or a post.
LIMIT_TAILS = (
    "<div>Try <b></b>again later</div>",
    "Something&nbsp;went\n  wrong",
    "<P>RATE <EM class='x'>limit</EM> exceeded</P>",
    '<script>var m = "try again later";</script>',
    "<!-- something went wrong -->",
    "<p>Try</p><p>again later</p>",
    "<p>Try a</p><p>gain later</p>",
)
WALL_TAILS = (
    '<button data-testid="loginButton">',
    "<div DATA-TESTID='sheetDialog'>",
    "<A class=q href=/login>",
    """<script>x = '<a href="/login">'</script>""",
    "<a href='/logout' title='/login'>",
)
POST_TAILS = (
    '<article role="x" data-testid="tweet"></article>',
    "<ARTICLE data-testid='tweet'>",
    '<!-- <article data-testid="tweet"> -->',
    '<style>article[data-testid="tweet"]{}</style>',
)


def as_of() -> Column:
    return F.expr("TIMESTAMP'2024-01-31 00:00:00Z'")


def batch_start() -> Column:
    """Posts before this moment count as an earlier batch."""
    return F.expr("TIMESTAMP'2024-01-10 00:00:00Z'")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. One with a single file may be one scan task: its rows are dealt out to all cores.

    Tables of several files, as at scale, are left as the scan splits them.
    """
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return rows.repartition(spark.sparkContext.defaultParallelism) if len(rows.inputFiles()) == 1 else rows


def phrase() -> Column:
    out = F.lit(None).cast("string")
    for event_type, text in PHRASES.items():
        out = F.when(F.col("event_type") == event_type, F.lit(text)).otherwise(out)
    return out


def lot() -> Column:
    return F.floor("value").cast("bigint")


def _post(seq: Column, username: Column, content: Column, likes: Column, tags: Column, mentions: Column) -> list[Column]:
    return [
        seq.alias("post_id"),
        seq.alias("ingest_seq"),
        username.alias("username"),
        ntz_to_utc(F.col("ts")).alias("timestamp"),
        content.alias("content"),
        likes.alias("likes"),
        (F.col("user_id") % 11).alias("replies"),
        (F.col("event_id") % 23).alias("reposts"),
        tags.cast("array<string>").alias("hashtags"),
        mentions.cast("array<string>").alias("mentions"),
    ]


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One short post per event, one copy per purchase, one long post per document and per page."""
    events = table(spark, sf_dir, "events")
    user = F.col("user_id").cast("string")
    tags = F.array(F.concat(F.lit("#"), F.upper("event_type")), F.lit(" #Lot "), F.lit(" "))
    mentions = F.array(F.concat(F.lit("@U"), user))
    short = F.concat(F.lit("  "), phrase(), F.lit(" lot "), lot().cast("string"), F.lit("\n"))

    own = F.col("copy") == 0
    feed = events.withColumn(
        "copy", F.explode(F.when(F.col("event_type") == "purchase", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    ).select(
        _post(
            F.col("event_id") * 4 + F.col("copy"),
            F.concat(F.when(own, F.lit(" u")).otherwise(F.lit("U")), user),
            F.when(own, short).otherwise(F.upper(short)),
            F.when(own, lot() - 5).otherwise(lot() + 1),
            tags,
            mentions,
        )
    )
    notes = (
        table(spark, sf_dir, "documents")
        .join(events, F.col("doc_id") == F.col("event_id"), "left")
        .select(
            _post(
                F.col("doc_id") * 4 + 2,
                F.concat(F.lit("desk"), user),
                F.concat(F.col("text"), F.lit(" "), phrase()),
                lot(),
                F.array(F.concat(F.lit("#"), F.col("source")), F.upper("lang")),
                F.array(),
            )
        )
    )
    web = (
        table(spark, sf_dir, "pages")
        .join(events, F.col("page_id") == F.col("event_id"), "left")
        .select(
            _post(
                F.col("page_id") * 4 + 3,
                F.concat(F.lit("web"), user),
                F.concat(F.col("html"), F.lit(" "), phrase()),
                lot(),
                F.array(F.lit("web")),
                F.array(),
            )
        )
    )
    return feed.unionByName(notes).unionByName(web).select(POST_COLUMNS)


def spoilt_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as posts in text form, some with a key or a count that cannot be read."""
    likes = F.floor("value").cast("string")
    return table(spark, sf_dir, "events").select(
        F.concat(F.when(F.col("value") < 4, F.lit("no ")).otherwise(F.lit("")), F.col("event_id").cast("string")).alias("post_id"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("username"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_type") == "error", F.concat(likes, F.lit("x"))).when(F.col("value") < 90, likes).alias("likes"),
    )


def emptied(posts: DataFrame) -> DataFrame:
    """Posts with many likes have nothing but a link."""
    return posts.withColumn("content", F.when(F.col("likes") >= 90, F.lit("https://x.example/a")).otherwise(F.col("content")))


def known_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of the posts of the earlier batch."""
    earlier = normalise_posts(posts(spark, sf_dir)).filter(F.col("timestamp") < batch_start())
    return with_fingerprint(earlier).select("fingerprint").distinct()


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One captured card per event, and a second capture of each purchase."""
    events = table(spark, sf_dir, "events")
    value, k, event_type = F.col("value"), lot().cast("string"), F.col("event_type")
    user = F.concat(F.lit("@u"), F.col("user_id").cast("string"))
    moment = F.concat(F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))
    no_body = event_type.isin("signup", "error")

    def cards(seq: Column, rows: DataFrame) -> DataFrame:
        return rows.select(
            seq.alias("ingest_seq"),
            F.concat(F.lit("#"), event_type).alias("hashtag"),
            F.when(event_type != "view", F.concat(F.lit("/x/status/"), F.col("event_id").cast("string"))).alias(
                "status_href"
            ),
            F.when(value < 3, F.lit("no handle here")).otherwise(F.concat(F.lit("Name "), user)).alias("user_text"),
            F.when(value > 120, F.lit(None))
            .when(value > 100, F.lit("yesterday"))
            .when(value > 95, F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T")))
            .otherwise(moment)
            .alias("time_attr"),
            F.when(no_body, F.lit("")).otherwise(F.concat(F.lit(" "), phrase())).alias("body_text"),
            F.when((event_type == "error") & (value < 3), F.concat(user, F.lit("\n  \n")))
            .otherwise(F.concat(F.lit(" Name\n"), user, F.lit("\n  @inner \n \n"), phrase(), F.lit("  \n"), k))
            .alias("full_text"),
            F.lit("").alias("reply_text"),
            F.concat(k, F.lit(" Replies. Reply")).alias("reply_aria"),
            F.when(value < 40, F.lit("n/a")).otherwise(F.concat(k, F.lit(" more"))).alias("repost_text"),
            F.lit(None).cast("string").alias("repost_aria"),
            F.when(value < 5, F.lit("  "))
            .when(value < 10, F.concat(k, F.lit(".5K")))
            .when(value < 20, F.concat(F.lit("1,2"), k))
            .when(value < 30, F.lit("3.4 M"))
            .when(value < 35, F.lit("1.2.3"))
            .otherwise(k)
            .alias("like_text"),
            F.concat(k, F.lit(" Likes")).alias("like_aria"),
        )

    again = events.filter(event_type == "purchase")
    return (
        cards(F.col("event_id") * 2, events)
        .unionByName(cards(F.col("event_id") * 2 + 1, again))
        .select(CAPTURE_SCHEMA.fieldNames())
    )


def seen_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status ids of the cards captured before the current batch."""
    events = table(spark, sf_dir, "events").filter(ntz_to_utc(F.col("ts")) < batch_start())
    return events.select(status_id(F.concat(F.lit("/status/"), F.col("event_id").cast("string"))).alias("status_id"))


def page_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with login, rate-limit and usable marks added by language, address and id."""
    url, page = F.col("url"), F.col("html")

    def with_tail(tails: tuple[str, ...]) -> Column:
        return F.concat(page, F.get(F.array(*[F.lit(t) for t in tails]), (F.col("page_id") % len(tails)).cast("int")))

    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.when(url.contains("/fr"), F.concat(url, F.lit("/Login"))).otherwise(url).alias("url"),
        F.when(url.contains("/de"), with_tail(LIMIT_TAILS))
        .when(url.contains("/es"), with_tail(WALL_TAILS))
        .when(url.contains("page="), with_tail(POST_TAILS))
        .otherwise(page)
        .alias("html"),
    )

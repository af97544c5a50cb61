"""The registered queries: one or more per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from chatterlens.functions import text, times, unicode
from chatterlens.operators import capture, charts, clean, dedup, features, keywords, normalize, signal
from chatterlens.options import JobOptions
from chatterlens.plans import runs, signals, views
from chatterlens.schema import KEYWORD_SCHEMA
from chatterlens.session import scratch_dir, stored
from chatterlens.sources import posts as post_io
from chatterlens.sources import results, sample
from chatterlens.streaming import stateful

Query = Callable[[SparkSession, str], DataFrame]
CUTOFF_HOURS = 168
_QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _QUERIES[name] = fn
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# Result columns the SQL twins can be compared with.


def joined(name: str) -> Column:
    return F.array_join(name, "|").alias(name)


def wall(name: str = "timestamp") -> Column:
    return times.utc_to_ntz(F.col(name)).alias(name)


def rounded(name: str, digits: int = 6) -> Column:
    return F.round(name, digits).alias(name)


def post_out() -> list:
    return [
        "ingest_seq",
        "username",
        wall(),
        "content",
        "likes",
        "replies",
        "reposts",
        joined("hashtags"),
        joined("mentions"),
    ]


def normalised(spark, sf):
    return normalize.normalise_posts(views.posts(spark, sf))


def texts(spark, sf):
    """Normalised posts with cleaned text, blank ones kept."""
    return normalised(spark, sf).withColumn("content", clean.clean_text(F.col("content")))


def cleaned(spark, sf):
    return clean.clean_posts(normalised(spark, sf))


def printed(spark, sf):
    return dedup.with_fingerprint(cleaned(spark, sf))


def unique(spark, sf):
    return signals.prepared_posts(views.posts(spark, sf)).drop("fingerprint")


def featured(spark, sf):
    return features.extract_features(unique(spark, sf))


def scored(spark, sf):
    return signals.scored_posts(unique(spark, sf))


def summed(spark, sf):
    return signals.signal_summary(views.posts(spark, sf))


def parsed_cards(spark, sf, **options):
    return capture.parse_cards(views.captures(spark, sf), views.as_of(), CUTOFF_HOURS, **options)


def texts_table(spark, sf):
    return stored(unique(spark, sf).select("post_id", "content", "hashtags"), "texts")


def model(spark, sf):
    return keywords.fit(texts_table(spark, sf), max_features=50)


def vocabulary(spark, sf):
    return keywords.vocabulary(texts_table(spark, sf), 50)


def terms(spark, sf):
    return keywords.with_terms(keywords.documents(unique(spark, sf)))


def stored_terms(spark, sf):
    return keywords.with_terms(keywords.documents(texts_table(spark, sf)))


# Sources and sinks


@query("s01_scan_posts")
def _(spark, sf):
    path = post_io.write_posts(views.posts(spark, sf), scratch_dir(spark, "posts"))
    return post_io.read_posts(spark, path).select(post_out())


@query("s02_scan_normalised")
def _(spark, sf):
    path = post_io.write_posts(views.posts(spark, sf), scratch_dir(spark, "posts"))
    return post_io.read_normalised_posts(spark, path).select(post_out())


@query("s03_write_batch")
def _(spark, sf):
    path = scratch_dir(spark, "batches")
    for mode in ("overwrite", "append"):
        post_io.write_posts(normalised(spark, sf), path, compression="gzip", mode=mode)
    return post_io.read_posts(spark, path).select(post_out())


@query("s04_cast_schema")
def _(spark, sf):
    return normalize.conform(views.spoilt_posts(spark, sf)).withColumn("timestamp", wall())


@query("s05_empty_batch")
def _(spark, sf):
    batches = {"kept": normalised(spark, sf), "negative": normalised(spark, sf).filter(F.col("likes") < 0)}
    stored = [
        post_io.read_posts(spark, post_io.write_posts(rows, scratch_dir(spark, name))).agg(
            F.lit(name).alias("batch"), F.count(F.lit(1)).alias("posts")
        )
        for name, rows in batches.items()
    ]
    return stored[0].unionByName(stored[1])


@query("s06_features_csv")
def _(spark, sf):
    path = scratch_dir(spark, "features")
    matrix = featured(spark, sf).select(
        "post_id",
        "username",
        "timestamp",
        "content",
        "likes",
        "hashtags",
        "mentions",
        "engagement_score",
        "word_count",
        "sentiment_score",
    )
    results.write_features_csv(matrix, path)
    stored = results.read_features_csv(
        spark,
        path,
        "post_id bigint, username string, timestamp string, content string, likes bigint, hashtags string, mentions string, "
        "engagement_score double, word_count int, sentiment_score double",
    )
    return stored.withColumns({c: F.round(c, 6) for c in ("engagement_score", "sentiment_score")})


@query("s07_keywords_json")
def _(spark, sf):
    top = keywords.top_keywords(texts_table(spark, sf), 10, 50)
    path = results.write_json(top, scratch_dir(spark, "keywords"))
    return results.read_keywords(spark, path).select("keyword", rounded("score"))


@query("s08_summary_json")
def _(spark, sf):
    summary = summed(spark, sf)
    path = results.write_json(summary, scratch_dir(spark, "summary"))
    return spark.read.schema(summary.schema).json(path)


def with_untagged(df):
    tags = F.when(F.col("likes") % 5 == 0, F.array().cast("array<string>")).otherwise(F.col("hashtags"))
    return df.withColumn("hashtags", tags)


def lake_counts(lake):
    return lake.groupBy("date", "hashtag").agg(F.count(F.lit(1)).alias("posts"), F.count_distinct("post_id").alias("distinct_posts"))


@query("s09_lake_by_date_and_hashtag")
def _(spark, sf):
    path = post_io.write_lake(stored(with_untagged(unique(spark, sf)), "unique"), scratch_dir(spark, "lake"))
    return lake_counts(post_io.read_lake(spark, path))


@query("s09_lake_in_batches")
def _(spark, sf):
    """Two batches, the second one run twice, equal one run over all."""
    rows = stored(with_untagged(unique(spark, sf)), "unique")
    path, earlier = scratch_dir(spark, "lake"), F.col("timestamp") < views.batch_start()
    for batch, part in ((0, earlier), (1, ~earlier), (1, ~earlier)):
        post_io.write_lake(rows.filter(part), path, batch, own_folders=2, shared_folders=2)
    return lake_counts(post_io.read_lake(spark, path))


@query("s09_lake_of_one_hashtag")
def _(spark, sf):
    """What the folders that may hold a hashtag have of it, for a frequent and a rare one."""
    path = post_io.write_lake(stored(unique(spark, sf), "unique"), scratch_dir(spark, "lake"), own_folders=1)
    frequent, rare = (post_io.read_lake(spark, path, tag) for tag in ("sensex", "desk"))
    return frequent.unionByName(rare).select("hashtag", *post_out())


@query("s10_sample_posts")
def _(spark, sf):
    events = views.table(spark, sf, "events")
    total = events.agg(F.count(F.lit(1))).scalar()
    made = sample.sample_posts(events.select(F.col("event_id").alias("id")), total, views.as_of(), seed=7)
    return made.select(post_out())


@query("s11_posts_or_sample")
def _(spark, sf):
    chosen = sample.posts_or_sample(normalised(spark, sf), 2000, views.as_of())
    return chosen.select(post_out())


@query("s11_sample_where_empty")
def _(spark, sf):
    """As many sample posts as there are events, in place of posts that no filter leaves."""
    events = views.table(spark, sf, "events").count()
    chosen = sample.posts_or_sample(normalised(spark, sf).filter(F.col("likes") < 0), events, views.as_of(), seed=7)
    return chosen.select(post_out())


@query("s12_json_codec")
def _(spark, sf):
    return post_io.from_json_lines(post_io.to_json_lines(normalised(spark, sf))).select(post_out())


@query("s12_json_files")
def _(spark, sf):
    """Posts through files of JSON lines into the pipeline."""
    path = post_io.write_json_posts(normalised(spark, sf), scratch_dir(spark, "lines"))
    return signals.prepared_posts(post_io.read_json_posts(spark, path)).select("post_id", *post_out(), "fingerprint")


@query("s12_json_without_keys")
def _(spark, sf):
    """Records without keys, in files in order: the place of a line is its key, and first copies stay first."""
    rows = stored(normalised(spark, sf), "posts").orderBy("ingest_seq")
    path = post_io.write_json_posts(rows, scratch_dir(spark, "lines"), keyed=False, compression="gzip")
    return signals.prepared_posts(post_io.read_json_posts(spark, path)).select(*post_out()[1:], "fingerprint")


@query("s12_json_rejects")
def _(spark, sf):
    rows = normalised(spark, sf)
    popular = F.get_json_object("value", "$.likes").cast("bigint") >= 100
    spoilt = F.regexp_replace("value", '"timestamp":"', '"timestamp":"on ')
    lines = post_io.to_json_lines(rows)
    broken = lines.withColumn("value", F.when(popular, spoilt).otherwise(F.col("value")))
    key = F.get_json_object("value", "$.post_id").cast("bigint").alias("post_id")
    return post_io.rejected_json_lines(broken).select(key)


@query("s13_raw_capture_zone")
def _(spark, sf):
    path = post_io.write_captures(views.captures(spark, sf), scratch_dir(spark, "raw"))
    return post_io.read_captures(spark, path)


# Captured cards


@query("r01_handle")
def _(spark, sf):
    return views.captures(spark, sf).select("ingest_seq", capture.handle(F.col("user_text")).alias("username"))


def timed_cards(spark, sf):
    moment = capture.card_time(F.col("time_attr"), views.as_of())
    return views.captures(spark, sf).select("ingest_seq", moment.alias("timestamp"))


@query("r02_card_time")
def _(spark, sf):
    return timed_cards(spark, sf).select("ingest_seq", wall())


@query("r03_recent_cards")
def _(spark, sf):
    return capture.recent_cards(timed_cards(spark, sf), views.as_of(), CUTOFF_HOURS).select("ingest_seq", wall())


def read_cards(spark, sf):
    return views.captures(spark, sf).select(
        "ingest_seq",
        capture.handle(F.col("user_text")).alias("username"),
        capture.card_content(F.col("body_text"), F.col("full_text")).alias("content"),
    )


@query("r04_card_content")
def _(spark, sf):
    return read_cards(spark, sf).select("ingest_seq", "content")


@query("r05_usable_cards")
def _(spark, sf):
    return capture.usable_cards(read_cards(spark, sf))


@query("r06_status_id")
def _(spark, sf):
    return views.captures(spark, sf).select("ingest_seq", capture.status_id(F.col("status_href")).alias("status_id"))


@query("r07_ingest_key")
def _(spark, sf):
    return parsed_cards(spark, sf).select("ingest_seq", "ingest_key")


@query("r08_first_capture")
def _(spark, sf):
    return capture.first_capture(parsed_cards(spark, sf)).select("ingest_seq", "ingest_key", "username", "likes")


@query("r08_capture_counts")
def _(spark, sf):
    return capture.capture_counts(parsed_cards(spark, sf))


@query("r09_metric_source")
def _(spark, sf):
    like, aria = F.col("like_text"), F.col("like_aria")
    label = capture.metric_source(like, aria).alias("label")
    return views.captures(spark, sf).select("ingest_seq", label, capture.metric(like, aria).alias("likes"))


@query("r10_parse_counts")
def _(spark, sf):
    sources = {"likes": "like_text", "replies": "reply_aria", "reposts": "repost_text"}
    counts = [capture.parse_count(F.col(c)).alias(name) for name, c in sources.items()]
    return views.captures(spark, sf).select("ingest_seq", *counts)


@query("r11_card_tags")
def _(spark, sf):
    return parsed_cards(spark, sf).select("ingest_seq", joined("hashtags"), joined("mentions"))


@query("r12_page_status")
def _(spark, sf):
    return capture.page_checks(views.page_cards(spark, sf)).select("page_id", "page_status")


@query("r13_page_usable")
def _(spark, sf):
    return capture.page_checks(views.page_cards(spark, sf)).select("page_id", "usable")


@query("r14_unseen_cards")
def _(spark, sf):
    cards = views.captures(spark, sf).select("ingest_seq", capture.status_id(F.col("status_href")).alias("status_id"))
    return capture.drop_seen(cards, views.seen_status(spark, sf))


@query("r15_hashtag_quota")
def _(spark, sf):
    return capture.cap_per_hashtag(capture.first_capture(parsed_cards(spark, sf)), 50).select("ingest_seq", "hashtag")


@query("r15_large_quota")
def _(spark, sf):
    return capture.cap_per_hashtag(views.captures(spark, sf).select("ingest_seq", "hashtag"), 1500)


QUOTAS = (999, 1000, 1001, 7000)


def cards_without_order(spark, sf):
    """Cards, some without an order value: those come first."""
    order = F.when(F.coalesce(F.length("time_attr"), F.lit(0)) > 0, F.col("ingest_seq")).alias("ingest_seq")
    return views.captures(spark, sf).select("hashtag", order)


def each_quota(cap):
    merged = None
    for n in QUOTAS:
        part = cap(n).select(F.lit(n).alias("quota"), "ingest_seq", "hashtag")
        merged = part if merged is None else merged.unionByName(part)
    return merged


@query("r15_quotas_around_the_limit")
def _(spark, sf):
    cards = cards_without_order(spark, sf)
    return each_quota(lambda n: capture.cap_per_hashtag(cards, n))


@query("r16_caps_around_the_limit")
def _(spark, sf):
    """Cards in an order that is missing on one hashtag's late cards only, so that equal ones are alike."""
    late = (F.col("hashtag") == "#error") & F.col("time_attr").isNull()
    cards = views.captures(spark, sf).select("hashtag", F.when(~late, F.col("ingest_seq")).alias("ingest_seq"))
    return each_quota(lambda n: capture.cap_total(cards, n))


def cards_that_tie(spark, sf):
    """Cards in lots of equal order; within a lot the last one comes first."""
    lot, back = F.expr("ingest_seq div 64").alias("lot"), (-F.col("ingest_seq")).alias("back")
    return views.captures(spark, sf).select("hashtag", "ingest_seq", lot, back)


@query("r15_tied_quotas")
def _(spark, sf):
    cards = cards_that_tie(spark, sf)
    return each_quota(lambda n: capture.cap_per_hashtag(cards, n, "lot", ["back"]))


@query("r16_tied_caps")
def _(spark, sf):
    cards = cards_that_tie(spark, sf)
    return each_quota(lambda n: capture.cap_total(cards, n, "lot", ["back"]))


@query("r16_total_cap")
def _(spark, sf):
    return capture.cap_total(capture.first_capture(parsed_cards(spark, sf)), 120).select("ingest_seq", "hashtag")


@query("r16_large_cap")
def _(spark, sf):
    return capture.cap_total(views.captures(spark, sf).select("ingest_seq", "hashtag"), 5000)


@query("r17_union_searches")
def _(spark, sf):
    cards = views.captures(spark, sf)
    searches = [cards.filter(F.col("hashtag") == f"#{event_type}") for event_type in views.PHRASES]
    return capture.union_captures(searches).select("ingest_seq", "hashtag", "user_text")


@query("r18_collect_posts")
def _(spark, sf):
    tags = ["click", " #view", "#error"]
    got = capture.collect_posts(views.captures(spark, sf), tags, 300, views.as_of(), CUTOFF_HOURS)
    return got.select(post_out())


@query("r18_run_counts")
def _(spark, sf):
    """What a run over all hashtags observes: cards read, unique ones, duplicates, posts saved without a cap."""
    seen = [Observation(name) for name in ("saved", "distinct", "cards")]
    got = capture.collect_posts(views.captures(spark, sf), list(views.PHRASES), None, views.as_of(), CUTOFF_HOURS, None, *seen)
    got.write.format("noop").mode("overwrite").save()
    saved, unique, cards = (o.get[k] for o, k in zip(seen, ("saved", "unique", "cards")))
    row = (cards, unique, cards - unique, saved)
    return spark.createDataFrame([row], "cards bigint, unique_cards bigint, duplicates bigint, saved bigint")


@query("r19_topic_filter")
def _(spark, sf):
    return capture.with_topic(cleaned(spark, sf), [" #sensex", "BankNifty", " "]).select("post_id", "username")


# Normalisation


@query("n01_strip")
def _(spark, sf):
    return normalised(spark, sf).select("post_id", "username", "content")


@query("n02_clamp_counts")
def _(spark, sf):
    return normalised(spark, sf).select("post_id", "likes", "replies", "reposts")


@query("n03_normalise_hashtags")
def _(spark, sf):
    return normalised(spark, sf).select("post_id", joined("hashtags"))


@query("n04_normalise_mentions")
def _(spark, sf):
    return normalised(spark, sf).select("post_id", joined("mentions"))


def cards_as_posts(spark, sf):
    """Cards with their time as read, NULL where it cannot be compared: input of the quarantine."""
    return timed_cards(spark, sf).withColumns({"username": F.lit("u"), "content": F.lit("c")})


@query("n05_quarantine")
def _(spark, sf):
    rows = cards_as_posts(spark, sf)
    valid = normalize.valid_posts(rows).select("ingest_seq", F.lit("").alias("missing"))
    return valid.unionByName(normalize.rejected_posts(rows).select("ingest_seq", joined("missing")))


# Cleaning


@query("c01_unescape_html")
def _(spark, sf):
    return views.table(spark, sf, "pages").select("page_id", unicode.unescape_html(F.col("html")).alias("html"))


@query("c02_drop_urls")
def _(spark, sf):
    return normalised(spark, sf).select("post_id", text.drop_urls(F.col("content")).alias("content"))


# Every visible ASCII character and its full-width form.
NARROW = "".join(chr(c) for c in range(0x21, 0x7F))
WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F))


@query("c03_nfkc")
def _(spark, sf):
    """Letters, digits and marks are widened to their compatibility forms; NFKC must give the text back."""
    wide = F.translate("text", NARROW, WIDE)
    return views.table(spark, sf, "documents").select("doc_id", unicode.nfkc(wide).alias("text"))


@query("c04_drop_controls")
def _(spark, sf):
    return views.table(spark, sf, "documents").select("doc_id", text.drop_controls(F.col("text")).alias("text"))


@query("c05_collapse_space")
def _(spark, sf):
    return views.table(spark, sf, "documents").select("doc_id", text.collapse_space(F.col("text")).alias("text"))


@query("c06_clean_text")
def _(spark, sf):
    return texts(spark, sf).select("post_id", "content")


@query("c07_extract_hashtags")
def _(spark, sf):
    tags = text.unique_tags(F.col("content"), text.HASHTAG).alias("hashtags")
    return texts(spark, sf).select("post_id", tags).select("post_id", joined("hashtags"))


@query("c08_extract_mentions")
def _(spark, sf):
    tags = text.unique_tags(F.col("content"), text.MENTION).alias("mentions")
    return texts(spark, sf).select("post_id", tags).select("post_id", joined("mentions"))


@query("c09_merge_tags")
def _(spark, sf):
    return cleaned(spark, sf).select("post_id", joined("hashtags"), joined("mentions"))


@query("c10_drop_empty")
def _(spark, sf):
    """All documents, and for each a bare address that cleaning empties."""
    link = F.struct((-1 - F.col("doc_id")).alias("doc_id"), F.concat(F.lit("https://x.example/"), F.col("lang"), F.lit(" \n")).alias("content"))
    both = F.array(F.struct("doc_id", F.col("text").alias("content")), link)
    rows = views.table(spark, sf, "documents").select(F.inline(both)).select(
        "doc_id",
        "content",
        F.array().cast("array<string>").alias("hashtags"),
        F.array().cast("array<string>").alias("mentions"),
    )
    return clean.clean_posts(rows).select("doc_id", F.col("content").alias("text"))


@query("c11_isolate_faults")
def _(spark, sf):
    return normalize.misfit_posts(views.spoilt_posts(spark, sf)).select("post_id", "username", "likes", joined("unreadable"))


@query("c12_clean_counts")
def _(spark, sf):
    seen = Observation("cleaning")
    clean.clean_posts(views.emptied(normalised(spark, sf)), observation=seen).write.format("noop").mode("overwrite").save()
    counts = (seen.get["total"], seen.get["retained"])
    return spark.createDataFrame([counts], "total bigint, retained bigint")


# Deduplication


@query("d01_fingerprint")
def _(spark, sf):
    return printed(spark, sf).select("post_id", "fingerprint")


@query("d02_first_occurrence")
def _(spark, sf):
    return dedup.deduplicate(printed(spark, sf)).select("post_id", "username", "fingerprint", "likes")


@query("d03_new_posts")
def _(spark, sf):
    known = views.known_hashes(spark, sf)
    return dedup.deduplicate(normalised(spark, sf), known).select("post_id", "username")


@query("d03_new_posts_by_ranges")
def _(spark, sf):
    """Known fingerprints come from two batches of a store, of which only matching ranges are read."""
    store = dedup.FingerprintStore(spark, scratch_dir(spark, "fingerprints"), digits=1)
    known = stored(views.known_hashes(spark, sf), "known")
    low = F.substring("fingerprint", 2, 1) < "8"
    for batch, part in ((0, low), (1, ~low)):
        store.commit(known.filter(part), batch)
    return store.new_posts(normalised(spark, sf), 2).select("post_id", "username")


@query("d04_flag_known")
def _(spark, sf):
    return dedup.flag_known(normalised(spark, sf), views.known_hashes(spark, sf)).select("post_id", "is_duplicate")


@query("d05_register")
def _(spark, sf):
    return dedup.register(views.known_hashes(spark, sf), normalised(spark, sf))


@query("d05_stored_batches")
def _(spark, sf):
    """Two batches through the stored fingerprints, the second one run twice as after a restart."""
    root = scratch_dir(spark, "batches")
    store = dedup.FingerprintStore(spark, f"{root}/fingerprints", digits=1)
    rows = normalised(spark, sf)
    earlier = F.col("timestamp") < views.batch_start()
    write = stateful.foreach_batch_dedup(store, f"{root}/posts")
    for batch, part in ((0, rows.filter(earlier)), (1, rows.filter(~earlier)), (1, rows.filter(~earlier))):
        write(part, batch)
    return spark.read.parquet(f"{root}/posts").select("post_id", "username")


@query("d05_stream_dedup")
def _(spark, sf):
    root = scratch_dir(spark, "stream")
    path = post_io.write_posts(normalised(spark, sf), f"{root}/posts")
    stream = stateful.deduplicate_stream(stateful.read_post_stream(spark, path), "60 days").select("fingerprint")
    return stateful.flush_stream(stream, spark, "unique", root)


@query("d06_duplicate_counts")
def _(spark, sf):
    return dedup.duplicate_counts(printed(spark, sf))


# Features


@query("f01_engagement")
def _(spark, sf):
    return featured(spark, sf).select("post_id", rounded("engagement_score"))


@query("f02_tokens")
def _(spark, sf):
    found = text.tokens(F.col("text")).alias("tokens")
    return views.table(spark, sf, "documents").select("doc_id", found).select("doc_id", joined("tokens"))


@query("f03_keyword_hits")
def _(spark, sf):
    return featured(spark, sf).select("post_id", "bullish_keyword_count", "bearish_keyword_count")


@query("f04_polarity")
def _(spark, sf):
    return featured(spark, sf).select("post_id", rounded("sentiment_score"))


@query("f05_length")
def _(spark, sf):
    return views.table(spark, sf, "documents").select("doc_id", F.length("text").alias("tweet_length"))


@query("f06_word_count")
def _(spark, sf):
    return views.table(spark, sf, "documents").select("doc_id", text.word_count(F.col("text")).alias("word_count"))


@query("f07_tag_counts")
def _(spark, sf):
    return featured(spark, sf).select("post_id", "hashtag_count", "mention_count")


@query("f08_feature_matrix")
def _(spark, sf):
    return featured(spark, sf).select(
        "post_id",
        *post_out(),
        rounded("engagement_score"),
        "tweet_length",
        "word_count",
        "hashtag_count",
        "mention_count",
        rounded("sentiment_score"),
        "bullish_keyword_count",
        "bearish_keyword_count",
    )


# Keywords


@query("t01_documents")
def _(spark, sf):
    return keywords.documents(unique(spark, sf)).agg(F.count(F.lit(1)).alias("documents"))


@query("t02_t03_words")
def _(spark, sf):
    docs = keywords.documents(unique(spark, sf))
    words = keywords.with_terms(docs, ngram_range=(1, 1)).select("post_id", F.col("terms").alias("words"))
    return words.select("post_id", joined("words"))


@query("t04_ngrams")
def _(spark, sf):
    return keywords.term_counts(stored_terms(spark, sf)).select("post_id", "term", F.col("tf").alias("n"))


@query("t05_term_frequency")
def _(spark, sf):
    return keywords.term_counts(stored_terms(spark, sf))


@query("t06_document_frequency")
def _(spark, sf):
    return keywords.term_statistics(terms(spark, sf)).filter(F.col("df") >= 3)


@query("t07_vocabulary")
def _(spark, sf):
    return vocabulary(spark, sf)


@query("t08_smoothed_idf")
def _(spark, sf):
    return model(spark, sf).table.select("term", rounded("idf"))


@query("t09_document_scores")
def _(spark, sf):
    posts = texts_table(spark, sf)
    return keywords.fit(posts, 50).transform(posts).select("post_id", "term", "tf", rounded("tfidf"))


@query("t10_score_new_texts")
def _(spark, sf):
    """A model fitted on the posts, stored, loaded, and used on the documents."""
    path = scratch_dir(spark, "model")
    model(spark, sf).save(path)
    loaded = keywords.KeywordModel.load(spark, path)
    docs = views.table(spark, sf, "documents")
    return loaded.transform(docs, "text", "doc_id").select("doc_id", "term", "tf", rounded("tfidf"))


@query("t11_mean_scores")
def _(spark, sf):
    posts = texts_table(spark, sf)
    return keywords.fit(posts, 50).mean_scores(posts).select("keyword", rounded("score"))


def repeated_keys(spark, sf):
    """Posts whose keys repeat or are missing: every row is a document all the same."""
    key = F.when(F.col("post_id") % 7 != 0, F.col("post_id") % 997)
    return unique(spark, sf).select(key.alias("post_id"), "content")


@query("t09_repeated_keys")
def _(spark, sf):
    """Scores by a small and a large vocabulary, summed by key."""
    posts = stored(repeated_keys(spark, sf), "texts")
    merged = None
    for size in (50, 5000):
        scores = keywords.fit(posts, size).transform(posts).groupBy("post_id").agg(
            F.lit(size).alias("max_features"), F.count(F.lit(1)).alias("n"), F.sum("tf").alias("tf"), F.round(F.sum("tfidf"), 4).alias("tfidf")
        )
        merged = scores if merged is None else merged.unionByName(scores)
    return merged


@query("t11_large_vocabulary")
def _(spark, sf):
    posts = stored(repeated_keys(spark, sf), "texts")
    return keywords.fit(posts, 5000).mean_scores(posts).select("keyword", rounded("score"))


@query("t13_no_texts")
def _(spark, sf):
    nothing = unique(spark, sf).filter(F.length("content") < 0)
    return keywords.top_keywords(nothing, 10, 50).agg(F.count(F.lit(1)).alias("keywords"))


@query("t12_top_keywords")
def _(spark, sf):
    return keywords.top_keywords(texts_table(spark, sf), 10, 50).select("keyword", rounded("score"))


@query("t12_keywords_by_hashtag")
def _(spark, sf):
    return keywords.top_keywords_by_hashtag(texts_table(spark, sf), 5, 50).select("hashtag", "keyword", rounded("score"))


# Signal


@query("g01_weighted_signal")
def _(spark, sf):
    return scored(spark, sf).select("post_id", rounded("weighted_signal"))


@query("g03_without_keyword_counts")
def _(spark, sf):
    narrow = featured(spark, sf).select("post_id", "sentiment_score", "engagement_score")
    return signal.with_weighted_signal(narrow).select("post_id", rounded("weighted_signal"))


@query("g05_finite_signals")
def _(spark, sf):
    """Signals of posts without likes are blown up to infinity or NaN, and must be left out."""
    one, zero = F.lit(1.0), F.lit(0.0)
    x = F.col("weighted_signal")
    blown = F.when(x > 0, F.lit(float("inf"))).when(x < 0, F.lit(float("-inf"))).otherwise(F.lit(float("nan")))
    rows = scored(spark, sf).select(F.when(F.col("likes") == 0, blown).otherwise(x).alias("x"))
    return rows.filter(signal.is_finite(F.col("x"))).agg(
        F.count(one).alias("n"), F.round(F.coalesce(F.sum("x"), zero), 4).alias("total")
    )


@query("g06_moments")
def _(spark, sf):
    moments = scored(spark, sf).agg(*signal.statistics(F.col("weighted_signal")))
    return moments.select("n", rounded("mean"), rounded("std"), "bulls", "bears")


@query("g07_confidence_interval")
def _(spark, sf):
    return summed(spark, sf).select("ci_95_lower", "ci_95_upper")


@query("g08_label_by_hashtag")
def _(spark, sf):
    labelled = signal.summarise_by_hashtag(scored(spark, sf), buy_threshold=0.5, sell_threshold=-0.5)
    return labelled.select("hashtag", "signal_label")


@query("g09_confidence")
def _(spark, sf):
    return summed(spark, sf).select("confidence_score")


@query("g10_shares")
def _(spark, sf):
    return summed(spark, sf).select("bullish_percentage", "bearish_percentage")


@query("g11_summary")
def _(spark, sf):
    return signal.summarise(featured(spark, sf))


@query("g12_no_finite_signal")
def _(spark, sf):
    return signal.summarise(scored(spark, sf).withColumn("weighted_signal", F.lit(float("nan"))))


def windows_out(df):
    return df.withColumns({"window_start": wall("window_start"), "window_end": wall("window_end")})


@query("g13_rolling_summary")
def _(spark, sf):
    return windows_out(signal.rolling_summary(scored(spark, sf)))


@query("g13_rolling_stream")
def _(spark, sf):
    """The stream ends with a post far in the future of the data, so that every window is closed."""
    root = scratch_dir(spark, "rolling")
    rows = scored(spark, sf).select("timestamp", "weighted_signal")
    rows.write.parquet(f"{root}/scored/part=0")
    last = rows.agg((F.max("timestamp") + F.expr("INTERVAL 10 DAYS")).alias("timestamp"), F.lit(0.0).alias("weighted_signal"))
    last.write.parquet(f"{root}/scored/part=1")
    stream = spark.readStream.schema("timestamp timestamp, weighted_signal double, part int").parquet(f"{root}/scored")
    out = stateful.flush_stream(stateful.rolling_signal_stream(stream), spark, "rolling", root)
    return windows_out(out)


@query("g_summary_by_hashtag")
def _(spark, sf):
    return signal.summarise_by_hashtag(scored(spark, sf))


@query("g_summary_by_hour")
def _(spark, sf):
    return signal.summarise_by_hour(scored(spark, sf)).withColumn("hour", wall("hour"))


# Chart tables


@query("v01_posts_over_time")
def _(spark, sf):
    return charts.posts_over_time(unique(spark, sf)).select(wall("hour"), "posts")


@query("v01_wild_date")
def _(spark, sf):
    """One post lies decades after all others."""
    wild = F.when(F.col("post_id") == 0, F.expr("TIMESTAMP'2051-01-01 00:30:00Z'")).otherwise(F.col("timestamp"))
    return charts.posts_over_time(unique(spark, sf).withColumn("timestamp", wild)).select(wall("hour"), "posts")


@query("v02_top_hashtags")
def _(spark, sf):
    return charts.top_hashtags(unique(spark, sf))


def bins_out(df):
    return df.select("bin", rounded("bin_start"), rounded("bin_end"), "posts")


@query("v03_engagement_histogram")
def _(spark, sf):
    return bins_out(charts.engagement_histogram(stored(featured(spark, sf).select("engagement_score"), "chart")))


@query("v04_signal_histogram")
def _(spark, sf):
    return bins_out(charts.signal_histogram(stored(scored(spark, sf).select("weighted_signal"), "chart")))


@query("v04_sentiment_histogram")
def _(spark, sf):
    return bins_out(charts.signal_histogram(stored(featured(spark, sf).select("sentiment_score"), "chart")))


@query("v05_signal_overlay")
def _(spark, sf):
    return charts.signal_overlay(summed(spark, sf))


@query("v06_chart_rows")
def _(spark, sf):
    return chart_rows(charts.all_charts(stored(scored(spark, sf).drop("content"), "chart")))


def chart_rows(tables):
    """Every row of the charts as chart, item and value."""
    items = {
        "posts_over_time": (F.date_format(times.utc_to_ntz(F.col("hour")), "yyyy-MM-dd HH"), "posts"),
        "top_hashtags": (F.col("hashtag"), "frequency"),
        "engagement_histogram": (F.col("bin").cast("string"), "posts"),
        "signal_chart": (F.col("bin").cast("string"), "posts"),
    }
    merged = None
    for name, df in tables.items():
        item, value = items[name]
        part = df.select(F.lit(name).alias("output"), item.alias("item"), F.col(value).cast("double").alias("value"))
        merged = part if merged is None else merged.unionByName(part)
    return merged


# End to end


@query("p01_signal_summary")
def _(spark, sf):
    return summed(spark, sf)


@query("p02_run_outputs")
def _(spark, sf):
    """The whole job with its outputs, every row read from what was written."""
    from datetime import UTC, datetime

    options = JobOptions(scratch_dir(spark, "run"), datetime(2024, 1, 31, tzinfo=UTC), CUTOFF_HOURS)
    done = signals.run(spark, views.posts(spark, sf), options)
    post = F.col("post_id").cast("string")
    header = spark.read.options(**results.CSV_OPTIONS).csv(done.features_path)
    outputs = {
        "posts": (post_io.read_posts(spark, done.posts_path), post, "likes"),
        "features": (header, post, "engagement_score"),
        "top_keywords": (spark.read.schema(KEYWORD_SCHEMA).json(done.keywords_path), F.col("keyword"), "score"),
        "signal_summary": (spark.read.json(done.summary_path), F.col("signal_label"), "mean_signal"),
    }
    merged = chart_rows({name: spark.read.parquet(path) for name, path in done.chart_paths.items()})
    for name, (df, item, value) in outputs.items():
        merged = merged.unionByName(df.select(F.lit(name).alias("output"), item.alias("item"), F.col(value).cast("double").alias("value")))
    counts = {"total": done.total, "retained": done.retained, "duplicates": done.duplicates}
    observed = spark.createDataFrame([("run", k, float(v)) for k, v in counts.items()], merged.schema)
    return merged.unionByName(observed).withColumn("value", F.round("value", 6))


@query("p03_nothing_left")
def _(spark, sf):
    """Every post is emptied by cleaning; the summary is that of no posts."""
    return signals.signal_summary(views.posts(spark, sf).withColumn("content", F.lit(" https://x.example/a ")))


@query("p04_job_batches")
def _(spark, sf):
    """Two batches through the job with kept fingerprints: posts of all runs."""
    import job

    root = scratch_dir(spark, "job")
    rows, earlier = views.posts(spark, sf), F.col("timestamp") < views.batch_start()
    for batch, part in ((0, earlier), (1, ~earlier)):
        path = post_io.write_posts(rows.filter(part), f"{root}/in-{batch}", compression="zstd")
        job.main(["--input", path, "--known", f"{root}/known", "--batch", str(batch), "--output-dir", f"{root}/out", "--as-of", "2024-01-31"])
    return runs.RunLog(spark, f"{root}/out/processed").posts().select("post_id", "username")

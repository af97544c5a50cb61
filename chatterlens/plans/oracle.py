"""SQL twins of the registered queries, for DuckDB on the same tables.

Each step of the post tables is one named view text; a query lists the steps it needs. Tag lists are
compared as text joined by ``|``, timestamps as UTC wall clock, doubles after rounding.
"""

from __future__ import annotations

from chatterlens.functions.words import BEARISH_WORDS, BULLISH_WORDS, STOP_WORDS
from chatterlens.operators.capture import RATE_LIMIT_PHRASES
from chatterlens.plans.views import LIMIT_TAILS, PHRASES, POST_TAILS, WALL_TAILS
from chatterlens.sources.sample import TEMPLATES

SP = r"\t-\r\x1c-\x20\x85\p{Z}"
WD = r"\p{L}\p{N}_"
URL = rf"(?i)https?://[^{SP}]+|www\.[^{SP}]+"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words(items) -> str:
    return "[" + ", ".join(quoted(w) for w in items) + "]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{SP}]+|[{SP}]+$', '', 'g')"


def iso(ts: str) -> str:
    return (
        f"(strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us({ts}) % 1000000 = 0 THEN '' "
        f"ELSE '.' || strftime({ts}, '%f') END || '+00:00')"
    )


def tags(items: str, mark: str) -> str:
    inner = strip(f"regexp_replace({strip('x')}, '^{mark}+', '')")
    return f"[y FOR y IN [lower({inner}) FOR x IN coalesce({items}, [])] IF y <> '']"


def found(text: str, mark: str) -> str:
    return f"[lower(x) FOR x IN regexp_extract_all({text}, '{mark}([{WD}]+)', 1)]"


def merged(items: str, text: str, mark: str) -> str:
    return f"list_sort(list_distinct(list_concat({items}, {found(text, mark)})))"


def unique_in_order(items: str) -> str:
    return f"[z FOR z, i IN {items} IF list_position({items}, z) = i]"


def joined(items: str) -> str:
    return f"array_to_string({items}, '|')"


def unescape(x: str) -> str:
    """The entities the tables hold; the ampersand last, so nothing is decoded twice."""
    for entity, char in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        x = f"replace({x}, {quoted(entity)}, {quoted(char)})"
    return x


def clean(x: str) -> str:
    x = f"regexp_replace({unescape(x)}, '{URL}', '', 'g')"
    x = rf"regexp_replace({x}, '[\x00-\x1f\x7f-\x9f]', '', 'g')"
    return f"trim(regexp_replace({x}, '[{SP}]+', ' ', 'g'))"


PHRASE = "CASE event_type " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in PHRASES.items()) + " END"
LOT = "CAST(floor(value) AS BIGINT)"
SHORT = f"('  ' || {PHRASE} || ' lot ' || CAST({LOT} AS VARCHAR) || chr(10))"
COMMON = "user_id % 11 AS replies, event_id % 23 AS reposts"
EVENT_TAGS = "['#' || upper(event_type), ' #Lot ', ' '] AS hashtags, ['@U' || user_id] AS mentions"

STEPS: dict[str, tuple[tuple[str, ...], str]] = {}


def step(name: str, needs: tuple[str, ...], sql: str) -> None:
    STEPS[name] = (needs, sql)


step(
    "posts",
    (),
    f"""
SELECT event_id * 4 AS ingest_seq, ' u' || user_id AS username, ts AS "timestamp", {SHORT} AS content,
  {LOT} - 5 AS likes, {COMMON}, {EVENT_TAGS} FROM events
UNION ALL SELECT event_id * 4 + 1, 'U' || user_id, ts, upper({SHORT}), {LOT} + 1, {COMMON}, {EVENT_TAGS}
FROM events WHERE event_type = 'purchase'
UNION ALL SELECT doc_id * 4 + 2, 'desk' || user_id, ts, text || ' ' || {PHRASE}, {LOT}, {COMMON},
  ['#' || source, upper(lang)], CAST([] AS VARCHAR[]) FROM documents LEFT JOIN events ON doc_id = event_id
UNION ALL SELECT page_id * 4 + 3, 'web' || user_id, ts, html || ' ' || {PHRASE}, {LOT}, {COMMON},
  ['web'], CAST([] AS VARCHAR[]) FROM pages LEFT JOIN events ON page_id = event_id""",
)
step(
    "norm",
    ("posts",),
    f"""
SELECT ingest_seq AS post_id, ingest_seq, {strip("username")} AS username, "timestamp", {strip("content")} AS content,
  greatest(0, likes) AS likes, greatest(0, replies) AS replies, greatest(0, reposts) AS reposts,
  {tags("hashtags", "#")} AS hashtags, {tags("mentions", "@")} AS mentions FROM posts""",
)
step(
    "texts",
    ("norm",),
    f"SELECT * REPLACE ({clean('content')} AS content) FROM norm",
)
step(
    "cleaned",
    ("texts",),
    f"""
SELECT * REPLACE ({merged("hashtags", "content", "#")} AS hashtags, {merged("mentions", "content", "@")} AS mentions)
FROM texts WHERE content <> ''""",
)
FP = f"sha256(lower(username) || ':' || {iso('"timestamp"')} || ':' || lower({strip('content')}))"
step("printed", ("cleaned",), f"SELECT *, {FP} AS fingerprint FROM cleaned")
step(
    "uniq",
    ("printed",),
    "SELECT * FROM printed QUALIFY row_number() OVER (PARTITION BY fingerprint ORDER BY ingest_seq) = 1",
)
step("raw_printed", ("norm",), f"SELECT *, {FP} AS fingerprint FROM norm")
step(
    "known",
    ("raw_printed",),
    "SELECT DISTINCT fingerprint FROM raw_printed WHERE \"timestamp\" < TIMESTAMP '2024-01-10 00:00:00'",
)
step(
    "tokenised",
    ("uniq",),
    f"SELECT *, regexp_extract_all(lower(content), '[{WD}]+') AS toks FROM uniq",
)
step(
    "counted",
    ("tokenised",),
    f"""
SELECT *, CAST(len([w FOR w IN toks IF list_contains({words(BULLISH_WORDS)}, w)]) AS INTEGER) AS bull,
  CAST(len([w FOR w IN toks IF list_contains({words(BEARISH_WORDS)}, w)]) AS INTEGER) AS bear FROM tokenised""",
)
step(
    "feat",
    ("counted",),
    f"""
SELECT post_id, ingest_seq, username, "timestamp", content, likes, replies, reposts, hashtags, mentions,
  CAST(likes + reposts * 1.5 + replies * 2.0 AS DOUBLE) AS engagement_score,
  CAST(length(content) AS INTEGER) AS tweet_length,
  CAST(len(regexp_extract_all(content, '[^{SP}]+')) AS INTEGER) AS word_count,
  CAST(len(hashtags) AS INTEGER) AS hashtag_count, CAST(len(mentions) AS INTEGER) AS mention_count,
  CASE WHEN bull + bear = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(bull - bear AS DOUBLE) / (bull + bear) END AS sentiment_score,
  bull AS bullish_keyword_count, bear AS bearish_keyword_count FROM counted""",
)
WEIGHTED = (
    "sentiment_score * (ln(1 + engagement_score) + 1) * "
    "greatest(CAST(0.5 AS DOUBLE), CAST(1 AS DOUBLE) + CAST(0.05 AS DOUBLE) * (bullish_keyword_count - bearish_keyword_count))"
)
step("sig", ("feat",), f"SELECT *, {WEIGHTED} AS weighted_signal FROM feat")


def summary(source: str, keys: str = "", buy: float = 0.05, sell: float = -0.05, column: str = "weighted_signal") -> str:
    lead = f"{keys}, " if keys else ""
    group = f" GROUP BY {keys}" if keys else ""
    return f"""
SELECT {lead}n AS total_tweets, round(mean, 4) AS mean_signal, round(std, 4) AS std_dev,
  round(mean - margin, 4) AS ci_95_lower, round(mean + margin, 4) AS ci_95_upper,
  CASE WHEN mean >= {buy} THEN 'BUY' WHEN mean <= {sell} THEN 'SELL' ELSE 'HOLD' END AS signal_label,
  round(least(100.0, greatest(0.0, abs(mean) / (std + 1e-6) * 100)), 2) AS confidence_score,
  coalesce(round(CAST(bulls AS DOUBLE) / nullif(n, 0) * 100, 2), 0) AS bullish_percentage,
  coalesce(round(CAST(bears AS DOUBLE) / nullif(n, 0) * 100, 2), 0) AS bearish_percentage
FROM (SELECT *, coalesce(1.96 * std / sqrt(nullif(n, 0)), 0) AS margin FROM (
  SELECT {lead}count(*) AS n, coalesce(avg(x), 0) AS mean, coalesce(stddev_samp(x), 0) AS std,
    count(*) FILTER (WHERE x > 0) AS bulls, count(*) FILTER (WHERE x < 0) AS bears
  FROM (SELECT *, {column} AS x FROM {source}) WHERE isfinite(x){group}))"""


step("summed", ("sig",), summary("sig"))

step("docs", ("uniq",), f"SELECT * FROM uniq WHERE regexp_matches(content, '[^{SP}]')")
step(
    "kept_words",
    ("docs",),
    f"""
SELECT post_id, hashtags, [w FOR w IN regexp_extract_all(lower(content), '[{WD}]+')
  IF NOT list_contains({words(STOP_WORDS)}, w)] AS w FROM docs""",
)
step(
    "terms",
    ("kept_words",),
    """
SELECT post_id, unnest(w) AS term FROM kept_words
UNION ALL SELECT post_id, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS term FROM kept_words""",
)
step("tf", ("terms",), "SELECT post_id, term, count(*) AS tf FROM terms GROUP BY post_id, term")
step(
    "vocab",
    ("tf", "docs"),
    """
SELECT *, ln((1.0 + (SELECT count(*) FROM docs)) / (1.0 + df)) + 1 AS idf FROM (
  SELECT term, CAST(sum(tf) AS BIGINT) AS total, count(*) AS df FROM tf GROUP BY term
  ORDER BY total DESC, term LIMIT 50)""",
)
step(
    "scores",
    ("vocab",),
    """
SELECT post_id, term, tf, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY post_id)) AS tfidf
FROM tf JOIN vocab USING (term)""",
)
step(
    "means",
    ("scores", "docs"),
    """
SELECT v.term AS keyword, coalesce(sum(tfidf), 0) / (SELECT count(*) FROM docs) AS score
FROM vocab v LEFT JOIN scores s ON v.term = s.term GROUP BY v.term""",
)

USER = "('@u' || user_id)"
NOW = "TIMESTAMP '2024-01-31 00:00:00'"
MOMENT = "(replace(CAST(ts AS VARCHAR), ' ', 'T') || 'Z')"


def _cards(seq: str, where: str = "") -> str:
    return f"""
SELECT {seq} AS ingest_seq, '#' || event_type AS hashtag,
  CASE WHEN event_type <> 'view' THEN '/x/status/' || event_id END AS status_href,
  CASE WHEN value < 3 THEN 'no handle here' ELSE 'Name ' || {USER} END AS user_text,
  CASE WHEN value > 120 THEN NULL WHEN value > 100 THEN 'yesterday'
    WHEN value > 95 THEN replace(CAST(ts AS VARCHAR), ' ', 'T') ELSE {MOMENT} END AS time_attr,
  CASE WHEN event_type IN ('signup', 'error') THEN '' ELSE ' ' || {PHRASE} END AS body_text,
  CASE WHEN event_type = 'error' AND value < 3 THEN {USER} || chr(10) || '  ' || chr(10)
    ELSE ' Name' || chr(10) || {USER} || chr(10) || '  @inner ' || chr(10) || ' ' || chr(10) || {PHRASE} || '  '
      || chr(10) || CAST({LOT} AS VARCHAR) END AS full_text,
  '' AS reply_text, {LOT} || ' Replies. Reply' AS reply_aria,
  CASE WHEN value < 40 THEN 'n/a' ELSE {LOT} || ' more' END AS repost_text, CAST(NULL AS VARCHAR) AS repost_aria,
  CASE WHEN value < 5 THEN '  ' WHEN value < 10 THEN {LOT} || '.5K' WHEN value < 20 THEN '1,2' || {LOT}
    WHEN value < 30 THEN '3.4 M' WHEN value < 35 THEN '1.2.3' ELSE CAST({LOT} AS VARCHAR) END AS like_text,
  {LOT} || ' Likes' AS like_aria FROM events {where}"""


def metric(text: str, aria: str) -> str:
    label = f"coalesce(nullif({strip(text)}, ''), {aria})"
    raw = f"regexp_extract({label}, '[0-9,.]+[{SP}]*[kKmMbB]?')"
    number = f"TRY_CAST(regexp_extract(replace({raw}, ',', ''), '^[0-9.]*') AS DOUBLE)"
    scale = f"CASE lower(right({raw}, 1)) WHEN 'k' THEN 1e3 WHEN 'm' THEN 1e6 WHEN 'b' THEN 1e9 ELSE 1 END"
    return f"coalesce(TRY_CAST(trunc({number} * {scale}) AS BIGINT), 0)"


step("cards", (), _cards("event_id * 2") + " UNION ALL " + _cards("event_id * 2 + 1", "WHERE event_type = 'purchase'"))
step(
    "card_fields",
    ("cards",),
    f"""
SELECT *, regexp_extract(status_href, '/status/([0-9]+)', 1) AS sid,
  coalesce(nullif(regexp_extract(user_text, '@([A-Za-z0-9_]{{1,15}})', 1), ''), 'unknown') AS username,
  CASE WHEN time_attr IS NULL OR time_attr = 'yesterday' THEN {NOW}
    WHEN time_attr LIKE '%Z' THEN CAST(replace(replace(time_attr, 'T', ' '), 'Z', '') AS TIMESTAMP) END AS "timestamp",
  coalesce(nullif({strip("body_text")}, ''), array_to_string([{strip("x")} FOR x IN
    string_split({strip("full_text")}, chr(10)) IF {strip("x")} <> '' AND NOT starts_with(x, '@')], ' ')) AS content
FROM cards""",
)
step(
    "parsed",
    ("card_fields",),
    f"""
SELECT ingest_seq, username, "timestamp", content, {metric("like_text", "like_aria")} AS likes,
  {metric("reply_text", "reply_aria")} AS replies, {metric("repost_text", "repost_aria")} AS reposts,
  {found("content", "#")} AS hashtags, {found("content", "@")} AS mentions, hashtag, nullif(sid, '') AS status_id,
  sha256(coalesce(nullif(sid, ''), lower(username) || ':' || {iso('"timestamp"')} || ':' || content)) AS ingest_key
FROM card_fields
WHERE "timestamp" >= {NOW} - INTERVAL 168 HOUR AND NOT (content = '' AND username = 'unknown')""",
)
step(
    "first_cards",
    ("parsed",),
    "SELECT * FROM parsed QUALIFY row_number() OVER (PARTITION BY ingest_key ORDER BY ingest_seq) = 1",
)


def tail(tails) -> str:
    return f"{words(tails)}[page_id % {len(tails)} + 1]"


step(
    "page_cards",
    (),
    f"""
SELECT page_id, CASE WHEN contains(url, '/fr') THEN url || '/Login' ELSE url END AS url,
  CASE WHEN contains(url, '/de') THEN html || {tail(LIMIT_TAILS)}
    WHEN contains(url, '/es') THEN html || {tail(WALL_TAILS)}
    WHEN contains(url, 'page=') THEN html || {tail(POST_TAILS)} ELSE html END AS html
FROM pages""",
)
# What a browser keeps, step by step: no comments, no scripts, no styles.
BARE = "html"
for hidden in ("<!--.*?-->", "<script[ >].*?</script>", "<style[ >].*?</style>"):
    BARE = f"regexp_replace({BARE}, '(?is){hidden}', '', 'g')"
WALLED = r"""(contains(lower(url), '/login') OR regexp_matches(bare, 'data-testid=[''"]?(loginbutton|sheetdialog)', 'i')
  OR len(list_filter(regexp_extract_all(bare, '(?i)<a [^>]*>'), lambda x: regexp_matches(x, '(?i) href=[''"]?[^ ''">]*/login'))) > 0)"""
BLOCKS = r"regexp_replace(regexp_replace(bare, '(?i)</?(b|em|a|i|span|strong)( [^>]*)?>', '', 'g'), '<[^>]*>', ' ', 'g')"
VISIBLE = f"lower(regexp_replace({unescape(f"replace({BLOCKS}, '&nbsp;', chr(160))")}, '[{SP}]+', ' ', 'g'))"
LIMITED = " OR ".join(f"contains(v, {quoted(p)})" for p in RATE_LIMIT_PHRASES)
USABLE = r"""(?i)<article [^>]*data-testid=[''"]?tweet[''"]|data-testid="(AppTabBar_Home_Link|SideNav_AccountSwitcher_Button)\""""


def query(select: str, *needs: str) -> str:
    """SELECT text with the steps it needs, each once and in order."""
    order: list[str] = []

    def visit(name: str) -> None:
        for parent in STEPS[name][0]:
            visit(parent)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    if not order:
        return select
    views = ",\n".join(f"{name} AS MATERIALIZED ({STEPS[name][1]})" for name in order)
    return f"WITH {views}\n{select}"


POST_OUT = (
    'ingest_seq, username, "timestamp", content, likes, replies, reposts, '
    f"{joined('hashtags')} AS hashtags, {joined('mentions')} AS mentions"
)


def histogram(source: str, column: str) -> str:
    return f"""
SELECT b AS bin, round(lo + (hi - lo) / 30 * (b - 1), 6) AS bin_start, round(lo + (hi - lo) / 30 * b, 6) AS bin_end,
  coalesce(n, 0) AS posts
FROM (SELECT unnest(range(1, 31)) AS b) CROSS JOIN (SELECT min({column}) AS lo, max({column}) AS hi FROM {source})
LEFT JOIN (SELECT least(30, CAST(floor(({column} - lo) / ((hi - lo) / 30.0)) AS BIGINT) + 1) AS bin, count(*) AS n
  FROM {source} CROSS JOIN (SELECT min({column}) AS lo, max({column}) AS hi FROM {source}) GROUP BY 1) ON bin = b"""


def jitter(i: str, seed: int, salt: int, low: int, high: int) -> str:
    mixed = f"(({i} * 7919 + {(seed * 104729 + salt * 1299709) % 1000003}) % 1000003)"
    return f"({mixed} % {high - low + 1} + {low})"


def _sample() -> str:
    t = f"({jitter('event_id', 7, 0, 0, len(TEMPLATES) - 1)} + 1)"
    pick = {k: "[" + ", ".join(str(row[k]) if isinstance(row[k], int) else quoted(row[k]) for row in TEMPLATES) + f"][{t}]" for k in range(5)}
    lists = {k: "[" + ", ".join(quoted("|".join(row[k])) for row in TEMPLATES) + f"][{t}]" for k in (5, 6)}
    minutes = f"(((SELECT count(*) FROM events) - event_id) * 12 + {jitter('event_id', 7, 1, 0, 5)})"
    return f"""
SELECT event_id AS ingest_seq, {pick[0]} || '_' || event_id AS username,
  {NOW} - to_minutes(CAST({minutes} AS BIGINT)) AS "timestamp", {pick[1]} AS content,
  CAST({pick[2]} + {jitter("event_id", 7, 2, 5, 50)} AS BIGINT) AS likes,
  CAST({pick[3]} + {jitter("event_id", 7, 3, 1, 10)} AS BIGINT) AS replies,
  CAST({pick[4]} + {jitter("event_id", 7, 4, 2, 20)} AS BIGINT) AS reposts,
  {lists[5]} AS hashtags, {lists[6]} AS mentions FROM events"""


def _windows(source: str) -> str:
    return f"""(SELECT *, start + INTERVAL 1 HOUR AS window_end FROM (
  SELECT s.*, time_bucket(INTERVAL 15 MINUTE, "timestamp", TIMESTAMP '1970-01-01') - to_minutes(15 * k) AS start
  FROM {source} s CROSS JOIN (SELECT unnest(range(0, 4)) AS k)) WHERE start + INTERVAL 1 HOUR > "timestamp")"""


def _rolling() -> str:
    body = summary(f"(SELECT * RENAME (start AS window_start) FROM {_windows('sig')})", "window_start, window_end")
    return body


TAGGED = "(SELECT *, unnest(hashtags) AS hashtag FROM sig)"


def oracle_sql() -> dict[str, str]:
    q = query
    one_doc = f"{clean('text')}"
    sql = {
        # sources and sinks
        "s01_scan_posts": q(f"SELECT {POST_OUT} FROM posts", "posts"),
        "s02_scan_normalised": q(f"SELECT {POST_OUT} FROM norm", "norm"),
        "s03_write_batch": q(f"SELECT {POST_OUT} FROM norm UNION ALL SELECT {POST_OUT} FROM norm", "norm"),
        "s04_cast_schema": """SELECT event_id AS post_id, 'u' || user_id AS username, ts AS "timestamp",
            CASE WHEN value < 90 THEN CAST(floor(value) AS BIGINT) END AS likes FROM events
            WHERE value >= 4 AND event_type <> 'error'""",
        "s05_empty_batch": q(
            "SELECT 'kept' AS batch, count(*) AS posts FROM norm UNION ALL "
            "SELECT 'negative', count(*) FROM norm WHERE likes < 0",
            "norm",
        ),
        "s06_features_csv": q(
            f"SELECT post_id, username, {iso('"timestamp"')} AS \"timestamp\", content, likes, "
            "CAST(to_json(hashtags) AS VARCHAR) AS hashtags, CAST(to_json(mentions) AS VARCHAR) AS mentions, "
            "round(engagement_score, 6) AS engagement_score, word_count, round(sentiment_score, 6) AS sentiment_score "
            "FROM feat",
            "feat",
        ),
        "s07_keywords_json": q(
            "SELECT keyword, round(score, 6) AS score FROM means ORDER BY round(means.score, 12) DESC, keyword LIMIT 10", "means"
        ),
        "s08_summary_json": q("SELECT * FROM summed", "summed"),
        "s09_lake_by_date_and_hashtag": q(LAKE, "uniq"),
        "s09_lake_in_batches": q(LAKE, "uniq"),
        "s09_lake_of_one_hashtag": q(
            f"SELECT hashtag, {POST_OUT} FROM (SELECT *, unnest(hashtags) AS hashtag FROM uniq) WHERE hashtag IN ('sensex', 'desk')", "uniq"
        ),
        "s10_sample_posts": _sample(),
        "s11_posts_or_sample": q(f"SELECT {POST_OUT} FROM norm", "norm"),
        "s11_sample_where_empty": _sample().replace(" FROM events", " FROM (SELECT unnest(range((SELECT count(*) FROM events))) AS event_id)"),
        "s12_json_without_keys": q(f"SELECT * EXCLUDE (ingest_seq) FROM (SELECT {POST_OUT}, fingerprint FROM uniq)", "uniq"),
        "s12_json_files": q(f"SELECT post_id, {POST_OUT}, fingerprint FROM uniq", "uniq"),
        "s12_json_codec": q(f"SELECT {POST_OUT} FROM norm", "norm"),
        "s12_json_rejects": q("SELECT post_id FROM norm WHERE likes >= 100", "norm"),
        "s13_raw_capture_zone": q("SELECT * FROM cards", "cards"),
        # captured cards
        "r01_handle": q("SELECT ingest_seq, username FROM card_fields", "card_fields"),
        "r02_card_time": q('SELECT ingest_seq, "timestamp" FROM card_fields', "card_fields"),
        "r03_recent_cards": q(
            f'SELECT ingest_seq, "timestamp" FROM card_fields WHERE "timestamp" >= {NOW} - INTERVAL 168 HOUR',
            "card_fields",
        ),
        "r04_card_content": q("SELECT ingest_seq, content FROM card_fields", "card_fields"),
        "r05_usable_cards": q(
            "SELECT ingest_seq, username, content FROM card_fields WHERE NOT (content = '' AND username = 'unknown')",
            "card_fields",
        ),
        "r06_status_id": q("SELECT ingest_seq, nullif(sid, '') AS status_id FROM card_fields", "card_fields"),
        "r07_ingest_key": q("SELECT ingest_seq, ingest_key FROM parsed", "parsed"),
        "r08_first_capture": q("SELECT ingest_seq, ingest_key, username, likes FROM first_cards", "first_cards"),
        "r08_capture_counts": q(
            "SELECT count(*) AS cards, count(DISTINCT ingest_key) AS saved, "
            "count(*) - count(DISTINCT ingest_key) AS duplicates FROM parsed",
            "parsed",
        ),
        "r09_metric_source": q(
            f"SELECT ingest_seq, coalesce(nullif({strip('like_text')}, ''), like_aria) AS label, "
            f"{metric('like_text', 'like_aria')} AS likes FROM cards",
            "cards",
        ),
        "r10_parse_counts": q(
            f"SELECT ingest_seq, {metric('like_text', 'NULL')} AS likes, {metric('reply_aria', 'NULL')} AS replies, "
            f"{metric('repost_text', 'NULL')} AS reposts FROM cards",
            "cards",
        ),
        "r11_card_tags": q(
            f"SELECT ingest_seq, {joined('hashtags')} AS hashtags, {joined('mentions')} AS mentions FROM parsed", "parsed"
        ),
        "r12_page_status": q(
            f"SELECT page_id, CASE WHEN {WALLED} THEN 'LOGIN_REQUIRED' WHEN {LIMITED} THEN 'RATE_LIMITED' ELSE 'OK' END "
            f"AS page_status FROM (SELECT *, {VISIBLE} AS v FROM (SELECT *, {BARE} AS bare FROM page_cards))",
            "page_cards",
        ),
        "r13_page_usable": q(
            f"SELECT page_id, (NOT {WALLED} AND regexp_matches(bare, '{USABLE}')) AS usable "
            f"FROM (SELECT *, {BARE} AS bare FROM page_cards)",
            "page_cards",
        ),
        "r14_unseen_cards": q(
            "SELECT ingest_seq, nullif(sid, '') AS status_id FROM card_fields c WHERE NOT EXISTS (SELECT 1 FROM events e "
            "WHERE e.ts < TIMESTAMP '2024-01-10 00:00:00' AND CAST(e.event_id AS VARCHAR) = nullif(c.sid, ''))",
            "card_fields",
        ),
        "r15_hashtag_quota": q(
            "SELECT ingest_seq, hashtag FROM first_cards "
            "QUALIFY row_number() OVER (PARTITION BY hashtag ORDER BY ingest_seq) <= 50",
            "first_cards",
        ),
        "r15_large_quota": q(
            "SELECT ingest_seq, hashtag FROM cards QUALIFY row_number() OVER (PARTITION BY hashtag ORDER BY ingest_seq) <= 1500",
            "cards",
        ),
        "r15_quotas_around_the_limit": q(
            f"""SELECT quota, ingest_seq, hashtag FROM (SELECT *, row_number() OVER (PARTITION BY hashtag ORDER BY ingest_seq NULLS FIRST) AS rn
            FROM (SELECT hashtag, CASE WHEN time_attr IS NOT NULL THEN ingest_seq END AS ingest_seq FROM cards)) JOIN {QUOTAS} ON rn <= quota""",
            "cards",
        ),
        "r16_caps_around_the_limit": q(
            f"""SELECT quota, ingest_seq, hashtag FROM (SELECT *, row_number() OVER (ORDER BY ingest_seq NULLS FIRST) AS rn
            FROM (SELECT hashtag, CASE WHEN hashtag <> '#error' OR time_attr IS NOT NULL THEN ingest_seq END AS ingest_seq FROM cards))
            JOIN {QUOTAS} ON rn <= quota""",
            "cards",
        ),
        "r15_tied_quotas": q(
            f"""SELECT quota, ingest_seq, hashtag FROM (SELECT *, row_number() OVER (PARTITION BY hashtag ORDER BY ingest_seq // 64, -ingest_seq) AS rn
            FROM cards) JOIN {QUOTAS} ON rn <= quota""",
            "cards",
        ),
        "r16_tied_caps": q(
            f"""SELECT quota, ingest_seq, hashtag FROM (SELECT *, row_number() OVER (ORDER BY ingest_seq // 64, -ingest_seq) AS rn
            FROM cards) JOIN {QUOTAS} ON rn <= quota""",
            "cards",
        ),
        "r18_run_counts": q(
            "SELECT count(*) AS cards, count(DISTINCT ingest_key) AS unique_cards, count(*) - count(DISTINCT ingest_key) AS duplicates, "
            "count(DISTINCT ingest_key) AS saved FROM parsed",
            "parsed",
        ),
        "r16_total_cap": q("SELECT ingest_seq, hashtag FROM first_cards ORDER BY ingest_seq LIMIT 120", "first_cards"),
        "r16_large_cap": q("SELECT ingest_seq, hashtag FROM cards ORDER BY ingest_seq LIMIT 5000", "cards"),
        "r17_union_searches": q("SELECT ingest_seq, hashtag, user_text FROM cards", "cards"),
        "r18_collect_posts": q(
            f"""SELECT ingest_seq, username, "timestamp", content, likes, replies, reposts,
            {joined("hashtags")} AS hashtags, {joined("mentions")} AS mentions FROM (
              SELECT * FROM parsed WHERE hashtag IN ('#click', '#view', '#error')
              QUALIFY row_number() OVER (PARTITION BY ingest_key ORDER BY ingest_seq) = 1)
            QUALIFY row_number() OVER (PARTITION BY hashtag ORDER BY ingest_seq) <= 100""",
            "parsed",
        ),
        "r19_topic_filter": q(
            "SELECT post_id, username FROM cleaned WHERE list_has_any(hashtags, ['sensex', 'banknifty'])", "cleaned"
        ),
        # normalisation
        "n01_strip": q("SELECT post_id, username, content FROM norm", "norm"),
        "n02_clamp_counts": q("SELECT post_id, likes, replies, reposts FROM norm", "norm"),
        "n03_normalise_hashtags": q(f"SELECT post_id, {joined('hashtags')} AS hashtags FROM norm", "norm"),
        "n04_normalise_mentions": q(f"SELECT post_id, {joined('mentions')} AS mentions FROM norm", "norm"),
        "n05_quarantine": q(
            "SELECT ingest_seq, CASE WHEN \"timestamp\" IS NULL THEN 'timestamp' ELSE '' END AS missing FROM card_fields", "card_fields"
        ),
        # cleaning
        "c01_unescape_html": f"SELECT page_id, {unescape('html')} AS html FROM pages",
        "c02_drop_urls": q(f"SELECT post_id, regexp_replace(content, '{URL}', '', 'g') AS content FROM norm", "norm"),
        "c03_nfkc": "SELECT doc_id, text FROM documents",
        "c04_drop_controls": rf"SELECT doc_id, regexp_replace(text, '[\x00-\x1f\x7f-\x9f]', '', 'g') AS text FROM documents",
        "c05_collapse_space": f"SELECT doc_id, regexp_replace(text, '[{SP}]+', ' ', 'g') AS text FROM documents",
        "c06_clean_text": q("SELECT post_id, content FROM texts", "texts"),
        "c07_extract_hashtags": q(
            f"SELECT post_id, {joined(unique_in_order('h'))} AS hashtags FROM "
            f"(SELECT post_id, {found('content', '#')} AS h FROM texts)",
            "texts",
        ),
        "c08_extract_mentions": q(
            f"SELECT post_id, {joined(unique_in_order('h'))} AS mentions FROM "
            f"(SELECT post_id, {found('content', '@')} AS h FROM texts)",
            "texts",
        ),
        "c09_merge_tags": q(
            f"SELECT post_id, {joined('hashtags')} AS hashtags, {joined('mentions')} AS mentions FROM cleaned", "cleaned"
        ),
        "c10_drop_empty": f"SELECT doc_id, t AS text FROM (SELECT doc_id, {clean('text')} AS t FROM documents UNION ALL "
        f"SELECT -1 - doc_id, {clean(BARE_LINK)} FROM documents) WHERE t <> ''",
        "c11_isolate_faults": """SELECT CASE WHEN value < 4 THEN 'no ' ELSE '' END || event_id AS post_id, 'u' || user_id AS username,
            CASE WHEN event_type = 'error' THEN CAST(floor(value) AS BIGINT) || 'x' WHEN value < 90 THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS likes,
            concat_ws('|', CASE WHEN value < 4 THEN 'post_id' END, CASE WHEN event_type = 'error' THEN 'likes' END) AS unreadable
            FROM events WHERE value < 4 OR event_type = 'error'""",
        "c12_clean_counts": q(
            "SELECT count(*) AS total, count(*) FILTER (WHERE content <> '' AND likes < 90) AS retained FROM texts", "texts"
        ),
        # deduplication
        "d01_fingerprint": q("SELECT post_id, fingerprint FROM printed", "printed"),
        "d02_first_occurrence": q("SELECT post_id, username, fingerprint, likes FROM uniq", "uniq"),
        "d03_new_posts": q(
            "SELECT post_id, username FROM (SELECT * FROM raw_printed "
            "QUALIFY row_number() OVER (PARTITION BY fingerprint ORDER BY ingest_seq) = 1) r "
            "WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.fingerprint = r.fingerprint)",
            "known",
        ),
        "d03_new_posts_by_ranges": q(
            "SELECT post_id, username FROM (SELECT * FROM raw_printed "
            "QUALIFY row_number() OVER (PARTITION BY fingerprint ORDER BY ingest_seq) = 1) r "
            "WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.fingerprint = r.fingerprint)",
            "known",
        ),
        "d04_flag_known": q(
            "SELECT post_id, (k.fingerprint IS NOT NULL) AS is_duplicate FROM raw_printed r "
            "LEFT JOIN known k ON k.fingerprint = r.fingerprint",
            "known",
        ),
        "d05_register": q("SELECT DISTINCT fingerprint FROM raw_printed", "raw_printed"),
        "d05_stored_batches": q(
            "SELECT post_id, username FROM raw_printed QUALIFY "
            "row_number() OVER (PARTITION BY fingerprint ORDER BY (\"timestamp\" >= TIMESTAMP '2024-01-10 00:00:00'), ingest_seq) = 1",
            "raw_printed",
        ),
        "d05_stream_dedup": q("SELECT DISTINCT fingerprint FROM raw_printed", "raw_printed"),
        "d06_duplicate_counts": q(
            "SELECT count(*) AS total_posts, count(DISTINCT fingerprint) AS unique_posts, "
            "count(*) - count(DISTINCT fingerprint) AS duplicate_posts FROM printed",
            "printed",
        ),
        # features
        "f01_engagement": q("SELECT post_id, round(engagement_score, 6) AS engagement_score FROM feat", "feat"),
        "f02_tokens": f"SELECT doc_id, {joined(f'''regexp_extract_all(lower(text), '[{WD}]+')''')} AS tokens FROM documents",
        "f03_keyword_hits": q("SELECT post_id, bullish_keyword_count, bearish_keyword_count FROM feat", "feat"),
        "f04_polarity": q("SELECT post_id, round(sentiment_score, 6) AS sentiment_score FROM feat", "feat"),
        "f05_length": "SELECT doc_id, CAST(length(text) AS INTEGER) AS tweet_length FROM documents",
        "f06_word_count": f"SELECT doc_id, CAST(len(regexp_extract_all(text, '[^{SP}]+')) AS INTEGER) AS word_count FROM documents",
        "f07_tag_counts": q("SELECT post_id, hashtag_count, mention_count FROM feat", "feat"),
        "f08_feature_matrix": q(
            f"SELECT post_id, {POST_OUT}, round(engagement_score, 6) AS engagement_score, tweet_length, word_count, "
            "hashtag_count, mention_count, round(sentiment_score, 6) AS sentiment_score, bullish_keyword_count, "
            "bearish_keyword_count FROM feat",
            "feat",
        ),
        # keywords
        "t01_documents": q("SELECT count(*) AS documents FROM docs", "docs"),
        "t02_t03_words": q(f"SELECT post_id, {joined('w')} AS words FROM kept_words", "kept_words"),
        "t04_ngrams": q("SELECT post_id, term, count(*) AS n FROM terms GROUP BY post_id, term", "terms"),
        "t05_term_frequency": q("SELECT post_id, term, tf FROM tf", "tf"),
        "t06_document_frequency": q(
            "SELECT term, CAST(sum(tf) AS BIGINT) AS total, count(*) AS df FROM tf GROUP BY term HAVING count(*) >= 3", "tf"
        ),
        "t07_vocabulary": q("SELECT term, total, df FROM vocab", "vocab"),
        "t08_smoothed_idf": q("SELECT term, round(idf, 6) AS idf FROM vocab", "vocab"),
        "t09_document_scores": q("SELECT post_id, term, tf, round(tfidf, 6) AS tfidf FROM scores", "scores"),
        "t10_score_new_texts": T10,
        "t11_mean_scores": q("SELECT keyword, round(score, 6) AS score FROM means", "means"),
        "t09_repeated_keys": T09_KEYS,
        "t11_large_vocabulary": T11_LARGE,
        "t13_no_texts": q("SELECT count(*) AS keywords FROM uniq WHERE length(content) < 0", "uniq"),
        "t12_top_keywords": q(
            "SELECT keyword, round(score, 6) AS score FROM means ORDER BY round(means.score, 12) DESC, keyword LIMIT 10", "means"
        ),
        "t12_keywords_by_hashtag": T12_TAG,
        # signal
        "g01_weighted_signal": q("SELECT post_id, round(weighted_signal, 6) AS weighted_signal FROM sig", "sig"),
        "g03_without_keyword_counts": q(
            "SELECT post_id, round(sentiment_score * (ln(1 + engagement_score) + 1), 6) AS weighted_signal FROM feat", "feat"
        ),
        "g05_finite_signals": G05,
        "g06_moments": q(
            "SELECT count(*) AS n, round(avg(weighted_signal), 6) AS mean, round(stddev_samp(weighted_signal), 6) AS std, "
            "count(*) FILTER (WHERE weighted_signal > 0) AS bulls, count(*) FILTER (WHERE weighted_signal < 0) AS bears FROM sig",
            "sig",
        ),
        "g07_confidence_interval": q("SELECT ci_95_lower, ci_95_upper FROM summed", "summed"),
        "g08_label_by_hashtag": q(
            f"SELECT hashtag, signal_label FROM ({summary(TAGGED, 'hashtag', 0.5, -0.5)})", "sig"
        ),
        "g09_confidence": q("SELECT confidence_score FROM summed", "summed"),
        "g10_shares": q("SELECT bullish_percentage, bearish_percentage FROM summed", "summed"),
        "g11_summary": q("SELECT * FROM summed", "summed"),
        "g12_no_finite_signal": q(summary("sig", column="weighted_signal / 0.0"), "sig"),
        "g13_rolling_summary": q(_rolling(), "sig"),
        "g13_rolling_stream": q(_rolling(), "sig"),
        "g_summary_by_hashtag": q(summary(TAGGED, "hashtag"), "sig"),
        "g_summary_by_hour": q(
            summary("(SELECT *, date_trunc('hour', \"timestamp\") AS hour FROM sig)", "hour"), "sig"
        ),
        # chart tables
        "v01_posts_over_time": q(
            'SELECT hour, coalesce(n, 0) AS posts FROM (SELECT unnest(generate_series(date_trunc(\'hour\', min("timestamp")), '
            "date_trunc('hour', max(\"timestamp\")), INTERVAL 1 HOUR)) AS hour FROM uniq) LEFT JOIN "
            "(SELECT date_trunc('hour', \"timestamp\") AS h, count(*) AS n FROM uniq GROUP BY 1) ON h = hour",
            "uniq",
        ),
        "v01_wild_date": q(
            """, wild AS (SELECT date_trunc('hour', CASE WHEN post_id = 0 THEN TIMESTAMP '2051-01-01 00:30:00' ELSE "timestamp" END) AS h FROM uniq)
            SELECT hour, coalesce(n, 0) AS posts FROM (SELECT unnest(generate_series(min(h), max(h), INTERVAL 1 HOUR)) AS hour FROM wild)
            LEFT JOIN (SELECT h, count(*) AS n FROM wild GROUP BY 1) ON h = hour""",
            "uniq",
        ),
        "v02_top_hashtags": q(
            "SELECT '#' || tag AS hashtag, count(*) AS frequency FROM (SELECT unnest(hashtags) AS tag FROM uniq) "
            "GROUP BY 1 ORDER BY frequency DESC, hashtag LIMIT 10",
            "uniq",
        ),
        "v03_engagement_histogram": q(histogram("feat", "engagement_score"), "feat"),
        "v04_signal_histogram": q(histogram("sig", "weighted_signal"), "sig"),
        "v04_sentiment_histogram": q(histogram("feat", "sentiment_score"), "feat"),
        "v05_signal_overlay": q(
            "SELECT 'mean' AS line, mean_signal AS position FROM summed UNION ALL "
            "SELECT 'ci_95_lower', ci_95_lower FROM summed UNION ALL SELECT 'ci_95_upper', ci_95_upper FROM summed",
            "summed",
        ),
        "v06_chart_rows": q(CHART_ROWS, "sig"),
        # end to end
        "p01_signal_summary": q("SELECT * FROM summed", "summed"),
        "p02_run_outputs": q(
            f"""{CHART_ROWS} UNION ALL SELECT 'posts', CAST(post_id AS VARCHAR), likes FROM uniq
            UNION ALL SELECT 'features', CAST(post_id AS VARCHAR), round(engagement_score, 6) FROM sig
            UNION ALL SELECT * FROM (SELECT 'top_keywords', keyword, round(score, 6) FROM means ORDER BY round(means.score, 12) DESC, keyword LIMIT 10)
            UNION ALL SELECT 'signal_summary', signal_label, mean_signal FROM summed
            UNION ALL SELECT 'run', 'total', (SELECT count(*) FROM texts)
            UNION ALL SELECT 'run', 'retained', (SELECT count(*) FROM cleaned)
            UNION ALL SELECT 'run', 'duplicates', (SELECT count(*) FROM cleaned) - (SELECT count(*) FROM uniq)""",
            "sig",
            "means",
            "summed",
        ),
        "p04_job_batches": q(
            "SELECT post_id, username FROM printed QUALIFY "
            "row_number() OVER (PARTITION BY fingerprint ORDER BY (\"timestamp\" >= TIMESTAMP '2024-01-10 00:00:00'), ingest_seq) = 1",
            "printed",
        ),
        "p03_nothing_left": q(summary("(SELECT * FROM sig WHERE false)"), "sig"),
    }
    return sql


LAKE = """SELECT CAST("timestamp" AS DATE) AS "date", hashtag, count(*) AS posts, count(DISTINCT post_id) AS distinct_posts
FROM (SELECT "timestamp", post_id, unnest(CASE WHEN likes % 5 = 0 OR len(hashtags) = 0 THEN [NULL] ELSE hashtags END) AS hashtag
  FROM uniq) GROUP BY 1, 2"""
QUOTAS = "(SELECT unnest([999, 1000, 1001, 7000]) AS quota)"
CHART_ROWS = f"""
SELECT 'posts_over_time' AS output, strftime(h, '%Y-%m-%d %H') AS item, CAST(coalesce(n, 0) AS DOUBLE) AS value
FROM (SELECT unnest(generate_series(date_trunc('hour', min("timestamp")), date_trunc('hour', max("timestamp")), INTERVAL 1 HOUR)) AS h FROM sig)
LEFT JOIN (SELECT date_trunc('hour', "timestamp") AS g, count(*) AS n FROM sig GROUP BY 1) ON g = h
UNION ALL SELECT * FROM (SELECT 'top_hashtags', '#' || tag AS tag, count(*) AS n FROM (SELECT unnest(hashtags) AS tag FROM sig)
  GROUP BY 2 ORDER BY n DESC, 2 LIMIT 10)
UNION ALL SELECT 'engagement_histogram', CAST(bin AS VARCHAR), posts FROM ({histogram("sig", "engagement_score")})
UNION ALL SELECT 'signal_chart', CAST(bin AS VARCHAR), posts FROM ({histogram("sig", "weighted_signal")})"""


def _vocabulary(size: int) -> str:
    """Scores of every document by a vocabulary of ``size`` terms."""
    return f"""(SELECT {size} AS max_features, post_id, term, tf, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY post_id)) AS tfidf
  FROM tf JOIN (SELECT term, ln((1.0 + (SELECT count(*) FROM docs)) / (1.0 + df)) + 1 AS idf FROM (
    SELECT term, sum(tf) AS total, count(*) AS df FROM tf GROUP BY term ORDER BY total DESC, term LIMIT {size})) USING (term))"""


T09_KEYS = query(
    f"""SELECT CASE WHEN post_id % 7 <> 0 THEN post_id % 997 END AS post_id, max_features, count(*) AS n,
  CAST(sum(tf) AS BIGINT) AS tf, round(sum(tfidf), 4) AS tfidf
FROM (SELECT * FROM {_vocabulary(50)} UNION ALL SELECT * FROM {_vocabulary(5000)}) GROUP BY 1, 2""",
    "tf",
    "docs",
)
T11_LARGE = query(
    f"SELECT term AS keyword, round(sum(tfidf) / (SELECT count(*) FROM docs), 6) AS score FROM {_vocabulary(5000)} GROUP BY term",
    "tf",
    "docs",
)

BARE_LINK = "('https://x.example/' || lang || ' ' || chr(10))"

T10 = query(
    f"""
, new_words AS MATERIALIZED (SELECT doc_id, [w FOR w IN regexp_extract_all(lower(text), '[{WD}]+')
  IF NOT list_contains({words(STOP_WORDS)}, w)] AS w FROM documents),
new_tf AS (SELECT doc_id, term, count(*) AS tf FROM (
  SELECT doc_id, unnest(w) AS term FROM new_words
  UNION ALL SELECT doc_id, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) FROM new_words) GROUP BY 1, 2)
SELECT doc_id, term, tf, round(tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)), 6) AS tfidf
FROM new_tf JOIN vocab USING (term)""",
    "vocab",
)

T12_TAG = query(
    """
, tagged AS (SELECT post_id, unnest(hashtags) AS hashtag FROM docs),
tag_size AS (SELECT hashtag, count(*) AS n FROM tagged GROUP BY 1),
tag_tf AS MATERIALIZED (SELECT hashtag, post_id, term, tf FROM tf JOIN tagged USING (post_id)),
tag_vocab AS (SELECT hashtag, term, ln((1.0 + n) / (1.0 + df)) + 1 AS idf, n FROM (
  SELECT hashtag, term, sum(tf) AS total, count(*) AS df FROM tag_tf GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY hashtag ORDER BY total DESC, term) <= 50) JOIN tag_size USING (hashtag)),
tag_scores AS (SELECT hashtag, term, n, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY post_id, hashtag)) AS s
  FROM tag_tf JOIN tag_vocab USING (hashtag, term)),
tag_means AS (SELECT hashtag, term AS keyword, sum(s) / n AS score FROM tag_scores GROUP BY hashtag, term, n)
SELECT hashtag, keyword, round(score, 6) AS score FROM tag_means
QUALIFY row_number() OVER (PARTITION BY hashtag ORDER BY round(tag_means.score, 12) DESC, keyword) <= 5""",
    "tf",
    "docs",
)

G05 = query(
    """SELECT count(*) AS n, round(sum(x), 4) AS total FROM (
  SELECT weighted_signal / (CASE WHEN likes = 0 THEN 0.0 ELSE 1.0 END) AS x FROM sig) WHERE isfinite(x)""",
    "sig",
)

import html
import re
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from chatterlens.functions import text, unicode
from chatterlens.operators.clean import clean_posts, clean_text


def python_clean(value):
    value = html.unescape(value)
    value = re.sub(r"https?://\S+|www\.\S+", "", value, flags=re.IGNORECASE)
    value = unicodedata.normalize("NFKC", value)
    value = re.sub(r"[\x00-\x1f\x7f-\x9f]", "", value)
    return re.sub(r"\s+", " ", value).strip()


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r["o"] for r in df.select("i", expression(F.col("t")).alias("o")).orderBy("i").collect()]


EDGES = [
    "AT&amp;T",
    "a&#10;b",
    "see HTTPS://x.y/z ok",
    "ﬁne Ａ x",
    "a\nb",
    "a \n b",
    "a\tb",
    "  　 padded  ",
    "https://x.y",
    "&lt;b&gt; &eacute; &notit; &copy2024 & alone",
    "ｈｔｔｐｓ：／／x.y stays",
    "½ of ² and ™…",
    "é combining",
    "",
    None,
    "www.x.y/é end",
    "&amp;lt; once",
    "text 😀 ₹100 – fine",
    "\x1c\x85 separators",
]


def test_clean_matches_the_stated_rules(spark):
    expected = [python_clean(v or "") for v in EDGES]
    assert column(spark, EDGES, clean_text) == expected


def test_newlines_can_become_spaces(spark):
    assert column(spark, ["a\nb"], lambda c: clean_text(c, newline_to_space=True)) == ["a b"]


def test_space_class_is_python_white_space(spark):
    chars = [chr(i) for i in range(1, sys.maxunicode + 1) if not 0xD800 <= i < 0xE000]
    df = spark.createDataFrame([(ord(c), c) for c in chars if c.isspace() or ord(c) < 0x3100], "i int, c string")
    found = {r["i"] for r in df.filter(F.col("c").rlike(f"^[{text.SPACE}]$")).collect()}
    assert found == {ord(c) for c in chars if c.isspace()}
    assert set(text.SPACE_CHARS) == {c for c in chars if c.isspace()}


def test_stable_characters_never_change_form(spark):
    chars = [c for c in map(chr, range(1, 0x20000)) if not 0xD800 <= ord(c) < 0xE000]
    df = spark.createDataFrame([(ord(c), c) for c in chars], "i int, c string")
    stable = {r["i"] for r in df.filter(~unicode.may_change_form(F.col("c"))).collect()}
    assert len(stable) > 700 and ord("😀") in stable
    for i in stable:
        assert unicodedata.is_normalized("NFKC", chr(i)) and not unicodedata.combining(chr(i))
        assert unicodedata.is_normalized("NFKC", "e" + chr(i)) and unicodedata.is_normalized("NFKC", chr(i) * 2)
    assert {ord(c) for c in chars if unicodedata.normalize("NFKC", c) != c}.isdisjoint(stable)


def test_tags(spark):
    values = ["#A #a #b_1 ##c #-", "#बाज़ार x", "no tag", ""]
    assert column(spark, values, lambda c: text.unique_tags(c, text.HASHTAG)) == [["a", "b_1", "c"], ["ब"], [], []]
    assert column(spark, ["@Bob hi @bob"], lambda c: text.find_tags(c, text.MENTION)) == [["bob", "bob"]]


def test_counts(spark):
    assert column(spark, ["😀 a", "", "  "], text.word_count) == [2, 0, 0]
    assert column(spark, ["😀 a", ""], F.length) == [3, 0]
    assert column(spark, ["Don't STOP_me 2x"], text.tokens) == [["don", "t", "stop_me", "2x"]]


def test_merge_drop_and_counts(spark, make_posts):
    from pyspark.sql import Observation

    posts = make_posts(
        {"content": "Buy #Gold @Me", "hashtags": ["zinc", "gold"], "mentions": ["you"]},
        {"content": "https://only.link"},
    )
    seen = Observation()
    rows = clean_posts(posts, observation=seen).collect()
    assert [(r.content, r.hashtags, r.mentions) for r in rows] == [("Buy #Gold @Me", ["gold", "zinc"], ["me", "you"])]
    assert seen.get == {"total": 2, "retained": 1}
    assert [r.content for r in clean_posts(posts).collect()] == ["Buy #Gold @Me"]
    assert clean_posts(posts, drop_empty=False).count() == 2


def test_cleaning_is_idempotent_on_plain_text(spark):
    once = column(spark, ["a  b https://x.y c", " q\n"], clean_text)
    assert column(spark, once, clean_text) == once


def test_common_entities_need_no_python(spark):
    """Entities alone, side by side, doubled, cut short and unknown; only some texts are sent to Python."""
    texts = [
        "a &amp; b &lt;i&gt; &quot;q&quot; &#39;s&apos;", "&amp;lt; &amp;amp;", "&copy;&middot;&mdash;&euro;", "no entity & none",
        "&&amp;lt;", "&amp &ampx; &lt", "&nbsp;&eacute;&#x41;&#8364;", "&a&amp;mp;", "&AMP; &Lt;", "&notit; &amp;notit;", None, "",
    ]
    assert column(spark, texts, unicode.unescape_html) == [None if t is None else html.unescape(t) for t in texts]
    asked = column(spark, texts, unicode.may_hold_rare_entity)
    assert asked == [False] * 4 + [True] * 6 + [None, False]


def test_each_text_is_cleaned_once(spark, make_posts, capsys):
    """The drop of empty posts must not be pushed below the cleaning and repeat it."""
    clean_posts(make_posts({})).explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1


@pytest.mark.parametrize("zone", ["Asia/Kolkata", "America/New_York"])
def test_iso_text_does_not_depend_on_the_session_zone(spark, zone):
    from chatterlens.functions.times import hour_utc, iso_utc, parse_iso

    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        texts = [
            "2024-03-10T02:30:00.5Z",
            "2024-03-10 02:30:00",
            "2024-07-01T02:30:00.000001",
            "1969-12-31T23:59:59.25Z",
            "2024-07-01T00:10:00+05:30",
        ]
        got = column(spark, texts, lambda c: iso_utc(parse_iso(c)))
        hour = column(spark, ["2024-01-01T00:10:00Z"], lambda c: F.unix_seconds(hour_utc(parse_iso(c))))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [
        "2024-03-10T02:30:00.500000+00:00",
        "2024-03-10T02:30:00+00:00",
        "2024-07-01T02:30:00.000001+00:00",
        "1969-12-31T23:59:59.250000+00:00",
        "2024-06-30T18:40:00+00:00",
    ]
    assert hour == [1704067200]


def test_cheap_forms_equal_plain_expressions(spark, capsys):
    """Guards look for bytes or ranges first; the result is that of the plain expression for every character."""
    chars = spark.range(0x110000).filter("not (id between 55296 and 57343)").select(F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "utf-32").alias("c"))
    x = F.concat(F.lit("a"), F.col("c"), F.lit("b"))
    old_form = x.rlike(rf"[^\x00-\x7f{unicode.NFKC_STABLE}]")
    assert chars.filter(old_form != x.rlike(unicode.NFKC_MAY_CHANGE)).count() == 0
    assert chars.filter(text.collapse_space(x) != F.regexp_replace(x, rf"[{text.SPACE}]+", " ")).count() == 0
    values = ["a  b", "hTTps://x y", "see WwW.x y", "wWw. z", "", None, "ww.w", "http://"]
    rows = spark.createDataFrame([(v,) for v in values], "t string")
    plain = F.regexp_replace("t", text.URL, "")
    assert rows.filter(~text.drop_urls(F.col("t")).eqNullSafe(plain)).count() == 0
    rows.select(text.drop_urls(F.col("t")), text.collapse_space(F.col("t"))).explain()
    assert "://)" in capsys.readouterr().out

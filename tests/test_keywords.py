import math
import re
from collections import Counter

import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from chatterlens.functions.words import STOP_WORDS
from chatterlens.operators import keywords as kw
from chatterlens.session import scratch_dir

TEXTS = [
    "Gain of value, gain again",
    "Nifty gains as banks rally; banks lead",
    "the and of",
    "  ",
    "Rally in banks: nifty value",
    "été été Nifty",
]


def corpus(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "post_id bigint, content string")


def python_terms(text):
    words = [w for w in re.findall(r"\w+", text.lower()) if w not in STOP_WORDS]
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def python_scores(texts, k, min_df=1):
    docs = [Counter(python_terms(t)) for t in texts if t.strip()]
    total, df = Counter(), Counter()
    for doc in docs:
        total.update(doc)
        df.update(doc.keys())
    vocab = sorted((t for t in total if df[t] >= min_df), key=lambda t: (-total[t], t))[:k]
    idf = {t: math.log((1 + len(docs)) / (1 + df[t])) + 1 for t in vocab}
    means = dict.fromkeys(vocab, 0.0)
    for doc in docs:
        row = {t: doc[t] * idf[t] for t in vocab if t in doc}
        norm = math.sqrt(sum(x * x for x in row.values()))
        for t, x in row.items():
            means[t] += x / norm / len(docs)
    return means


def test_stop_words_are_sparks_own(spark):
    loaded = StopWordsRemover.loadDefaultStopWords("english")
    assert set(STOP_WORDS) == {w for w in loaded if "'" not in w}


def test_bigrams_bridge_stop_words(spark):
    got = kw.with_terms(corpus(spark, ["gain of value", "solo", "of"])).orderBy("post_id").collect()
    assert [r.terms for r in got] == [["gain", "value", "gain value"], ["solo"], []]
    trigrams = kw.with_terms(corpus(spark, ["a b c d"]), ngram_range=(2, 3), stop_words=())
    assert trigrams.first().terms == ["a b", "b c", "c d", "a b c", "b c d"]


@pytest.mark.parametrize("k, min_df", [(5, 1), (100, 1), (100, 2)])
def test_means_match_the_formula(spark, k, min_df):
    df = corpus(spark)
    got = {r.keyword: r.score for r in kw.fit(df, k, min_df=min_df).mean_scores(df).collect()}
    assert got == pytest.approx(python_scores(TEXTS, k, min_df))


def test_row_local_and_join_plans_agree(spark, monkeypatch):
    df = corpus(spark)
    local = kw.fit(df, 8)
    monkeypatch.setattr(kw, "ROW_LOCAL_TERMS", 3)
    joined = kw.fit(df, 8)
    assert local.row_local and not joined.row_local

    def table(rows):
        return {(r.post_id, r.term): (r.tf, round(r.tfidf, 9)) for r in rows.collect()}

    assert table(local.transform(df)) == table(joined.transform(df))
    means = [{r.keyword: round(r.score, 9) for r in m.mean_scores(df).collect()} for m in (local, joined)]
    assert means[0] == means[1]


def test_documents_have_unit_norm(spark):
    df = corpus(spark)
    norms = kw.fit(df, 6).transform(df).groupBy("post_id").agg(F.sum(F.pow("tfidf", 2)).alias("n")).collect()
    assert [r.n for r in norms] == pytest.approx([1.0] * len(norms))


def test_empty_corpora_give_no_keywords(spark):
    for texts in ([], ["", " "], ["the of"]):
        df = corpus(spark, texts) if texts else corpus(spark, ["x"]).filter("false")
        assert kw.top_keywords(df).collect() == []
        assert kw.fit(df).transform(df).collect() == []


def test_scoring_nothing_with_a_fitted_model(spark):
    df = corpus(spark)
    model = kw.fit(df, 5)
    assert model.transform(df.filter("false")).count() == 0
    assert model.mean_scores(df.filter("false")).agg(F.sum("score")).first()[0] in (None, 0.0)


def test_save_and_load(spark):
    df = corpus(spark)
    model = kw.fit(df, 7, ngram_range=(1, 1))
    path = scratch_dir(spark, "model")
    model.save(path)
    loaded = kw.KeywordModel.load(spark, path)
    assert (loaded.n_docs, loaded.ngram_range, loaded.local) == (model.n_docs, model.ngram_range, model.local)
    assert loaded.top_keywords(df, 3).collect() == model.top_keywords(df, 3).collect()


def test_save_and_load_keep_all_settings(spark):
    df = corpus(spark, ["beta gamma of", "beta of"])
    model = kw.fit(df, 9, ngram_range=(1, 3), stop_words=("beta",))
    path = scratch_dir(spark, "model")
    model.save(path)
    loaded = kw.KeywordModel.load(spark, path)
    assert (loaded.stop_words, loaded.local) == (("beta",), model.local)
    empty = kw.fit(df, 9, ngram_range=(2, 2), min_df=5)
    path = scratch_dir(spark, "model")
    empty.save(path)
    loaded = kw.KeywordModel.load(spark, path)
    assert (loaded.n_docs, loaded.ngram_range, loaded.n_terms) == (2, (2, 2), 0)


def test_every_row_is_a_document_at_every_size(spark, monkeypatch):
    """Repeated keys, NULL keys, equal rows, and rows without a vocabulary term."""
    rows = [(1, "alpha beta"), (1, "alpha"), (1, "alpha"), (None, "beta beta"), (None, "beta beta"), (2, "of"), (2, "of")]
    df = spark.createDataFrame(rows, "post_id bigint, content string")
    local = kw.fit(df, 3)
    monkeypatch.setattr(kw, "ROW_LOCAL_TERMS", 1)
    joined = kw.fit(df, 3)
    assert local.row_local and not joined.row_local

    def table(scores):
        return sorted((r.post_id or 0, r.term, r.tf, round(r.tfidf, 9)) for r in scores.collect())

    assert table(local.transform(df)) == table(joined.transform(df))
    means = [{r.keyword: round(r.score, 9) for r in m.mean_scores(df).collect()} for m in (local, joined)]
    assert means[0] == means[1]


def test_keywords_by_hashtag_equal_one_corpus_each(spark):
    tags = [["a"], ["a", "b"], ["b"], ["a"], ["b"], ["a"]]
    df = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(zip(TEXTS, tags))], "post_id bigint, content string, hashtags array<string>")
    got = {(r.hashtag, r.keyword): r.score for r in kw.top_keywords_by_hashtag(df, 50, 6).collect()}
    expected = {}
    for tag in ("a", "b"):
        texts = [t for t, g in zip(TEXTS, tags) if tag in g]
        expected |= {(tag, k): v for k, v in python_scores(texts, 6).items()}
    assert got == pytest.approx(expected)


def test_bad_arguments(spark):
    with pytest.raises(ValueError):
        kw.fit(corpus(spark), 0)
    with pytest.raises(ValueError):
        kw.with_terms(corpus(spark), ngram_range=(2, 1))


def test_most_frequent_terms_whatever_the_hashes(spark, monkeypatch):
    """Few numbers for many terms: bounds are loose, the result is the same."""
    docs = spark.range(600).select(F.col("id").alias("post_id"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(12)), lambda i: F.concat(F.lit("w"), F.pmod(F.hash(F.col("id") * i), i * i + 3))), " ").alias("content"))
    rows = [r.content for r in docs.collect()]
    for buckets in (2, 64, 1 << 20):
        monkeypatch.setattr(kw, "TERM_BUCKETS", buckets)
        monkeypatch.setattr(kw, "BUCKETS_A_TERM", 0)
        for k, min_df in ((5, 1), (40, 1), (40, 25), (100_000, 2)):
            got = kw.vocabulary(docs, k, min_df).collect()
            total, df = Counter(), Counter()
            for t in rows:
                total.update(python_terms(t))
                df.update(set(python_terms(t)))
            want = sorted((t for t in total if df[t] >= min_df), key=lambda t: (-total[t], t))[:k]
            assert [(r.term, r.total, r.df) for r in got] == [(t, total[t], df[t]) for t in want]


def test_rare_terms_are_not_counted_one_by_one(spark, monkeypatch):
    """Every document has words of its own: exact counts cover some hundred terms of 60,000."""
    common = F.concat(F.lit("c"), F.pmod(F.col("id"), F.lit(9)).cast("string"))
    docs = spark.range(20_000).select(F.col("id").alias("post_id"), F.concat_ws(" ", common, common, F.concat(F.lit("u"), "id"), F.concat(F.lit("v"), "id")).alias("content"))
    seen = []
    statistics = kw.term_statistics

    def counted(*args, **named):
        seen.append(statistics(*args, **named))
        return seen[-1]

    monkeypatch.setattr(kw, "term_statistics", counted)
    model = kw.fit(docs, 8)
    assert {r.total for r in model.table.collect()} == {4444, 4446} and model.n_terms == 8
    assert sum(df.count() for df in seen) < 3_000


def test_scores_make_no_array_of_the_vocabulary(spark, capsys):
    kw.fit(corpus(spark), 10).transform(corpus(spark)).explain()
    plan = capsys.readouterr().out
    assert "vector_to_array" not in plan and "vectorToArray" not in plan and "UDF" in plan


def test_hash_numbers_are_not_joined_by_a_shuffle(spark, capsys):
    """The exact count of a few numbers' terms groups by term and shuffles nothing else."""
    prepared = kw.with_terms(corpus(spark))
    numbers = [r.b for r in prepared.select(F.explode("terms").alias("t")).select(kw._bucket(F.col("t"), 64).alias("b")).distinct().collect()]
    some = kw.term_statistics(prepared, (), numbers[:3], 64)
    some.explain()
    plan = capsys.readouterr().out
    assert "Join" not in plan and plan.count("Exchange") == 1
    want = kw.term_statistics(prepared).filter(kw._bucket(F.col("term"), 64).isin(numbers[:3]))
    assert sorted(some.collect()) == sorted(want.collect())
    assert kw.term_statistics(prepared, (), [], 64).count() == 0


def hashtag_corpora(spark):
    """600 posts of 12 words under one to three of five hashtags."""
    word = F.transform(F.sequence(F.lit(1), F.lit(12)), lambda i: F.concat(F.lit("w"), F.pmod(F.hash(F.col("id") * i), i * i + 3)))
    tags = F.transform(F.sequence(F.lit(0), F.col("id") % 3), lambda i: F.concat(F.lit("t"), (F.col("id") + i) % 5))
    return spark.range(600).select(F.col("id").alias("post_id"), F.array_join(word, " ").alias("content"), tags.alias("hashtags"))


def test_most_frequent_terms_by_hashtag_whatever_the_hashes(spark, monkeypatch):
    docs = hashtag_corpora(spark)
    rows = docs.collect()
    monkeypatch.setattr(kw, "BUCKETS_A_TERM", 0)
    for buckets, k, min_df in ((2, 5, 1), (64, 4, 1), (64, 7, 25), (1 << 14, 40, 2)):
        monkeypatch.setattr(kw, "HASHTAG_BUCKETS", buckets)
        tagged = kw.with_terms(docs).select("terms", F.explode("hashtags").alias("hashtag"))
        got = {}
        for r in kw.most_frequent_terms_by(tagged, "hashtag", k, min_df).collect():
            got.setdefault(r.hashtag, set()).add((r.term, r.total, r.df))
        for tag in ("t0", "t3"):
            total, df = Counter(), Counter()
            for r in rows:
                if tag in r.hashtags:
                    total.update(python_terms(r.content))
                    df.update(set(python_terms(r.content)))
            want = sorted((t for t in total if df[t] >= min_df), key=lambda t: (-total[t], t))[:k]
            assert got[tag] == {(t, total[t], df[t]) for t in want}


def test_rare_terms_of_a_hashtag_are_not_counted_one_by_one(spark, monkeypatch):
    common = F.concat(F.lit("c"), F.pmod(F.col("id"), F.lit(9)).cast("string"))
    text = F.concat_ws(" ", common, common, F.concat(F.lit("u"), "id"), F.concat(F.lit("v"), "id"))
    docs = spark.range(20_000).select(F.col("id").alias("post_id"), text.alias("content"), F.array(F.lit("a")).alias("hashtags"))
    seen = []
    statistics = kw.term_statistics

    def counted(*args, **named):
        seen.append(statistics(*args, **named))
        return seen[-1]

    monkeypatch.setattr(kw, "term_statistics", counted)
    assert kw.top_keywords_by_hashtag(docs, 3, 8).count() == 3
    assert sum(df.count() for df in seen) < 3_000


def test_a_large_vocabulary_shuffles_documents_once(spark, monkeypatch, capsys):
    """Copies of a key and text are counted first; terms are then counted and normalised where the document is."""
    monkeypatch.setattr(kw, "ROW_LOCAL_TERMS", 1)
    texts = [(1, "lot gain lot"), (1, "lot gain lot"), (None, "gain loss"), (1, "loss"), (2, "lot gain lot")]
    posts = spark.createDataFrame(texts, "post_id bigint, content string")
    model = kw.fit(posts, 4)
    capsys.readouterr()
    model._scores_by_join(posts, "content", "post_id").explain()
    assert capsys.readouterr().out.count("hashpartitioning(") == 1
    found = Counter((r.post_id, r.term, r.tf) for r in model.transform(posts).collect())
    assert found[(1, "lot", 2)] == 2 and found[(2, "lot", 2)] == 1 and found[(None, "gain", 1)] == 1
    means = {r.keyword: r.score for r in model.mean_scores(posts).collect()}
    monkeypatch.undo()
    expected = {r.keyword: r.score for r in kw.fit(posts, 4).mean_scores(posts).collect()}
    assert means == pytest.approx(expected)


@pytest.mark.parametrize("ngram_range", [(1, 1), (1, 2), (1, 3)])
def test_terms_among_wanted_words(spark, ngram_range):
    """Only n-grams of wanted words, also beside rows that hold none, one, or no word at all."""
    df = corpus(spark, ["gain gain of gain loss gain", "loss", "of", "", "gain", "loss gain value gain"])
    every = kw.with_terms(df, ngram_range=ngram_range).collect()
    want = {r.post_id: [t for t in r.terms if set(t.split(" ")) <= {"gain", "value"}] for r in every}
    some = kw.with_terms_among(df, "content", ngram_range, tuple(STOP_WORDS), lambda w: w.isin(["gain", "value"]))
    assert {r.post_id: r.terms for r in some.collect()} == want


def test_fitting_puts_few_terms_together(spark, monkeypatch):
    """Words bound the n-grams they are in, so no term is put together from other words; ties at the bound are kept."""
    texts = ["a1 b1 a1 b1", "z9 y8", "z9 y8", "y8 z9 x7", "b1 w6"]
    docs = corpus(spark, texts)
    want = {k: python_scores(texts, k) for k in (1, 3, 6, 50)}

    def refused(*args, **named):
        raise AssertionError("all terms are put together")

    monkeypatch.setattr(kw, "with_terms", refused)
    for buckets in (2, 1 << 16):
        monkeypatch.setattr(kw, "TERM_BUCKETS", buckets)
        monkeypatch.setattr(kw, "BUCKETS_A_TERM", 0)
        for k, scores in want.items():
            got = {r.keyword: r.score for r in kw.fit(docs, k, stop_words=tuple(STOP_WORDS)).mean_scores(docs).collect()}
            assert got == pytest.approx(scores)


def test_words_beyond_the_first_numbers_are_counted(spark):
    """Frequent words that are in too few documents leave room for words of smaller numbers."""
    texts = [" ".join(f"r{i}" for i in range(12)) + " " + " ".join(f"r{i}" for i in range(12)), "k1 k2", "k1 k2"]
    got = kw.vocabulary(corpus(spark, texts), 2, 2).collect()
    assert [(r.term, r.total, r.df) for r in got] == [("k1", 2, 2), ("k1 k2", 2, 2)]


@pytest.mark.parametrize("row_local", [0, 256])
@pytest.mark.parametrize("listed", [0, 2_000])
@pytest.mark.parametrize("buckets", [2, 1 << 14])
def test_keywords_by_hashtag_in_every_way(spark, monkeypatch, row_local, listed, buckets):
    """Few numbers, no lists of words, scoring by join: results are those of one corpus a hashtag, also where keys repeat or are missing."""
    monkeypatch.setattr(kw, "ROW_LOCAL_BY_HASHTAG", row_local)
    monkeypatch.setattr(kw, "ROW_LOCAL_TERMS", listed)
    monkeypatch.setattr(kw, "HASHTAG_BUCKETS", buckets)
    monkeypatch.setattr(kw, "BUCKETS_A_TERM", 0)
    rows = [(1, t, g) for t in TEXTS for g in (["a", None, "a"], ["b"], [], None)] + [(None, TEXTS[0], ["a", "c"])] * 2
    df = spark.createDataFrame(rows, "post_id bigint, content string, hashtags array<string>")
    for top, size, min_df in ((50, 4, 1), (3, 6, 2)):
        got = {(r.hashtag, r.keyword): r.score for r in kw.top_keywords_by_hashtag(df, top, size, min_df=min_df).collect()}
        expected = {}
        for tag in "abc":
            scores = python_scores([t for _, t, g in rows if tag in (g or [])], size, min_df)
            best = sorted(scores, key=lambda t: (-round(scores[t], 12), t))[:top]
            expected |= {(tag, t): scores[t] for t in best if scores[t] > 0}
        assert got == pytest.approx(expected)


def test_posts_are_not_shuffled_to_be_scored_by_hashtag(spark, capsys):
    df = corpus(spark).withColumn("hashtags", F.array(F.lit("a"), F.lit("b")))
    best = kw.top_keywords_by_hashtag(df, 5, 6)
    capsys.readouterr()
    best.explain()
    plan = capsys.readouterr().out
    assert "_digest" not in plan and "post_id" not in re.sub("Scan .*", "", plan)


def test_counts_in_the_row(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b"]), (1, []), (None, ["c"])], "post_id bigint, terms array<string>")
    got = [(r.post_id, [tuple(c) for c in r.counted]) for r in kw.with_counts(df).collect()]
    assert got == [(1, [("a", 1), ("b", 2)]), (1, []), (None, [("c", 1)])]


def test_terms_of_a_key_of_its_own_are_not_shuffled(spark, capsys):
    texts = [(1, "lot gain lot"), (1, "lot loss"), (None, "gain"), (None, "gain gain"), (2, "lot lot gain"), (3, "the")]
    for rows, shuffles in ((texts, True), (texts[1:3] + texts[4:], False)):
        df = kw.with_terms(spark.createDataFrame(rows, "post_id bigint, content string"))
        counted = kw.term_counts(df)
        capsys.readouterr()
        counted.explain()
        assert ("hashpartitioning(" in capsys.readouterr().out) == shuffles
        expected = Counter((key, term) for key, text in rows for term in python_terms(text))
        assert Counter({(r.post_id, r.term): r.tf for r in counted.collect()}) == expected


def test_terms_beside_the_vocabulary_are_left_out_in_the_row(spark, monkeypatch):
    """Scores by join are the same with and without a list of the vocabulary; with one, no other term is put together."""
    monkeypatch.setattr(kw, "ROW_LOCAL_TERMS", 2)
    posts = spark.createDataFrame([(i % 3 or None, t) for i, t in enumerate(TEXTS * 2)], "post_id bigint, content string")
    model, rows = kw.fit(posts, 7), []
    assert not model.row_local and model.n_terms == 7
    every = kw.with_terms
    for listed in (2, 1):
        monkeypatch.setattr(kw, "ROW_LOCAL_TERMS", listed)
        called = []
        monkeypatch.setattr(kw, "with_terms", lambda *a, **b: called.append(1) or every(*a, **b))
        rows.append(sorted((r.post_id or 0, r.term, r.tf, round(r.tfidf, 9)) for r in model.transform(posts).collect()))
        assert bool(called) == (listed == 1)
    assert rows[0] == rows[1] and rows[0]

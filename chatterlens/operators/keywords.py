"""TF-IDF keywords: n-gram terms, a capped vocabulary, smoothed idf, L2-normalised documents.

Fitting counts hashes first and then only terms that can be among the most frequent. Scoring with a vocabulary of bounded size stays inside the row:
counting, weighting and normalising need no shuffle, and the mean per term is one small partial
aggregate. Larger vocabularies are scored by joins instead.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, NGram, Normalizer, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from chatterlens.functions.text import is_blank, tokens
from chatterlens.functions.words import STOP_WORDS
from chatterlens.schema import KEYWORD_SCHEMA, VOCAB_SCHEMA, require_columns
from chatterlens.session import stored

# Vocabularies up to this many terms live in the driver and in every task.
ROW_LOCAL_TERMS = 2_000
# Numbers that terms are hashed to when the most frequent ones are looked for: at least so many, and so many a term
# that is wanted, so that what rare terms add up to on a number stays below the wanted terms.
TERM_BUCKETS, BUCKETS_A_TERM = 1 << 16, 64
# A hashtag's vocabulary of up to so many terms meets a post as one row.
ROW_LOCAL_BY_HASHTAG = 256
# As many a hashtag at least, where terms are looked for by hashtag.
HASHTAG_BUCKETS = 1 << 14
SETTINGS = "n_docs bigint, ngram_range array<int>, stop_words array<string>"


def ranking() -> list[Column]:
    """Best score first, ties by name; rounding keeps sums added in another order tied."""
    return [F.desc(F.round("score", 12)), F.asc("keyword")]


def documents(df: DataFrame, text: str = "content") -> DataFrame:
    """Rows with text; they alone make up the corpus."""
    return df.filter(~is_blank(F.col(text)))


def with_terms(
    df: DataFrame,
    text: str = "content",
    ngram_range: tuple[int, int] = (1, 2),
    stop_words: Sequence[str] = tuple(STOP_WORDS),
) -> DataFrame:
    """Adds ``terms``: n-grams of the lower-case tokens left once stop words are taken out."""
    low, high = ngram_range
    if not 1 <= low <= high:
        raise ValueError(f"ngram_range must satisfy 1 <= low <= high, got {ngram_range}")
    words = df.withColumn("_raw", tokens(F.col(text)))
    if stop_words:
        remover = StopWordsRemover(
            inputCol="_raw", outputCol="_words", stopWords=list(stop_words), caseSensitive=True, locale="en_US"
        )
        words = remover.transform(words)
    else:
        words = words.withColumn("_words", F.col("_raw"))
    sizes = range(low, high + 1)
    for n in sizes:
        words = (
            words.withColumn("_gram1", F.col("_words"))
            if n == 1
            else NGram(n=n, inputCol="_words", outputCol=f"_gram{n}").transform(words)
        )
    joined = F.concat(*[F.col(f"_gram{n}") for n in sizes])
    return words.withColumn("terms", joined).drop("_raw", "_words", *[f"_gram{n}" for n in sizes])


def _places(name: str) -> Column:
    """0, 1 and so on, as many as an array has; a sequence from 0 to -1 would run backwards."""
    return F.when(F.size(name) > 0, F.sequence(F.lit(0), F.size(name) - 1)).otherwise(F.array().cast("array<int>"))


def with_terms_among(
    df: DataFrame, text: str, ngram_range: tuple[int, int], stop_words: Sequence[str], wanted: Callable[[Column], Column]
) -> DataFrame:
    """As ``with_terms``, but only the n-grams all of whose words are ``wanted``; no other term is put together.

    Places of the wanted words are found first: what follows is as long as they are many.
    """
    low, high = ngram_range
    found = tokens(F.col(text))
    out = df.withColumn("_words", F.filter(found, lambda w: ~w.isin(list(stop_words))) if stop_words else found)
    places = _places("_words")

    def holds(last: int) -> Callable[[Column], Column]:
        if last == 0:
            return lambda i: wanted(F.get(F.col("_words"), i))
        return lambda i: (i + last < F.size("_words")) & wanted(F.get(F.col("_words"), i + last))

    for n in range(1, high + 1):
        out = out.withColumn(f"_at{n}", F.filter(places if n == 1 else F.col(f"_at{n - 1}"), holds(n - 1)))

    def gram(n: int) -> Callable[[Column], Column]:
        return lambda i: F.get(F.col("_words"), i) if n == 1 else F.array_join(F.slice("_words", i + 1, F.lit(n)), " ")

    grams = [F.transform(f"_at{n}", gram(n)) for n in range(low, high + 1)]
    return out.withColumn("terms", F.concat(*grams)).drop("_words", *[f"_at{n}" for n in range(1, high + 1)])


def with_terms_of(
    df: DataFrame, vocab: DataFrame, text: str, ngram_range: tuple[int, int], stop_words: Sequence[str]
) -> DataFrame:
    """As ``with_terms``; where the stored ``vocab`` is short enough for a list, other terms are left out in the row."""
    known = [r["term"] for r in vocab.select("term").distinct().limit(4 * ROW_LOCAL_TERMS + 1).collect()]
    if len(known) > 4 * ROW_LOCAL_TERMS:
        return with_terms(df, text, ngram_range, stop_words)
    words = sorted({w for t in known for w in t.split(" ")})
    prepared = with_terms_among(df, text, ngram_range, stop_words, lambda w: w.isin(words))
    return prepared.withColumn("terms", F.filter("terms", lambda t: t.isin(known)))


def with_counts(df: DataFrame) -> DataFrame:
    """``counted``, each distinct term of the row with its ``tf``, in place of ``terms``; no term leaves its row.

    Terms are sorted and the first one of each kind found: a kind is as frequent as it is far to the next one.
    """
    ordered = df.withColumn("_sorted", F.sort_array("terms")).drop("terms")
    first = ordered.withColumn(
        "_first", F.filter(_places("_sorted"), lambda i: (i == 0) | (F.get("_sorted", i) != F.get("_sorted", i - 1)))
    )

    def kind(i: Column, k: Column) -> Column:
        upto = F.coalesce(F.get("_first", k + 1), F.size("_sorted"))
        return F.struct(F.get("_sorted", i).alias("term"), (upto - i).cast("bigint").alias("tf"))

    return first.withColumn("counted", F.transform("_first", kind)).drop("_sorted", "_first")


def _rows_of(array: str) -> Column:
    """The structs of an array column as rows. For a plain column Spark would infer a filter, and make the array again."""
    return F.inline(F.slice(array, F.lit(1), F.size(array)))


def occurrences(df: DataFrame, keys: Sequence[str] = ("post_id",)) -> DataFrame:
    """One row per term occurrence, from the ``terms`` column.

    The sort brings repeats together for the aggregation that follows. It also makes the exploded value
    an expression: for a plain column Spark would infer a filter and build the terms twice.
    """
    return df.select(*keys, F.explode(F.sort_array("terms")).alias("term"))


def term_counts(df: DataFrame, keys: Sequence[str] = ("post_id",)) -> DataFrame:
    """Occurrences of each term in each document; rows of equal keys, also of missing ones, are one document.

    A key that no other row has is counted in its row. Only the terms of repeated keys are shuffled to be added up.
    ``df`` is read twice, so it should come from a table.
    """
    per_row = with_counts(df.select(*keys, "terms")).select(*keys, _rows_of("counted"))
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    again = stored(repeated.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]), "repeated-keys")
    if again.isEmpty():
        return per_row
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    once, more = (with_counts(df.select(*keys, "terms").join(again, same, how)).select(*keys, _rows_of("counted")) for how in ("left_anti", "left_semi"))
    return once.unionByName(more.groupBy(*keys, "term").agg(F.sum("tf").alias("tf")))


def term_statistics(
    df: DataFrame, keys: Sequence[str] = (), among: DataFrame | Sequence[int] | None = None, buckets: int = TERM_BUCKETS
) -> DataFrame:
    """Corpus total and document frequency per term, or per term whose hash is in ``among``: a stored table, with the
    keys if there are any, or a list that every task is given.

    Terms are sorted inside the row and laid beside their predecessors: a term unlike its predecessor is
    the first of its document. Both counts then come from one partial aggregation by term, without a
    shuffle by document.
    """
    ordered = df.select(*keys, F.sort_array("terms").alias("_sorted"))
    shorter = F.slice("_sorted", F.lit(1), F.greatest(F.size("_sorted") - 1, F.lit(0)))
    shifted = F.concat(F.array(F.lit(None).cast("string")), shorter)
    pairs = F.arrays_zip(F.col("_sorted").alias("term"), shifted.alias("before"))
    first = ~F.col("term").eqNullSafe(F.col("before"))
    each = ordered.select(*keys, F.inline(pairs))
    if isinstance(among, DataFrame):
        each = each.withColumn("bucket", _bucket(F.col("term"), buckets)).join(among, [*keys, "bucket"])
    elif among is not None:
        each = each.withColumn("bucket", _bucket(F.col("term"), buckets)).filter(_in_list("bucket", among))
    return (
        each.groupBy(*keys, "term")
        .agg(F.count(F.lit(1)).alias("total"), F.count_if(first).alias("df"))
    )


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _in_list(name: str, numbers: Sequence[int]) -> Column:
    return F.expr(f"{name} in ({', '.join(map(str, numbers))})") if numbers else F.lit(False)


def _few(df: DataFrame, most: int) -> list[int] | DataFrame:
    """The ``bucket`` numbers of a stored table as a list, or the table where they are more than ``most``."""
    rows = df.select("bucket").limit(most + 1).collect()
    return df.select("bucket") if len(rows) > most else [r["bucket"] for r in rows]


def most_frequent_terms(prepared: DataFrame, n: int, min_df: int = 1) -> tuple[DataFrame, int]:
    """(the ``n`` terms of highest ``total`` with their ``df``, ties by name; number of documents), exactly.

    Most terms are rare, and counting each of them would send nearly all text over the network. First only hashes
    are counted: what falls on a number is an upper bound for every term of that number. The terms of the largest
    numbers are counted exactly; the n-th best of them is a lower bound. A number below it holds no term of the
    result, so only the terms of the remaining ones are counted too, which is seldom any.
    """
    spark, buckets = prepared.sparkSession, max(TERM_BUCKETS, BUCKETS_A_TERM * n)

    def kept(df: DataFrame, schema: str) -> DataFrame:
        """A result of some n rows: in the driver if n is small, else stored."""
        return spark.createDataFrame(df.collect(), schema) if n <= ROW_LOCAL_TERMS else stored(df, "terms")

    marked = F.explode(F.concat("terms", F.array(F.lit(None).cast("string")))).alias("term")
    hashed = prepared.select(marked).groupBy(F.when(F.col("term").isNull(), -1).otherwise(_bucket(F.col("term"), buckets)).alias("bucket"))
    sums = stored(hashed.agg(F.count(F.lit(1)).alias("most")), "term-hashes")
    first = kept(sums.orderBy(F.col("bucket") >= 0, F.desc("most"), "bucket").limit(4 * n + 1), "bucket int, most bigint")
    head = first.filter("bucket = -1").select(F.col("most").alias("n_docs")).first()
    taken, counted, best = first.filter("bucket >= 0"), first, None
    schema, order = "term string, total bigint, df bigint", (F.desc("total"), F.asc("term"))
    while not taken.isEmpty():
        # Numbers go to the tasks as a list, or are joined from a stored table: Spark knows no size of rows that the
        # driver made, and would send all terms over the network to meet them.
        among = _few(taken, 4 * ROW_LOCAL_TERMS)
        exact = term_statistics(prepared, (), among, buckets).filter(F.col("df") >= min_df)
        some = kept(exact.orderBy(*order).limit(n), schema)
        best = some if best is None else kept(best.unionByName(some).orderBy(*order).limit(n), schema)
        last = best.agg(F.count(F.lit(1)).alias("n"), F.min("total").alias("least")).first()
        bound = last["least"] if last["n"] == n else 0
        taken = sums.filter(F.col("most") >= bound).join(counted.select("bucket"), "bucket", "left_anti")
        if not taken.isEmpty():
            taken = stored(taken, "term-hashes")
            counted = counted.select("bucket").unionByName(taken.select("bucket"))
    return (spark.createDataFrame([], schema) if best is None else best), head["n_docs"] if head else 0


def most_frequent_ngrams(
    docs: DataFrame, text: str, n: int, min_df: int, ngram_range: tuple[int, int], stop_words: Sequence[str]
) -> tuple[DataFrame, int]:
    """``most_frequent_terms`` of texts, with single words in place of terms where these are terms themselves.

    A term is at most as frequent as each of its words, so only words are hashed and counted. Terms whose words all
    have one of the largest numbers are counted exactly; the n-th best of them is a lower bound, and a word of a
    number below it is in no term of the result. The terms of the other words are counted too where there are any
    more. Many wanted terms, or n-grams alone, are looked for by hashes of whole terms.
    """

    def by_terms() -> tuple[DataFrame, int]:
        return most_frequent_terms(with_terms(docs, text, ngram_range, stop_words), n, min_df)

    low, high = ngram_range
    if low != 1 or high < low or n > ROW_LOCAL_TERMS:
        return by_terms()
    spark, buckets = docs.sparkSession, max(TERM_BUCKETS, BUCKETS_A_TERM * n)
    word = F.explode(F.concat(tokens(F.col(text)), F.array(F.lit(None).cast("string")))).alias("word")
    words = docs.select(word)
    if stop_words:
        words = words.filter(F.col("word").isNull() | ~F.col("word").isin(list(stop_words)))
    bucket = F.when(F.col("word").isNull(), -1).otherwise(_bucket(F.col("word"), buckets)).alias("bucket")
    sums = stored(words.groupBy(bucket).agg(F.count(F.lit(1)).alias("most")), "word-hashes")
    first = sums.orderBy(F.col("bucket") >= 0, F.desc("most"), "bucket").limit(4 * n + 1).collect()
    among = [r["bucket"] for r in first if r["bucket"] >= 0]

    def best() -> list[Row]:
        prepared = with_terms_among(docs, text, ngram_range, stop_words, lambda w: _bucket(w, buckets).isin(among))
        exact = term_statistics(prepared).filter(F.col("df") >= min_df)
        return exact.orderBy(F.desc("total"), F.asc("term")).limit(n).collect()

    rows = best() if among else []
    bound = rows[-1]["total"] if len(rows) == n else 0
    may_hold = sums.filter((F.col("bucket") >= 0) & (F.col("most") >= bound)).select("bucket")
    more = [r["bucket"] for r in may_hold.limit(4 * ROW_LOCAL_TERMS + 1).collect()]
    if len(more) > 4 * ROW_LOCAL_TERMS:
        return by_terms()
    if not set(more) <= set(among):
        among = sorted({*among, *more})
        rows = best()
    n_docs = next((r["most"] for r in first if r["bucket"] < 0), 0)
    return spark.createDataFrame(rows, "term string, total bigint, df bigint"), n_docs


def most_frequent_terms_by(
    tagged: DataFrame, key: str, n: int, min_df: int = 1, ordered: DataFrame | None = None
) -> DataFrame:
    """The ``n`` terms of highest ``total`` of each ``key`` with their ``df``, ties by name, exactly.

    As ``most_frequent_terms``, with bounds for every key of its own: hashes are counted, the terms of each key's
    largest numbers exactly, and then those of the numbers that may still hold a term of the result. ``tagged`` has
    ``key`` and ``terms``; ``ordered`` are the same rows with sorted terms, which exact counts can use.
    """
    buckets = max(HASHTAG_BUCKETS, BUCKETS_A_TERM * n)
    number = _bucket(F.col("term"), buckets).alias("bucket")
    hashed = tagged.select(key, F.explode("terms").alias("term")).groupBy(key, number)
    sums = stored(hashed.agg(F.count(F.lit(1)).alias("most")), "term-hashes")

    def best(df: DataFrame, n: int, *order: Column) -> DataFrame:
        window = Window.partitionBy(key).orderBy(*order)
        return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")

    def exact(taken: DataFrame) -> DataFrame:
        counted = term_statistics(tagged if ordered is None else ordered, [key], taken, buckets).filter(F.col("df") >= min_df)
        return best(counted, n, F.desc("total"), F.asc("term"))

    first = stored(best(sums, 4 * n, F.desc("most"), F.asc("bucket")).select(key, "bucket"), "term-hashes")
    some = stored(exact(first), "terms")
    bound = some.groupBy(key).agg(F.when(F.count(F.lit(1)) == n, F.min("total")).otherwise(0).alias("least"))
    left = sums.join(first, [key, "bucket"], "left_anti").join(bound, key, "left").filter(F.col("most") >= F.coalesce("least", F.lit(0)))
    taken = stored(left.select(key, "bucket"), "term-hashes")
    return some if taken.isEmpty() else best(some.unionByName(exact(taken)), n, F.desc("total"), F.asc("term"))


def most_frequent_ngrams_by(
    tagged: DataFrame, key: str, tags: str, text: str, n: int, min_df: int, ngram_range: tuple[int, int], stop_words: Sequence[str]
) -> DataFrame:
    """``most_frequent_terms_by`` of texts, each with an array ``tags`` of keys.

    A term is at most as frequent as each of its words. Where single words are terms, these are hashed and counted by key,
    then the words of a key's largest numbers exactly, or all words of a key that has few numbers; the n-th best of them is
    a lower bound, and words of other numbers that may reach it are counted too. Only longer terms of words that reach the
    bound of some key are put together. Too many such words for a list, or longer terms alone, are left to hashes of whole
    terms.
    """
    low, high = ngram_range

    def by_terms() -> DataFrame:
        prepared = with_terms(tagged, text, ngram_range, stop_words).select("terms", tags)
        # Sorted before the tags are taken apart: later sorts of the same terms find them in order.
        ordered = prepared.select(F.sort_array("terms").alias("terms"), F.explode(tags).alias(key))
        return most_frequent_terms_by(prepared.select("terms", F.explode(tags).alias(key)), key, n, min_df, ordered)

    if low != 1 or high < low:
        return by_terms()
    buckets = max(HASHTAG_BUCKETS, BUCKETS_A_TERM * n)
    found = tokens(F.col(text))
    words = F.filter(found, lambda w: ~w.isin(list(stop_words))) if stop_words else found
    each = tagged.select(F.transform(words, lambda w: _bucket(w, buckets)).alias("_numbers"), F.explode(tags).alias(key))
    # Not the plain column: Spark would infer a filter and take the texts apart twice.
    numbers = F.explode(F.slice("_numbers", F.lit(1), F.size("_numbers"))).alias("bucket")
    sums = stored(each.select(key, numbers).groupBy(key, "bucket").agg(F.count(F.lit(1)).alias("most")), "word-hashes")

    def counted(df: DataFrame, among: DataFrame | None = None) -> DataFrame:
        each = with_counts(df).select("counted", F.explode(tags).alias(key)).select(key, _rows_of("counted"))
        if among is not None:
            each = each.withColumn("bucket", _bucket(F.col("term"), buckets)).join(among, [key, "bucket"])
        counts = each.groupBy(key, "term").agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df"))
        return counts.filter(F.col("df") >= min_df)

    def first(df: DataFrame, n: int, rank: Column, *order: Column) -> DataFrame:
        return df.withColumn("_rank", rank.over(Window.partitionBy(key).orderBy(*order))).filter(F.col("_rank") <= n).drop("_rank")

    single = with_terms(tagged, text, (1, 1), stop_words)
    few = sums.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") <= BUCKETS_A_TERM * n).select(key)
    largest = first(sums, 4 * n, F.row_number(), F.desc("most"), F.asc("bucket"))
    taken = largest.unionByName(sums.join(few, key, "left_semi")).select(key, "bucket").distinct()
    taken = stored(taken, "word-hashes")
    # Rows of equal totals have one rank: every word that reaches the n-th total is there.
    frequent = stored(first(counted(single, taken), n, F.rank(), F.desc("total")), "words")
    bound = frequent.groupBy(key).agg(F.when(F.count(F.lit(1)) >= n, F.min("total")).otherwise(0).alias("least"))
    left = sums.join(taken, [key, "bucket"], "left_anti").join(bound, key, "left").filter(F.col("most") >= F.coalesce("least", F.lit(0)))
    more = stored(left.select(key, "bucket"), "word-hashes")
    if not more.isEmpty():
        frequent = stored(first(frequent.unionByName(counted(single, more)), n, F.rank(), F.desc("total")), "words")
    merged = frequent
    if high > 1:
        listed = [r["term"] for r in frequent.select("term").distinct().limit(4 * ROW_LOCAL_TERMS + 1).collect()]
        if len(listed) > 4 * ROW_LOCAL_TERMS:
            return by_terms()
        longer = with_terms_among(tagged, text, (2, high), stop_words, lambda w: w.isin(listed))
        merged = frequent.unionByName(counted(longer))
    return first(merged, n, F.row_number(), F.desc("total"), F.asc("term"))


def normalised_scores(counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """L2-normalised tf x idf per document; ``counted`` has tf and idf."""
    norm = F.sqrt(F.sum(F.pow(F.col("tf") * F.col("idf"), 2)).over(Window.partitionBy(*keys)))
    return counted.withColumn("tfidf", F.col("tf") * F.col("idf") / norm)


def scores_by_join(df: DataFrame, vocab: DataFrame, on: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Scores per document and vocabulary term; all other terms leave before the shuffle by document.

    ``vocab`` is a stored table, so Spark knows its size: a small one is broadcast, a large one is joined by
    shuffle, where AQE splits the partitions of very frequent terms. ``keys`` include a digest of the text:
    rows equal in all of them are copies, counted down in each task, and ``copies`` says how many there are.
    An empty term marks every document, since a copy without vocabulary terms is not in the join.
    """
    extra = [c for c in vocab.columns if c not in on]
    kinds = {f.name: f.dataType for f in vocab.schema}
    hits = occurrences(df, keys).join(vocab, list(on)).select(*keys, "term", *extra)
    marks = df.select(*keys, F.lit("").alias("term"), *[F.lit(None).cast(kinds[c]).alias(c) for c in extra])
    counted = hits.unionByName(marks).groupBy(*keys, "term", *extra).agg(F.count(F.lit(1)).alias("n_rows"))
    copies = F.max(F.when(F.col("term") == "", F.col("n_rows"))).over(Window.partitionBy(*keys))
    each = counted.withColumn("copies", copies).filter(F.col("term") != "").withColumn("tf", F.expr("n_rows div copies"))
    return normalised_scores(each, keys)


@dataclass(frozen=True)
class KeywordModel:
    """A fitted vocabulary. ``table`` is ``(term, total, df, idf)``, ``n_docs`` the corpus size."""

    table: DataFrame
    n_docs: int
    n_terms: int
    ngram_range: tuple[int, int]
    stop_words: tuple[str, ...]
    # Terms and idf in vector order; None when the vocabulary is too large to be kept in every task.
    local: tuple[tuple[str, ...], tuple[float, ...]] | None = field(repr=False)

    @property
    def row_local(self) -> bool:
        return self.local is not None

    def _vectors(self, df: DataFrame, text: str) -> DataFrame:
        """Adds ``tf`` and ``tfidf`` sparse vectors over the vocabulary."""
        terms, idf = self.local
        counter = CountVectorizerModel.from_vocabulary(list(terms), inputCol="terms", outputCol="tf")
        weights = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="tf", outputCol="_weighted")
        unit = Normalizer(p=2.0, inputCol="_weighted", outputCol="tfidf")
        words = sorted({w for t in terms for w in t.split(" ")})
        prepared = with_terms_among(documents(df, text), text, self.ngram_range, self.stop_words, lambda w: w.isin(words))
        return unit.transform(weights.transform(counter.transform(prepared)))

    def transform(self, df: DataFrame, text: str = "content", key: str = "post_id") -> DataFrame:
        """Scores of new documents: ``(key, term, tf, tfidf)``, one row per vocabulary term present."""
        require_columns(df, [text, key], "KeywordModel.transform")
        narrow = df.select(key, text)
        if self.n_terms == 0:
            return narrow.sparkSession.createDataFrame([], f"{key} bigint, term string, tf bigint, tfidf double")
        if not self.row_local:
            return self._transform_by_join(narrow, text, key)
        # Sparse vectors hold the places and values of the terms present; nothing of vocabulary length is made.
        names = F.array(*[F.lit(t) for t in self.local[0]])
        tf, tfidf = F.unwrap_udt("tf"), F.unwrap_udt("tfidf")
        parts = self._vectors(narrow, text).select(key, tf.alias("tf"), tfidf["values"].alias("tfidf"))
        found = F.arrays_zip(F.col("tf.indices").alias("at"), F.col("tf.values").alias("tf"), F.col("tfidf"))
        return parts.select(key, F.inline(found)).select(
            key, F.get(names, F.col("at")).alias("term"), F.col("tf").cast("bigint").alias("tf"), "tfidf"
        )

    def _scores_by_join(self, df: DataFrame, text: str, key: str) -> DataFrame:
        """One row per distinct document and vocabulary term. Copies, rows alike in key and digest, are counted first.

        Their shuffle is the only one by document where the stored vocabulary is small enough to be broadcast: terms
        are counted in the row and normalised where their document is.
        """
        keys = [key, "_digest"]
        copies = documents(df, text).groupBy(key, F.xxhash64(text).alias("_digest"))
        distinct = copies.agg(F.count(F.lit(1)).alias("copies"), F.min(text).alias(text))
        prepared = with_terms_of(distinct, self.table, text, self.ngram_range, self.stop_words)
        counted = with_counts(prepared).select(*keys, "copies", _rows_of("counted"))
        return normalised_scores(counted.join(self.table.select("term", "idf"), "term"), keys)

    def _transform_by_join(self, df: DataFrame, text: str, key: str) -> DataFrame:
        rows = self._scores_by_join(df, text, key).withColumn("_copy", F.explode(F.expr("sequence(1, copies)")))
        return rows.select(key, "term", "tf", "tfidf")

    def mean_scores(self, df: DataFrame, text: str = "content", key: str = "post_id") -> DataFrame:
        """Mean score of every vocabulary term over all documents with text; absent counts as 0.

        Every row is a document of its own, whatever its ``key``, for vocabularies of every size.
        """
        spark = df.sparkSession
        if self.n_terms == 0:
            return spark.createDataFrame([], KEYWORD_SCHEMA)
        if self.row_local:
            # Grouped by a constant: no documents then give no row, and every score is 0.
            mean = vector_to_array(Summarizer.mean(F.col("tfidf"))).alias("mean")
            means = self._vectors(df.select(text), text).groupBy(F.lit(1)).agg(mean).select("mean")
            terms = self.local[0]
            names = F.array(*[F.lit(t) for t in terms])
            scores = F.coalesce(means.scalar(), F.array_repeat(F.lit(0.0), len(terms)))
            return (
                spark.range(1)
                .select(names.alias("keyword"), scores.alias("score"))
                .select(F.inline(F.arrays_zip("keyword", "score")))
            )
        n_docs = documents(df, text).agg(F.count(F.lit(1)).alias("n")).scalar()
        scored = self._scores_by_join(df.select(key, text), text, key)
        sums = scored.groupBy("term").agg(F.sum(F.col("tfidf") * F.col("copies")).alias("s"))
        return (
            self.table.select("term")
            .join(sums, "term", "left")
            .select(
                F.col("term").alias("keyword"),
                F.coalesce(F.try_divide(F.col("s"), n_docs), F.lit(0.0)).alias("score"),
            )
        )

    def top_keywords(self, df: DataFrame, top_n: int = 20, text: str = "content", key: str = "post_id") -> DataFrame:
        """The terms with the highest mean score, ties by name."""
        return self.mean_scores(df, text, key).orderBy(*ranking()).limit(top_n)

    def save(self, path: str) -> None:
        """Vocabulary and, beside it, one row of settings, so that a model without terms keeps them too."""
        self.table.write.mode("overwrite").parquet(f"{path}/vocabulary")
        row = (self.n_docs, list(self.ngram_range), list(self.stop_words))
        settings = self.table.sparkSession.createDataFrame([row], SETTINGS).coalesce(1)
        settings.write.mode("overwrite").parquet(f"{path}/settings")

    @staticmethod
    def load(spark: SparkSession, path: str) -> KeywordModel:
        kept = spark.read.schema(SETTINGS).parquet(f"{path}/settings").first()
        table = spark.read.schema(VOCAB_SCHEMA).parquet(f"{path}/vocabulary")
        return _model(table, kept["n_docs"], tuple(kept["ngram_range"]), tuple(kept["stop_words"]))


def _model(
    table: DataFrame, n_docs: int, ngram_range: tuple[int, int], stop_words: tuple[str, ...]
) -> KeywordModel:
    """Bring a vocabulary of bounded size to the driver; leave a larger one where it is."""
    rows = table.orderBy("term").limit(ROW_LOCAL_TERMS + 1).collect()
    if len(rows) > ROW_LOCAL_TERMS:
        return KeywordModel(table, n_docs, table.count(), ngram_range, stop_words, None)
    table = table.sparkSession.createDataFrame(rows, VOCAB_SCHEMA)
    local = (tuple(r["term"] for r in rows), tuple(r["idf"] for r in rows))
    return KeywordModel(table, n_docs, len(rows), ngram_range, stop_words, local)


def vocabulary(
    df: DataFrame,
    max_features: int,
    min_df: int = 1,
    text: str = "content",
    ngram_range: tuple[int, int] = (1, 2),
    stop_words: Sequence[str] = tuple(STOP_WORDS),
) -> DataFrame:
    """The most frequent terms of the corpus with ``total`` and ``df``; ties by name. The texts are read twice."""
    return most_frequent_ngrams(documents(df.select(text), text), text, max_features, min_df, ngram_range, stop_words)[0]


def fit(
    df: DataFrame,
    max_features: int = 100,
    ngram_range: tuple[int, int] = (1, 2),
    min_df: int = 1,
    text: str = "content",
    stop_words: Sequence[str] = tuple(STOP_WORDS),
) -> KeywordModel:
    """Fit a vocabulary in two passes over the texts.

    A corpus without text or terms gives a model without terms. A vocabulary too large for the driver is written to
    the shared scratch folder.
    """
    if max_features <= 0:
        raise ValueError(f"max_features must be > 0, got {max_features}")
    require_columns(df, [text], "fit")
    docs = documents(df.select(text), text)
    counted, n_docs = most_frequent_ngrams(docs, text, max_features, min_df, ngram_range, stop_words)
    settings = (tuple(ngram_range), tuple(stop_words))
    table = counted.select("term", "total", "df", smoothed_idf(F.lit(n_docs), F.col("df")).alias("idf"))
    return _model(table, n_docs, *settings)


def smoothed_idf(n_docs: Column, df: Column) -> Column:
    """ln((1 + N) / (1 + df)) + 1."""
    return F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + df)) + F.lit(1.0)


def top_keywords(
    df: DataFrame,
    top_n: int = 20,
    max_features: int = 100,
    ngram_range: tuple[int, int] = (1, 2),
    min_df: int = 1,
    text: str = "content",
    key: str = "post_id",
    stop_words: Sequence[str] = tuple(STOP_WORDS),
) -> DataFrame:
    """Fit on a corpus and rank its own keywords."""
    model = fit(df, max_features, ngram_range, min_df, text, stop_words)
    return model.top_keywords(df, top_n, text, key)


def top_keywords_by_hashtag(
    df: DataFrame,
    top_n: int = 10,
    max_features: int = 50,
    ngram_range: tuple[int, int] = (1, 2),
    min_df: int = 1,
    text: str = "content",
    key: str = "post_id",
    stop_words: Sequence[str] = tuple(STOP_WORDS),
) -> DataFrame:
    """Keywords of every hashtag, each hashtag a corpus of its own.

    The vocabulary grows with the number of hashtags, so it is stored and then joined by its known size, as one row a
    hashtag if these are short; the per-hashtag cut is a group limit that runs before its shuffle.
    """
    tags = F.array_compact(F.array_distinct("hashtags")).alias("_tags")
    tagged = documents(df, text).select(key, text, tags)
    sizes = tagged.select(F.explode("_tags").alias("hashtag")).groupBy("hashtag").agg(F.count(F.lit(1)).alias("n"))
    best_terms = most_frequent_ngrams_by(tagged.select(text, "_tags"), "hashtag", "_tags", text, max_features, min_df, ngram_range, stop_words)
    vocab = best_terms.join(sizes, "hashtag").select("hashtag", "term", "n", smoothed_idf(F.col("n"), F.col("df")).alias("idf"))
    kept = stored(vocab, "vocabulary")
    if max_features <= ROW_LOCAL_BY_HASHTAG:
        sums = _sums_in_row(tagged, kept, text, ngram_range, stop_words)
    else:
        prepared = with_terms(tagged, text, ngram_range, stop_words)
        ordered = prepared.select(key, F.xxhash64(text).alias("_digest"), F.sort_array("terms").alias("terms"), "_tags")
        terms = ordered.select(key, "_digest", "terms", F.explode("_tags").alias("hashtag"))
        scored = scores_by_join(terms, kept, ["hashtag", "term"], [key, "_digest", "hashtag"])
        sums = scored.groupBy("hashtag", "term", "n").agg(F.sum(F.col("tfidf") * F.col("copies")).alias("s"))
    scores = sums.select("hashtag", F.col("term").alias("keyword"), (F.col("s") / F.col("n")).alias("score"))
    best = Window.partitionBy("hashtag").orderBy(*ranking())
    return scores.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top_n)


def _sums_in_row(
    tagged: DataFrame, vocab: DataFrame, text: str, ngram_range: tuple[int, int], stop_words: Sequence[str]
) -> DataFrame:
    """(hashtag, term, n, s): sums of the scores of each hashtag's posts by the hashtag's own vocabulary.

    A post meets the vocabulary of each of its tags as one row, and its terms are weighted and normalised there: neither
    terms nor texts are shuffled to be counted, and every row is a document of its own.
    """
    prepared = with_terms_of(tagged, vocab, text, ngram_range, stop_words)
    lists = vocab.groupBy("hashtag", "n").agg(F.collect_list(F.struct("term", "idf")).alias("_v"))
    lists = lists.select("hashtag", "n", F.col("_v.term").alias("_names"), F.col("_v.idf").alias("_idf"))
    met = with_counts(prepared).select("counted", F.explode("_tags").alias("hashtag")).join(lists, "hashtag")
    placed = F.transform("counted", lambda c: F.struct(F.array_position("_names", c["term"]).cast("int").alias("at"), c["tf"].alias("tf")))
    found = met.select("hashtag", "n", "_names", "_idf", F.filter(placed, lambda p: p["at"] > 0).alias("_found"))
    weights = F.transform(
        "_found", lambda p: F.struct(F.get("_names", p["at"] - 1).alias("term"), (p["tf"] * F.get("_idf", p["at"] - 1)).alias("weight"))
    )
    weighted = found.select("hashtag", "n", weights.alias("_weights"))
    norm = F.sqrt(F.aggregate("_weights", F.lit(0.0), lambda total, x: total + x["weight"] * x["weight"]))
    each = weighted.select("hashtag", "n", norm.alias("_norm"), _rows_of("_weights"))
    return each.groupBy("hashtag", "term", "n").agg(F.sum(F.col("weight") / F.col("_norm")).alias("s"))

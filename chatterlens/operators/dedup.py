"""Fingerprint deduplication within a batch and against known fingerprints.

A fingerprint may be shared by a third of all rows. ``first_per_key`` is safe there: the
``row_number() = 1`` filter becomes a group limit that runs before the shuffle, so each task sends at
most one row per fingerprint. Joins with known fingerprints run on the already reduced rows.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatterlens.functions.text import strip
from chatterlens.functions.times import iso_utc
from chatterlens.operators.ranking import tie_columns
from chatterlens.schema import HASH_SCHEMA, require_columns
from chatterlens.session import scratch_dir, shuffles_released


def fingerprint(username: Column, timestamp: Column, content: Column) -> Column:
    """SHA-256 of lower-case name, ISO time and lower-case stripped text."""
    key = F.concat_ws(":", F.lower(username), iso_utc(timestamp), F.lower(strip(content)))
    return F.sha2(key, 256)


def with_fingerprint(df: DataFrame) -> DataFrame:
    require_columns(df, ["username", "timestamp", "content"], "with_fingerprint")
    return df.withColumn("fingerprint", fingerprint(F.col("username"), F.col("timestamp"), F.col("content")))


def first_per_key(df: DataFrame, key: str, order: str = "ingest_seq") -> DataFrame:
    """The earliest row of each key.

    Rows of equal or missing ``order`` go by their other columns, so any partitioning gives the same row.
    """
    window = Window.partitionBy(key).orderBy(order, *tie_columns(df, [key, order]))
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def _ensure_fingerprint(df: DataFrame) -> DataFrame:
    return df if "fingerprint" in df.columns else with_fingerprint(df)


def deduplicate(df: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """First occurrence of each fingerprint, leaving out those in ``known``."""
    unique = first_per_key(_ensure_fingerprint(df), "fingerprint")
    if known is None:
        return unique
    return unique.join(known.select("fingerprint"), "fingerprint", "left_anti")


def flag_known(df: DataFrame, known: DataFrame) -> DataFrame:
    """Every row with ``is_duplicate``: is its fingerprint in ``known``?

    One join, so the batch is read once; the shuffle that makes ``known`` distinct serves the join too.
    Rows of a fingerprint held by very many copies are spread by AQE's skew-join split.
    """
    hits = known.select("fingerprint").distinct().withColumn("is_duplicate", F.lit(True))
    joined = _ensure_fingerprint(df).join(hits, "fingerprint", "left")
    return joined.withColumn("is_duplicate", F.coalesce("is_duplicate", F.lit(False)))


def register(known: DataFrame, df: DataFrame) -> DataFrame:
    """Known fingerprints together with those of a batch."""
    fresh = _ensure_fingerprint(df).select("fingerprint")
    return known.select("fingerprint").unionByName(fresh).distinct()


def duplicate_counts(df: DataFrame) -> DataFrame:
    """One row: posts, unique posts, duplicates. Copies are counted down per task before the shuffle."""
    per_key = _ensure_fingerprint(df).groupBy("fingerprint").count()
    total = F.coalesce(F.sum("count"), F.lit(0)).cast("bigint")
    return per_key.agg(
        total.alias("total_posts"),
        F.count(F.lit(1)).alias("unique_posts"),
        (total - F.count(F.lit(1))).alias("duplicate_posts"),
    )


class FingerprintStore:
    """Fingerprints kept between batches, one folder a batch, dealt by range; a filter tells which ranges to read.

    A range is the first two hex digits of a fingerprint, or as many as a new store is given. Beside its fingerprints a batch stores Bloom filters: 64-bit
    words, each the OR of the marks of some four fingerprints, as rows of range and word number. New posts are
    looked up in the words, and only the ranges of batches in which a word has all of a post's marks are read for
    the exact comparison, so a batch without known posts reads next to no fingerprint.

    Running a batch again, after a lost driver for instance, gives the same rows: its own earlier folder is left
    out of the comparison and replaced. Filters are written first: a batch counts once its fingerprints are there.
    """

    #: Fingerprints a word, and marks a fingerprint.
    PER_WORD, MARKS = 4, 4

    def __init__(self, spark: SparkSession, path: str, digits: int = 2):
        self.spark = spark
        self.path = path.rstrip("/")
        self._new_digits, self._digits = digits, 0

    @property
    def digits(self) -> int:
        """Hex digits of a range: those the store was begun with."""
        if not self._digits:
            rows = self._read(f"{self.path}/_filters", "range string")
            first = None if rows is None else rows.select("range").first()
            self._digits = len(first["range"]) if first else 0
        return self._digits or self._new_digits

    def batches(self) -> set[int]:
        """Numbers of the batches that have fingerprints."""
        rows = self._fingerprints(None)
        return set() if rows is None else {r["batch"] for r in rows.select("batch").distinct().collect()}

    def _read(self, path: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _fingerprints(self, before_batch: int | None) -> DataFrame | None:
        rows = self._read(self.path, "fingerprint string, batch bigint, range string")
        return rows if rows is None or before_batch is None else rows.filter(F.col("batch") < before_batch)

    def known(self, before_batch: int | None = None) -> DataFrame:
        """Fingerprints of all batches, or of those numbered below ``before_batch``."""
        rows = self._fingerprints(before_batch)
        return self.spark.createDataFrame([], HASH_SCHEMA) if rows is None else rows.select("fingerprint")

    def _range(self) -> Column:
        return F.substring("fingerprint", 1, self.digits).alias("range")

    def _marks(self) -> Column:
        """Bits of a word that a fingerprint sets."""
        places = [F.expr(f"shiftright(xxhash64(fingerprint, 1), {6 * i}) & 63") for i in range(self.MARKS)]
        bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), p.cast("int")) for p in places]
        out = bits[0]
        for bit in bits[1:]:
            out = out.bitwiseOR(bit)
        return out.alias("marks")

    def _word(self, words: Column) -> Column:
        return F.pmod(F.xxhash64("fingerprint", F.lit(2)), words).alias("word")

    def matching_ranges(self, fingerprints: DataFrame, before_batch: int | None = None) -> dict[int, list[str]]:
        """Ranges by batch that may hold one of the fingerprints: at most every folder of the store."""
        filters = self._read(f"{self.path}/_filters", "range string, word bigint, marks bigint, batch bigint, words bigint")
        if filters is None:
            return {}
        if before_batch is not None:
            filters = filters.filter(F.col("batch") < before_batch)
        # A batch's filter has a number of words of its own, a power of two: folders tell which ones there are.
        sizes = [r["words"] for r in filters.select("words").distinct().collect()]
        if not sizes:
            return {}
        asked = fingerprints.select("fingerprint", self._range(), self._marks(), F.explode(F.array(*[F.lit(s) for s in sizes])).alias("words"))
        asked = asked.select("range", "words", self._word(F.col("words")), F.col("marks").alias("asked"))
        hits = filters.join(asked, ["range", "words", "word"]).filter(F.col("marks").bitwiseAND(F.col("asked")) == F.col("asked"))
        found: dict[int, list[str]] = {}
        for row in hits.select("batch", "range").distinct().collect():
            found.setdefault(row["batch"], []).append(row["range"])
        return found

    def read_ranges(self, ranges: dict[int, list[str]]) -> DataFrame:
        """Fingerprints of some ranges; no other file is opened."""
        rows = self._fingerprints(None)
        if rows is None or not ranges:
            return self.spark.createDataFrame([], HASH_SCHEMA)
        alike: dict[tuple[str, ...], list[int]] = {}
        for batch, names in ranges.items():
            alike.setdefault(tuple(sorted(names)), []).append(batch)
        wanted = F.lit(False)
        for names, batches in alike.items():
            wanted = wanted | (F.col("batch").isin(batches) & F.col("range").isin(*names))
        return rows.filter(wanted).select("fingerprint")

    def known_among(self, fingerprints: DataFrame, before_batch: int | None = None) -> DataFrame:
        """Those of the store that may be among the given ones, and all that are."""
        return self.read_ranges(self.matching_ranges(fingerprints, before_batch))

    def new_posts(self, df: DataFrame, batch: int) -> DataFrame:
        """First occurrences that no earlier batch has. The batch is cleaned once and stored for its readers.

        Only fingerprints meet those of the store. What both have is stored, so that Spark knows its size: posts are
        not shuffled to be joined with a few known ones.
        """
        path, hits = scratch_dir(self.spark, "unique"), scratch_dir(self.spark, "known")
        unique = deduplicate(df)
        with shuffles_released(self.spark):
            unique.write.option("compression", "zstd").parquet(path)
        stored = self.spark.read.schema(unique.schema).parquet(path)
        ranges = self.matching_ranges(stored.select("fingerprint"), batch)
        if not ranges:
            return stored
        self.read_ranges(ranges).join(stored.select("fingerprint"), "fingerprint", "left_semi").write.parquet(hits)
        known = self.spark.read.schema(HASH_SCHEMA).parquet(hits)
        return stored.join(known, "fingerprint", "left_anti").select(unique.columns)

    def commit(self, posts: DataFrame, batch: int) -> None:
        """Store the fingerprints of posts that have been written."""
        prints = posts.select("fingerprint", self._range())
        words, each = 1, prints.count() // (self.PER_WORD * 16**self.digits)
        while words < each:
            words *= 2
        filters = prints.groupBy("range", self._word(F.lit(words))).agg(F.bit_or(self._marks()).alias("marks"))
        sorted_ = filters.repartition("range").sortWithinPartitions("range", "word")
        sorted_.withColumn("words", F.lit(words)).write.mode("overwrite").partitionBy("words").parquet(f"{self.path}/_filters/batch={batch}")
        by_range = prints.repartition("range").sortWithinPartitions("range", "fingerprint")
        by_range.write.mode("overwrite").partitionBy("range").parquet(f"{self.path}/batch={batch}")

"""Reading and writing posts: Parquet, JSON lines, the raw capture zone, the partitioned lake."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from chatterlens.functions.times import date_utc, iso_utc, parse_iso
from chatterlens.operators.normalize import conform, normalise_posts
from chatterlens.schema import CAPTURE_SCHEMA, PAGE_SCHEMA, POST_COLUMNS, POST_SCHEMA
from chatterlens.session import shuffles_released, stored


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """Stored posts under the declared schema; a missing path is an AnalysisException."""
    return spark.read.schema(POST_SCHEMA).parquet(path)


def read_normalised_posts(spark: SparkSession, path: str) -> DataFrame:
    """Stored posts, normalised again on the way in; missing tag lists become empty ones."""
    return normalise_posts(read_posts(spark, path))


def empty_posts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], POST_SCHEMA)


def write_posts(df: DataFrame, path: str, compression: str = "snappy", mode: str = "overwrite") -> str:
    """One batch of posts as Parquet under the declared schema; gives the path back.

    An empty batch still leaves a readable table with the full schema. Rows that do not fit the schema are
    not written: ``misfit_posts`` has them.
    """
    with shuffles_released(df.sparkSession):
        conform(df).write.mode(mode).option("compression", compression).parquet(path)
    return path


#: Hashtags of a batch with folders of their own a date, and folders that all others share.
OWN_FOLDERS, SHARED_FOLDERS = 200, 32


def shared_folder(hashtag: Column, shared: int = SHARED_FOLDERS) -> Column:
    return F.concat(F.lit("~"), F.pmod(F.xxhash64(hashtag), F.lit(shared)).cast("string"))


def lake_rows(df: DataFrame, own: DataFrame, shared_folders: int = SHARED_FOLDERS) -> DataFrame:
    """One row per post and tag with ``date`` and ``folder``. ``own`` has the tags with folders of their own.

    Posts are gathered by date before they are taken apart, so a post with k tags is shuffled once.
    """
    dated = df.select(*POST_COLUMNS, date_utc(F.col("timestamp")).alias("date")).hint("rebalance", "date")
    tagged = dated.withColumn("hashtag", F.explode_outer(F.array_distinct("hashtags")))
    # A tag spelled like a shared folder, or of no character, never has a folder of its own.
    folder = (
        F.when(F.col("hashtag").isNull(), "~none")
        .when(F.col("_tag").isNotNull() & ~F.col("hashtag").rlike("^(~|$)"), F.col("hashtag"))
        .otherwise(shared_folder(F.col("hashtag"), shared_folders))
    )
    placed = tagged.join(own, F.col("hashtag") == F.col("_tag"), "left").withColumn("folder", folder)
    return placed.select(*POST_COLUMNS, "hashtag", "date", "folder")


def write_lake(
    df: DataFrame, path: str, batch: int = 0, own_folders: int = OWN_FOLDERS, shared_folders: int = SHARED_FOLDERS
) -> str:
    """A batch of posts by ``date`` and ``folder``; a post with k tags is stored k times, one without once.

    The batch's most frequent hashtags have folders of their own, the others share some, so folders are bounded
    whatever tags people make up. Only the folders that a batch fills are written; running a batch again replaces
    what it wrote, also where the batch has other posts now. ``df`` is read twice, so it should be a table. The rebalance hint gathers each date's posts, before they are
    stored once a tag, so that a folder has few files, and lets AQE split a date that holds far more than the others.
    """
    spark = df.sparkSession
    tag = F.explode_outer(F.array_distinct("hashtags")).alias("hashtag")
    counted = df.select(tag).filter(F.col("hashtag").isNotNull()).groupBy("hashtag").agg(F.count(F.lit(1)).alias("n"))
    top = counted.orderBy(F.desc("n"), F.asc("hashtag")).limit(own_folders).select(F.col("hashtag").alias("_tag"))
    own = stored(top, "folders")
    target = f"{path.rstrip('/')}/batch={batch}"
    placed = lake_rows(df, own, shared_folders)
    with shuffles_released(spark):
        placed.write.mode("overwrite").option("compression", "zstd").partitionBy("date", "folder").parquet(target)
    return path


def read_lake(spark: SparkSession, path: str, hashtag: str | None = None, shared_folders: int = SHARED_FOLDERS) -> DataFrame:
    """The lake with ``hashtag`` and its partition columns ``batch``, ``date`` and ``folder``; filters on them prune
    folders. With ``hashtag`` only the folders that may hold it are read."""
    extra = [("hashtag", StringType()), ("batch", LongType()), ("date", DateType()), ("folder", StringType())]
    schema = StructType([*POST_SCHEMA.fields, *[StructField(name, kind) for name, kind in extra]])
    lake = spark.read.schema(schema).parquet(path)
    if hashtag is None:
        return lake
    shared = spark.range(1).select(shared_folder(F.lit(hashtag), shared_folders).alias("f")).first()["f"]
    return lake.filter(F.col("folder").isin(hashtag, shared) & (F.col("hashtag") == hashtag))


def to_json_lines(df: DataFrame, keyed: bool = True) -> DataFrame:
    """Posts as one ``value`` column of JSON text with ISO timestamps, with or without the two keys in the text."""
    record = F.struct(
        *(["post_id", "ingest_seq"] if keyed else []),
        "username",
        iso_utc(F.col("timestamp")).alias("timestamp"),
        "content",
        "likes",
        "replies",
        "reposts",
        "hashtags",
        "mentions",
    )
    return df.select("post_id", "ingest_seq", F.to_json(record).alias("value"))


_JSON_RECORD = (
    "post_id bigint, ingest_seq bigint, username string, timestamp string, content string, likes string, replies string, reposts string, "
    "hashtags array<string>, mentions array<string>"
)


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with ``file``, ``line`` and ``line_key``, the same however the files are split.

    ``line_key`` is the file's number by name times 2^40 plus the line's number. A task numbers its rows; one row a
    split, with the number of its first row and how many there are, turns that into lines of the file.
    """
    rows = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )
    splits = rows.groupBy("file", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    placed = splits.select(
        F.col("file").alias("_of"),
        F.col("_block").alias("_split"),
        "_first",
        F.coalesce(F.sum("_lines").over(before), F.lit(0)).alias("_before"),
        F.dense_rank().over(Window.orderBy("file")).alias("_file"),
    )
    places = stored(placed, "splits")
    # Both scans of the files are split alike; if they ever were not, the numbers would be wrong.
    alike = F.shiftright("_at", 33) == F.shiftright("_first", 33)
    line = F.when(alike, F.col("_at") - F.col("_first") + F.col("_before")).otherwise(F.raise_error(F.lit("files were split in two ways")).cast("bigint"))
    matched = rows.join(places, (F.col("file") == F.col("_of")) & (F.col("_block") == F.col("_split")))
    numbered = matched.select("value", "file", line.alias("line"), "_file")
    return numbered.select("value", "file", "line", ((F.col("_file") - 1) * (1 << 40) + F.col("line")).cast("bigint").alias("line_key"))


def _parsed_json(lines: DataFrame) -> DataFrame:
    names = ("post_id", "ingest_seq", "file", "line", "line_key")
    keys = [c for c in names if c in lines.columns]
    # One-element explode: later filters on the fields do not parse the text again.
    rows = lines.select(*keys, "value", F.explode(F.array(F.from_json("value", _JSON_RECORD))).alias("r"))

    def key(name: str):
        """The column of the lines, else the record's field, else the place of the line."""
        if name in keys:
            return F.col(name)
        field = F.col(f"r.{name}")
        return (F.coalesce(field, "line_key") if "line_key" in keys else field).alias(name)

    def count(name: str):
        text = F.coalesce(F.col(f"r.{name}"), F.lit("0"))
        return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint")).alias(name)

    def tags(name: str):
        return F.coalesce(F.col(f"r.{name}"), F.array().cast("array<string>")).alias(name)

    return rows.select(
        *[key(k) for k in ("post_id", "ingest_seq")],
        *[k for k in ("file", "line") if k in keys],
        "value",
        F.coalesce("r.username", F.lit("")).alias("username"),
        parse_iso(F.col("r.timestamp")).alias("timestamp"),
        F.coalesce("r.content", F.lit("")).alias("content"),
        count("likes"),
        count("replies"),
        count("reposts"),
        tags("hashtags"),
        tags("mentions"),
    )


def _readable():
    return F.col("timestamp").isNotNull() & F.expr("likes is not null and replies is not null and reposts is not null")


def from_json_lines(lines: DataFrame) -> DataFrame:
    """JSON text back to normalised posts; missing fields take their defaults."""
    return normalise_posts(_parsed_json(lines).filter(_readable()).select(POST_COLUMNS))


def rejected_json_lines(lines: DataFrame) -> DataFrame:
    """Lines that are no record, or whose timestamp or counts cannot be read; with their file and number if known."""
    rows = _parsed_json(lines)
    return rows.filter(~_readable()).select(*[c for c in ("file", "line") if c in rows.columns], "value")


def read_json_posts(spark: SparkSession, path: str) -> DataFrame:
    """Posts of JSON line files, ready for ``prepared_posts``. Records without the two keys get the place of their
    line, so first occurrences are the same for every partitioning."""
    return from_json_lines(read_json_lines(spark, path))


def write_json_posts(df: DataFrame, path: str, mode: str = "overwrite", keyed: bool = True, compression: str = "none") -> str:
    """Posts as files of JSON lines. A compressed file is read by one task, whatever its size."""
    with shuffles_released(df.sparkSession):
        to_json_lines(df, keyed).select("value").write.mode(mode).option("compression", compression).text(path)
    return path


def read_captures(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Captured cards from the raw zone."""
    return spark.read.schema(CAPTURE_SCHEMA).format(fmt).load(path)


def write_captures(df: DataFrame, path: str, fmt: str = "json", mode: str = "append") -> str:
    df.select(CAPTURE_SCHEMA.fieldNames()).write.mode(mode).format(fmt).save(path)
    return path


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGE_SCHEMA).parquet(path)

"""Reading tables, storing intermediate tables and numbering documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterlens.session import scratch_dir

# Words are maximal runs of other characters than these six.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(rows: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read again: cuts lineage and survives lost executors."""
    spark = rows.sparkSession
    path = scratch_dir(spark, label)
    schema = rows.schema
    rows.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def utf8(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def fold(rows: DataFrame, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def ids_are_unique(docs: DataFrame) -> bool:
    """Whether every row has a doc_id of its own."""
    return not docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").limit(1).count()


def numbered(docs: DataFrame) -> DataFrame:
    """doc_id, rid, text (bytes): `rid` orders documents as doc_id does and is the same in every run.

    Where ids are present and unique, rid is the id. Otherwise pairs of id and text are ranked (null ids first,
    equal ids by text digest) and rows equal in both share a rid: they count as one document, and each such
    row gets that document's result.
    """
    slim = docs.select("doc_id", utf8().alias("text"))
    if ids_are_unique(docs):
        return slim.select("doc_id", F.col("doc_id").cast("long").alias("rid"), "text")
    keyed = slim.withColumn("digest", F.xxhash64("text"))
    parts = keyed.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ordered = store(
        keyed.select("doc_id", "digest")
        .distinct()
        .repartitionByRange(int(parts), F.col("doc_id").asc_nulls_first(), "digest")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "digest")
        .select(
            "doc_id",
            "digest",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at"),
        ),
        "ids",
    )
    from pyspark.sql import Window

    sums = ordered.groupBy("part").count().select(
        "part",
        F.coalesce(
            F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("before"),
    )
    ids = ordered.join(sums, "part").select(
        F.col("doc_id").alias("other_id"), F.col("digest").alias("other_digest"), (F.col("at") + F.col("before")).alias("rid")
    )
    return keyed.join(
        ids, F.col("doc_id").eqNullSafe(F.col("other_id")) & (F.col("digest") == F.col("other_digest"))
    ).select("doc_id", "rid", "text")

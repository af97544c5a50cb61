"""Sharding by a two-pass external shuffle, with DataFrame functions only.

Pass one scatters records by a seeded hash into buckets that fit in memory. Pass two shuffles every bucket by
itself with Fisher-Yates, which is what `shuffle` runs on an array, and lays the buckets end to end. A record's
place in that uniformly random order gives its shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatterlens.llm._rows import column, packed, unpacked

BUCKET_BYTES = 32 << 20


def byte_size():
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1


def shuffled(docs: DataFrame, n_shards: int = 16, seed: int = 7, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All columns of `docs`, `shard` and `slot`; columns of `docs` with these names give way. Law `rows`: shards differ by one row at most, slots have no gaps.

    Null texts are one byte long. The hash covers all columns, so equal texts with other ids are spread; rows
    equal in every column meet in one bucket. Arrays, and the buckets of a partition, are sorted before they are
    shuffled, so reruns with as many partitions agree. An empty table gives an empty result.
    """
    total = docs.agg(F.sum(byte_size())).first()[0] or 0
    n = max(1, -(-total // bucket_bytes))
    digest = F.xxhash64(F.lit(seed), *[column(c) for c in docs.columns])
    scattered = docs.select(F.pmod(digest, F.lit(n)).cast("int").alias("bucket"), packed(docs, "shard", "slot").alias("d"))
    upto = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = scattered.groupBy("bucket").count().select(
        F.col("bucket").alias("of_bucket"), F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("offset")
    )
    buckets = scattered.groupBy("bucket").agg(F.array_sort(F.collect_list("d")).alias("all"))
    placed = buckets.sortWithinPartitions("bucket").select("bucket", F.posexplode(F.shuffle("all", F.lit(seed))).alias("at", "d"))
    return placed.join(offsets, F.col("bucket") == F.col("of_bucket")).select(
        *unpacked(docs, "d", "shard", "slot"),
        ((F.col("offset") + F.col("at")) % n_shards).cast("int").alias("shard"),
        F.expr(f"(offset + at) div {n_shards}").alias("slot"),
    )


def write_shards(rows: DataFrame, path: str, slots_per_file: int = 1 << 20) -> None:
    """Parquet folders shard=0, 1, ...: files hold ranges of slots in order, so large shards have many files."""
    rows.withColumn("_range", F.expr(f"slot div {slots_per_file}")).repartition("shard", "_range").sortWithinPartitions(
        "shard", "slot"
    ).drop("_range").write.partitionBy("shard").parquet(path)

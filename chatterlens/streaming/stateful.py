"""Structured Streaming twins: deduplication and rolling signal summaries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chatterlens.operators.dedup import FingerprintStore, with_fingerprint
from chatterlens.operators.signal import rolling_summary
from chatterlens.schema import POST_SCHEMA


#: State on local disk with changes checkpointed, instead of all of it in the executors' heaps.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def keep_state_on_disk(spark: SparkSession) -> None:
    """For streams started from now on; a running stream, or one begun with another provider, keeps its own."""
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)


def read_post_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(POST_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def deduplicate_stream(posts: DataFrame, watermark: str = "1 day") -> DataFrame:
    """First arrival of each fingerprint; state older than the watermark is let go.

    A copy that arrives later than the watermark passes. Use ``foreach_batch_dedup`` where it must not.
    """
    return with_fingerprint(posts).withWatermark("timestamp", watermark).dropDuplicatesWithinWatermark(["fingerprint"])


def foreach_batch_dedup(store: FingerprintStore, posts_path: str) -> Callable[[DataFrame, int], None]:
    """Exact deduplication against everything ever stored.

    Posts are written before their fingerprints, both into a folder of the micro-batch that a repeated
    batch replaces, so a restart neither loses nor doubles a post.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        target = f"{posts_path.rstrip('/')}/batch={batch_id}"
        store.new_posts(batch, batch_id).write.mode("overwrite").option("compression", "zstd").parquet(target)
        store.commit(spark.read.parquet(target), batch_id)

    return write


def rolling_signal_stream(
    scored: DataFrame,
    watermark: str = "2 hours",
    length: str = "1 hour",
    slide: str = "15 minutes",
    **thresholds: float,
) -> DataFrame:
    """Signal summary per sliding window, each emitted once its window is past the watermark."""
    return rolling_summary(scored.withWatermark("timestamp", watermark), length, slide, **thresholds)


def flush_stream(
    stream: DataFrame, spark: SparkSession, name: str, checkpoint: str, output_mode: str = "append"
) -> DataFrame:
    """Run a stream over all input available now into a Parquet folder and read that back.

    Called again with the same ``checkpoint`` it goes on where it stopped.
    """
    keep_state_on_disk(spark)
    target = f"{checkpoint.rstrip('/')}/{name}-out"
    query = (
        stream.writeStream.outputMode(output_mode)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{name}-state")
        .trigger(availableNow=True)
        .format("parquet")
        .start(target)
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)

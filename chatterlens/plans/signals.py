"""The end-to-end plan, lazily as one DataFrame chain and as a job with its outputs."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession

from chatterlens.operators import charts, keywords
from chatterlens.operators.clean import clean_posts
from chatterlens.operators.dedup import FingerprintStore, deduplicate, with_fingerprint
from chatterlens.operators.features import extract_features
from chatterlens.operators.normalize import normalise_posts, rejected_posts, valid_posts
from chatterlens.operators.signal import summarise, with_weighted_signal
from chatterlens.options import JobOptions
from chatterlens.plans.runs import RunLog
from chatterlens.schema import POST_COLUMNS
from chatterlens.session import shuffles_released
from chatterlens.sources.posts import read_posts, write_posts
from chatterlens.sources.results import write_features_csv, write_json


def cleaned_posts(raw: DataFrame, cleaning: Observation | None = None) -> DataFrame:
    """Normalised and cleaned posts; ``cleaning`` receives what ``clean_posts`` counts."""
    return clean_posts(normalise_posts(valid_posts(raw)), observation=cleaning)


def prepared_posts(raw: DataFrame, known: DataFrame | None = None, cleaning: Observation | None = None) -> DataFrame:
    """Normalised, cleaned and unique posts."""
    return deduplicate(cleaned_posts(raw, cleaning), known).select(*POST_COLUMNS, "fingerprint")


def scored_posts(posts: DataFrame) -> DataFrame:
    """Feature matrix with the weighted signal."""
    return with_weighted_signal(extract_features(posts))


def signal_summary(raw: DataFrame, **thresholds: float) -> DataFrame:
    """Raw posts to the one-row signal summary."""
    return summarise(scored_posts(prepared_posts(raw).drop("fingerprint")), **thresholds)


@dataclass(frozen=True)
class RunResult:
    posts_path: str
    features_path: str
    keywords_path: str
    summary_path: str
    rejected_path: str
    chart_paths: dict[str, str] = field(default_factory=dict)
    elapsed_seconds: float = 0.0
    # Valid posts read, those with text left, and those written as unique and new.
    total: int = 0
    retained: int = 0
    unique: int = 0
    # Input lines that are no post.
    rejected_lines: int = 0
    run_path: str = ""

    @property
    def duplicates(self) -> int:
        return self.retained - self.unique

    @property
    def posts_per_second(self) -> float:
        return round(self.unique / self.elapsed_seconds, 2) if self.elapsed_seconds else 0.0


def run(
    spark: SparkSession,
    raw: DataFrame,
    options: JobOptions,
    store: FingerprintStore | None = None,
    batch: int = 0,
    rejected_lines: DataFrame | None = None,
) -> RunResult:
    """Raw posts to posts, features, keywords, summary and chart tables, finished as one.

    All outputs go into a new folder that the run log names last: a run that is lost before leaves the earlier one
    readable. With ``store`` posts of earlier batches are left out, and the posts of all batches are what
    ``RunLog.posts`` reads. The deduplicated posts are written once and read back: every later result starts from
    that table, prunes its columns, and does not depend on the cleaning stages if executors are lost. An empty input
    leaves empty tables with their schema.
    """
    started = time.perf_counter()
    log = RunLog(spark, options.processed_dir)
    out = log.new_folder(batch)
    cleaning = Observation("cleaning")
    # Each result is stored; what was shuffled for it is not kept beside it.
    with shuffles_released(spark):
        if store is None:
            prepared = prepared_posts(raw, cleaning=cleaning)
        else:
            _complete_store(spark, log, store, batch)
            prepared = store.new_posts(cleaned_posts(raw, cleaning), batch)
        posts_path = write_posts(prepared, f"{out}/posts", options.compression)
        posts = read_posts(spark, posts_path)
        counts = {**cleaning.get, "unique": posts.count()}
        rejected_path = f"{out}/rejected"
        rejected_posts(raw).write.mode("overwrite").parquet(rejected_path)
        if rejected_lines is not None:
            rejected_lines.write.mode("overwrite").parquet(f"{out}/rejected_lines")
            counts["rejected_lines"] = spark.read.schema(rejected_lines.schema).parquet(f"{out}/rejected_lines").count()

        # Features are computed once; CSV, summary and charts prune their columns from the stored table.
        matrix = scored_posts(posts)
        matrix.write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/scored")
        scored = spark.read.schema(matrix.schema).parquet(f"{out}/scored")
        features_path = write_features_csv(scored.drop("weighted_signal"), f"{out}/features")

        top = keywords.top_keywords(posts, options.top_n, options.max_features, options.ngram_range)
        keywords_path = write_json(top.coalesce(1), f"{out}/top_keywords")

        summary = summarise(scored, buy_threshold=options.buy_threshold, sell_threshold=options.sell_threshold)
        summary_path = write_json(summary.coalesce(1), f"{out}/signal_summary")
        stored_summary = spark.read.schema(summary.schema).json(summary_path)

        chart_paths = {}
        for name, table in charts.all_charts(scored, stored_summary, options.top_n).items():
            chart_paths[name] = f"{out}/charts/{name}"
            table.coalesce(1).write.mode("overwrite").parquet(chart_paths[name])
        log.finish(batch, out)
        if store is not None:
            store.commit(with_fingerprint(posts), batch)
    return RunResult(
        posts_path,
        features_path,
        keywords_path,
        summary_path,
        rejected_path,
        chart_paths,
        round(time.perf_counter() - started, 2),
        run_path=out,
        **counts,
    )


def _complete_store(spark: SparkSession, log: RunLog, store: FingerprintStore, batch: int) -> None:
    """Fingerprints of finished runs that were lost before they stored theirs."""
    missing = {r["batch"]: r["path"] for r in log.runs() if r["batch"] < batch}
    for number in sorted(set(missing) - store.batches()):
        store.commit(with_fingerprint(read_posts(spark, f"{missing[number]}/posts")), number)

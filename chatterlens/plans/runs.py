"""Finished runs of an output folder: a run counts once its one row in the log is there."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from chatterlens.schema import POST_SCHEMA
from chatterlens.sources.posts import empty_posts

LOG_SCHEMA = "seq bigint, batch bigint, path string"


class RunLog:
    """Runs write into folders of their own; the log is appended to last, one small file a run.

    A run that is lost halfway leaves a folder that nothing reads, and the earlier runs as they were. Of several
    runs of one batch the last one counts.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def new_folder(self, batch: int) -> str:
        return f"{self.root}/runs/batch-{batch}-{uuid.uuid4().hex}"

    def finish(self, batch: int, path: str) -> None:
        seq = max((r["seq"] for r in self.runs()), default=0) + 1
        row = self.spark.createDataFrame([(seq, batch, path)], LOG_SCHEMA)
        row.coalesce(1).write.mode("append").json(f"{self.root}/log")

    def runs(self) -> list[Row]:
        """The last finished run of every batch, latest last: one row a batch."""
        try:
            rows = self.spark.read.schema(LOG_SCHEMA).json(f"{self.root}/log")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        last = rows.groupBy("batch").agg(F.max_by(F.struct("seq", "path"), "seq").alias("r"))
        return last.select("r.seq", "batch", "r.path").orderBy("seq").collect()

    def latest(self) -> str | None:
        """Folder of the run that finished last."""
        runs = self.runs()
        return runs[-1]["path"] if runs else None

    def posts(self) -> DataFrame:
        """Posts of all batches."""
        paths = [f"{r['path']}/posts" for r in self.runs()]
        return self.spark.read.schema(POST_SCHEMA).parquet(*paths) if paths else empty_posts(self.spark)

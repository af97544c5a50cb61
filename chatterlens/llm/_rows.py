"""Passing whole rows through an Arrow function, whatever their columns are called."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def kept_names(rows: DataFrame, *results: str) -> list[str]:
    """The columns of `rows` but for those that have the name of a result."""
    names = {r.lower() for r in results}
    return [c for c in rows.columns if c.lower() not in names]


def packed(rows: DataFrame, *results: str) -> Column:
    """The kept columns as one struct, its fields called by number."""
    return F.struct(F.lit(0).alias("c"), *[column(c).alias(f"c{i}") for i, c in enumerate(kept_names(rows, *results))])


def unpacked(rows: DataFrame, name: str, *results: str) -> list[Column]:
    """The kept columns of `rows`, out of the struct `name` that `packed` made of them."""
    return [F.col(name).getField(f"c{i}").alias(c) for i, c in enumerate(kept_names(rows, *results))]


def with_results(rows: DataFrame, given: Column, results: T.StructType, work: Callable[[pa.Array], pa.Array]) -> DataFrame:
    """All columns of `rows` and the fields of `results`, which `work` makes of a batch of `given`.

    A column of `rows` that has the name of a result gives way to it.
    """
    whole = rows.select(packed(rows, *results.names).alias("row"), given.alias("given"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), work(batch.column(1))], names=["row", "made"])

    made = whole.mapInArrow(run, T.StructType([whole.schema["row"], T.StructField("made", results)]))
    return made.select(
        *unpacked(rows, "row", *results.names),
        *[F.col("made").getField(f.name).alias(f.name) for f in results],
    )

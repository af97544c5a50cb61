"""Record normalisation: the guarantees every post row carries into later operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterlens.functions.text import normalise_tags, strip
from chatterlens.functions.times import ntz_to_utc
from chatterlens.schema import POST_SCHEMA, require_columns

COUNTS = ("likes", "replies", "reposts")
REQUIRED = ("username", "timestamp", "content")


def non_negative(count: Column) -> Column:
    return F.greatest(F.lit(0).cast("bigint"), F.coalesce(count.try_cast("bigint"), F.lit(0).cast("bigint")))


def normalise_posts(df: DataFrame) -> DataFrame:
    """Strip names and text, clamp counts at zero, normalise both tag lists."""
    require_columns(df, [*REQUIRED, *COUNTS, "hashtags", "mentions"], "normalise_posts")
    return df.withColumns(
        {
            "username": strip(F.col("username")),
            "content": strip(F.col("content")),
            **{c: non_negative(F.col(c)) for c in COUNTS},
            "hashtags": normalise_tags(F.col("hashtags"), "#"),
            "mentions": normalise_tags(F.col("mentions"), "@"),
        }
    )


def _complete() -> Column:
    ok = F.lit(True)
    for name in REQUIRED:
        ok = ok & F.col(name).isNotNull()
    return ok


def valid_posts(df: DataFrame) -> DataFrame:
    """Rows whose name, time and text are all present."""
    return df.filter(_complete())


def rejected_posts(df: DataFrame) -> DataFrame:
    """The quarantine: every other row, with the names of the missing fields."""
    reasons = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED]))
    return df.filter(~_complete()).withColumn("missing", reasons)


def _casts(df: DataFrame) -> dict[str, Column]:
    """The post columns under their declared types; a value that cannot be read is NULL."""
    types = dict(df.dtypes)
    return {
        f.name: ntz_to_utc(F.col(f.name)) if types[f.name] == "timestamp_ntz" else F.col(f.name).try_cast(f.dataType)
        for f in POST_SCHEMA.fields
        if f.name in types
    }


def _unreadable(df: DataFrame) -> Column | None:
    """Names of the columns whose value cannot be read; None if every column has its type already."""
    types = dict(df.dtypes)
    declared = {f.name: f.dataType.simpleString() for f in POST_SCHEMA.fields}
    checks = [
        F.when(F.col(name).isNotNull() & cast.isNull(), F.lit(name))
        for name, cast in _casts(df).items()
        if types[name] not in (declared[name], "timestamp_ntz")
    ]
    return F.array_compact(F.array(*checks)) if checks else None


def conform(df: DataFrame) -> DataFrame:
    """Rows under the declared post schema, column order included; a wall-clock timestamp is UTC.

    Rows with a value that cannot be read as its type are left out: see ``misfit_posts``.
    """
    names = _unreadable(df)
    fitting = df if names is None else df.filter(F.size(names) == 0)
    return fitting.select(*[cast.alias(name) for name, cast in _casts(df).items()])


def misfit_posts(df: DataFrame) -> DataFrame:
    """The rows ``conform`` leaves out as they came, with the names of the ``unreadable`` columns."""
    names = _unreadable(df)
    if names is None:
        return df.filter(F.lit(False)).withColumn("unreadable", F.array().cast("array<string>"))
    return df.withColumn("unreadable", names).filter(F.size("unreadable") > 0)

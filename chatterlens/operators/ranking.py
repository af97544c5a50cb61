"""Exact "first n" selection that no single task or the driver has to hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatterlens.session import scratch_dir

# Up to here Spark prunes ``row_number() <= n`` in every task before the shuffle.
GROUP_LIMIT = 1000
# Beyond, a key's rows are split by value until so many are left to be ranked.
RANKED_ROWS = 10_000
BUCKETS = 1024


def orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(orderable(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType, T.NullType))


def tie_columns(df: DataFrame, used: Sequence[str]) -> list[Column]:
    """All other columns that have an order, by name: rows that tie in them too are alike."""
    taken = {u.lower() for u in used}
    return [F.col(f"`{f.name}`") for f in sorted(df.schema, key=lambda f: f.name) if f.name.lower() not in taken and orderable(f.dataType)]


def first_n(
    df: DataFrame,
    n: int,
    by: str | None = None,
    order: str = "ingest_seq",
    then: Sequence[str] = (),
    buckets: int = BUCKETS,
    ranked_rows: int = RANKED_ROWS,
) -> DataFrame:
    """The first ``n`` rows of the table or of each ``by`` key, by ``order`` and, among equals, by ``then``.

    Rows that tie in these too go by a digest of their other columns and then by the columns themselves, so reruns
    agree whatever the partitioning. Rows without a value come first. A small ``n`` is a group limit or a top-k.
    For a large one each key's range of values is cut into equal widths; counts tell in which one the quota
    ends, and only that one is cut again, by the next column once all its values are equal. What is ranked at last
    is at most ``ranked_rows`` rows a key, or rows that are all alike and counted before they are shuffled.
    """
    rest = tie_columns(df, [c for c in (by, order, *then) if c])
    digest = F.xxhash64(*rest) if rest else F.lit(0).cast("bigint")
    if n > GROUP_LIMIT:
        return _first_n_by_splitting(df, n, by, [order, *then], digest, buckets, ranked_rows)
    whole = [F.col(c).asc_nulls_first() for c in (order, *then)] + [digest, *rest]
    if by is None:
        return df.orderBy(*whole).limit(n)
    window = Window.partitionBy(by).orderBy(*whole)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")


def _number(df: DataFrame, name: str) -> Column:
    """A column's values as whole or floating numbers in the same order."""
    kind, x = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return x.cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(x).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(x)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return x.cast("double")
    raise ValueError(f"quotas beyond {GROUP_LIMIT} need numbers or times to go by; {name} is {kind.simpleString()}")


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bucket(x: Column, low: Column, high: Column, whole: bool, buckets: int) -> Column:
    """Number of the width that holds x; never falls as x grows. Missing values are first, NaN is last."""
    if whole:
        exact = "decimal(20,0)"
        share = F.try_divide((x.cast(exact) - low.cast(exact)).cast("double"), (high.cast(exact) - low.cast(exact)).cast("double"))
    else:
        share = F.try_divide(x / 2 - low / 2, high / 2 - low / 2)
    inside = F.least(F.lit(buckets - 1), F.floor(share * buckets)).cast("int") + 2
    if whole:
        return F.when(x.isNull(), 0).otherwise(inside)
    infinity = F.lit(float("inf"))
    return F.when(x.isNull(), 0).when(F.isnan(x), buckets + 3).when(x == infinity, buckets + 2).when(x == -infinity, 1).otherwise(inside)


def _first_n_by_splitting(
    df: DataFrame, n: int, by: str | None, order: Sequence[str], digest: Column, buckets: int, ranked_rows: int
) -> DataFrame:
    key = F.col(f"`{by}`") if by else F.lit(0)
    place = F.struct(*[_number(df, c).alias(f"l{i}") for i, c in enumerate(order)], digest.alias(f"l{len(order)}"))
    keyed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), key.alias("key"), place.alias("place"))
    cuts = _cuts(keyed.select("key", "place.*"), n, buckets, ranked_rows)

    cut = cuts.select(F.col("key").alias("of"), F.struct(*[f"l{i}" for i in range(len(order) + 1)]).alias("last"), "take", "alike")
    matched = keyed.join(cut, F.col("key").eqNullSafe(F.col("of")), "left")
    before, at = F.col("place") < F.col("last"), F.col("place") == F.col("last")
    kept = matched.filter(F.col("take").isNull() | before | (at & (F.col("take") == F.col("alike")))).select("row.*")
    if cuts.filter(F.col("take") < F.col("alike")).isEmpty():
        return kept
    # The quota ends among rows that tie in everything that was compared: alike, but for columns without an order.
    names = [f"c{i}" for i in range(len(df.columns))]
    tied = matched.filter(at & (F.col("take") < F.col("alike"))).select("key", "take", *[F.col("row").getField(c).alias(x) for c, x in zip(df.columns, names)])
    ordered = [x for x, f in zip(names, df.schema) if orderable(f.dataType)]
    counted = tied.groupBy("key", "take", *ordered).agg(F.count(F.lit(1)).alias("n"), *[F.first(x).alias(x) for x in names if x not in ordered])
    upto = Window.partitionBy("key").orderBy(*ordered).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = F.least(F.col("n"), F.col("take") - F.sum("n").over(upto) + F.col("n"))
    some = counted.withColumn("left", left).filter(F.col("left") > 0)
    blocks = some.select("*", F.expr("explode(sequence(0, (left - 1) div 4096))").alias("block"))
    again = blocks.select("*", F.expr("explode(sequence(block * 4096, least(left, (block + 1) * 4096) - 1))").alias("copy"))
    return kept.unionByName(again.select(*[F.col(x).alias(c) for c, x in zip(df.columns, names)]))


def _cuts(places: DataFrame, n: int, buckets: int, ranked_rows: int) -> DataFrame:
    """For keys with more than n rows: the place of row n, how many rows have it (``alike``) and how many of those
    are still in (``take``). One row a key; the driver sees one number a round."""
    levels = [f for f in places.schema if f.name != "key"]
    whole = [isinstance(f.dataType, T.LongType) for f in levels]
    open_, cuts, over = _stored(places.withColumn("room", F.lit(n).cast("bigint")), "quota"), None, F.col("n_rows") > F.col("to_go")
    while True:
        facts = [F.count(F.lit(1)).alias("n_rows"), F.first("room").alias("to_go")]
        for i, f in enumerate(levels):
            x = F.col(f.name)
            finite = x if whole[i] else F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)
            same = F.min(x).eqNullSafe(F.max(x)) & ((F.count(x) == 0) | (F.count(x) == F.count(F.lit(1))))
            facts += [F.min(finite).alias(f"low{i}"), F.max(finite).alias(f"high{i}"), same.alias(f"same{i}")]
        level = F.lit(len(levels))
        for i in reversed(range(len(levels))):
            level = F.when(~F.col(f"same{i}"), i).otherwise(level)
        told = open_.groupBy(F.col("key").alias("of")).agg(*facts).withColumn("level", level).filter(over)
        told = _stored(told.withColumn("split", (F.col("n_rows") > ranked_rows) & (F.col("level") < len(levels))), "quota")
        rows = open_.drop("room").join(told, F.col("key").eqNullSafe(F.col("of"))).drop("of")

        # Few rows, or rows that are all alike: counted by place, then the place at which the quota ends.
        names = [f.name for f in levels]
        counted = rows.filter(~F.col("split")).groupBy("key", "to_go", *names).agg(F.count(F.lit(1)).alias("alike"))
        upto = Window.partitionBy("key").orderBy(*names).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ends = counted.withColumn("take", F.col("to_go") - F.sum("alike").over(upto) + F.col("alike"))
        found = ends.filter((F.col("take") > 0) & (F.col("take") <= F.col("alike"))).select("key", *names, "take", "alike")
        cuts = found if cuts is None else cuts.unionByName(found)
        if told.filter("split").isEmpty():
            return _stored(cuts, "quota")

        bucket = F.lit(None).cast("int")
        for i, f in enumerate(levels):
            bucket = F.when(F.col("level") == i, _bucket(F.col(f.name), F.col(f"low{i}"), F.col(f"high{i}"), whole[i], buckets)).otherwise(bucket)
        placed = rows.filter("split").withColumn("bucket", bucket)
        sums = placed.groupBy("key", "to_go", "bucket").agg(F.count(F.lit(1)).alias("n"))
        upto = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ends = sums.withColumn("room", F.col("to_go") - F.sum("n").over(upto) + F.col("n")).filter((F.col("room") > 0) & (F.col("room") <= F.col("n")))
        ending = ends.select(F.col("key").alias("of"), F.col("bucket").alias("in"), "room")
        same = F.col("key").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("in"))
        # A quota may end with a bucket: then it ends with the bucket's last row, which is still looked for.
        over = F.lit(True)
        open_ = _stored(placed.join(ending, same).select("key", *names, F.col("room")), "quota")

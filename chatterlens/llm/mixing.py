"""Mixing sources to target weights with a low-discrepancy schedule.

The mix is a sequence of slots of equally many words. Slot k is given to the source whose interval of the
cumulative target weights holds the k-th golden-ratio point, so that every stretch of the mix is close to the
weights. The j-th slot of a source takes the j-th block of its shuffled, endlessly repeated documents. A source's
line of documents ends at its target, to the word; sources that the slots leave short of it get the slots they
lack at the end of the mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatterlens.llm._rows import packed, unpacked
from chatterlens.llm._tables import WORD

GOLDEN = 0.6180339887498949
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
CELLS = 4096
SLOTS_PER_CHUNK = 4096
#: Words of a slot, whatever the size of the mix.
BLOCK = 32
BUCKET_BITS = 14


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words, and an order key seeded by nothing but the row itself."""
    return docs.select(
        "doc_id",
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(20240131), "doc_id", "text").alias("h"),
    )


def targets(sizes: DataFrame, weights=WEIGHTS, cap: int = MOST_REPEATS) -> DataFrame:
    """source, source_size, target, lo, hi: targets in words, and the source's interval of the unit line.

    Sources in code point order, null last, take the weights in turn and share all words. A target stops at
    `cap` times the source's size; sorting by cap over weight turns the repeated resharing into prefix sums.
    One row per source.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    listed = by_source.withColumn("rank", F.row_number().over(turn)).withColumn(
        "w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") - 1) % len(weights) + 1)
    )
    before = Window.orderBy(F.col("most") / F.col("w"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = (
        listed.withColumn("most", (F.col("source_size") * cap).cast("double"))
        .withColumn("left", F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        .withColumn("left_w", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.col("left_w"))
        .withColumn("capped", F.col("most") < F.col("level") * F.col("w"))
        .withColumn("line", F.max(F.when(~F.col("capped"), F.col("level"))).over(whole))
        .withColumn("target", F.when(F.col("capped"), F.col("most")).otherwise(F.col("line") * F.col("w")))
    )
    upto = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("target").over(whole)
    return level.withColumn("hi", F.when(total > 0, F.sum("target").over(upto) / total).otherwise(F.lit(0.0))).select(
        "source",
        "source_size",
        "target",
        F.coalesce(F.lag("hi").over(Window.orderBy("rank")), F.lit(0.0)).alias("lo"),
        "hi",
    )


def words_due() -> Column:
    """The target in whole words."""
    return F.round("target").cast("long")


def schedule(spark, source_targets: DataFrame, n_slots: int, block: int) -> DataFrame:
    """slot, source, block: the source of every slot and how many slots it had before.

    Slots from `n_slots` on are those that a source still lacks for its target, source after source.

    Points and intervals meet in cells of the unit line, a plain equi-join. Ranks are counts of whole chunks
    of slots plus the rank within the chunk, so that no source's slots meet in one task.
    """
    points = spark.range(n_slots).select(
        F.col("id").alias("slot"), F.expr(f"pmod((id + 0.5D) * {GOLDEN}D, 1D)").alias("x")
    ).withColumn("cell", F.floor(F.col("x") * CELLS).cast("int"))
    spans = source_targets.where("hi > lo").select(
        "source", "lo", "hi",
        F.explode(F.sequence(F.floor(F.col("lo") * CELLS).cast("int"), F.least(F.floor(F.col("hi") * CELLS).cast("int"), F.lit(CELLS - 1)))).alias("cell"),
    )
    last = F.col("hi") >= 1 - 1e-12
    owned = points.join(spans, "cell").where((F.col("x") >= F.col("lo")) & ((F.col("x") < F.col("hi")) | last))
    owned = owned.select("slot", "source", F.expr(f"slot div {SLOTS_PER_CHUNK}").alias("chunk"))
    ahead = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = owned.groupBy("source", "chunk").count().select(
        F.col("source").alias("chunk_source"), F.col("chunk").alias("chunk_no"), F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("ahead")
    )
    given = owned.groupBy("source").count().select(F.col("source").alias("given_source"), F.col("count").alias("given"))
    upto = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    lacking = (
        source_targets.join(given, F.col("source").eqNullSafe(F.col("given_source")), "left")
        .withColumn("given", F.coalesce("given", F.lit(0)))
        .withColumn("lacks", F.ceil(words_due() / block) - F.col("given"))
        .where("lacks > 0")
        .withColumn("first", F.lit(n_slots) + F.sum("lacks").over(upto) - F.col("lacks"))
        .select("source", "given", "first", F.explode(F.expr("sequence(0L, lacks - 1)")).alias("i"))
        .select((F.col("first") + F.col("i")).alias("slot"), "source", (F.col("given") + F.col("i")).alias("block"))
    )
    inside = Window.partitionBy("source", "chunk").orderBy("slot")
    return (
        owned.withColumn("rank", F.row_number().over(inside) - 1)
        .join(chunks, F.col("source").eqNullSafe(F.col("chunk_source")) & (F.col("chunk") == F.col("chunk_no")))
        .select("slot", "source", (F.col("rank") + F.col("ahead")).alias("block"))
        .unionByName(lacking)
    )


def laid_out(sizes: DataFrame) -> DataFrame:
    """Adds `start`: where a document begins in its source's shuffled order, in words."""
    rows = sizes.withColumn("bucket", F.shiftright("h", 64 - BUCKET_BITS))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")).select(
        F.col("source").alias("bucket_source"), F.col("bucket").alias("bucket_no"), F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("ahead")
    )
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(sums, F.col("source").eqNullSafe(F.col("bucket_source")) & (F.col("bucket") == F.col("bucket_no")))
        .select("doc_id", "source", "size", "h", (F.col("within") + F.col("ahead")).alias("start"))
    )


def pieces(placed: DataFrame, slots: DataFrame, block: int, cap: int = MOST_REPEATS) -> DataFrame:
    """slot, doc_id, source, start, from_word, n_words: what each slot takes of which document.

    `placed` has doc_id, source, size, source_size, target and start. Repeat e of a document begins at
    e * source_size + start; blocks are cut from that line, which ends at the target and after `cap` repeats.
    """
    runs = placed.where("size > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(cap - 1))))
    runs = runs.withColumn("begin", F.col("epoch") * F.col("source_size") + F.col("start"))
    runs = runs.withColumn("end", F.least(F.col("begin") + F.col("size"), words_due())).where("end > begin")
    parts = runs.withColumn("block", F.explode(F.expr(f"sequence(begin div {block}, (end - 1) div {block})")))
    at = F.greatest(F.col("begin"), F.col("block") * block)
    end = F.least(F.col("end"), (F.col("block") + 1) * block)
    taken = slots.select(F.col("slot"), F.col("source").alias("slot_source"), F.col("block").alias("slot_block"))
    return parts.join(
        taken, F.col("source").eqNullSafe(F.col("slot_source")) & (F.col("block") == F.col("slot_block"))
    ).select("slot", "doc_id", "source", "start", (at - F.col("begin")).alias("from_word"), (end - at).alias("n_words"))


def mixed(docs: DataFrame, weights=WEIGHTS, cap: int = MOST_REPEATS, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(documents, pieces): every document with size, source_size, target, start and taken; the mix itself.

    Null texts have no words and are never taken; null sources are one source, last in order. Rows equal in all
    columns are laid out one after the other and are interchangeable. Reruns agree: order comes from a hash of
    the row, points from the slot number. Empty tables give empty results.
    """
    sizes = sized(docs)
    total = sizes.agg(F.sum("size")).first()[0] or 0
    goals = targets(sizes, weights, cap)
    goal = goals.select(F.col("source").alias("goal_source"), "source_size", "target")
    placed = laid_out(sizes).join(goal, F.col("source").eqNullSafe(F.col("goal_source"))).drop("goal_source")
    cut = pieces(placed, schedule(docs.sparkSession, goals, -(-total // block), block), block, cap)
    # A start belongs to one document that has words.
    sums = cut.groupBy("source", "start").agg(F.sum("n_words").alias("n")).select(
        F.col("source").alias("sum_source"), F.col("start").alias("sum_start"), "n"
    )
    rows = placed.join(
        sums,
        F.col("source").eqNullSafe(F.col("sum_source")) & (F.col("start") == F.col("sum_start")) & (F.col("size") > 0),
        "left",
    ).select("doc_id", "source", "h", "size", "source_size", "target", "start", F.coalesce("n", F.lit(0)).alias("taken"))
    return rows, cut


def repeated(docs: DataFrame) -> DataFrame:
    """`docs` as whole documents in the mix: each as often as the words taken of it make up its size, rounded.

    Documents without words are not part of the mix. Rows with one id and text share the average of their counts.
    Columns may have any names; an empty table gives an empty result.
    """
    rows, _ = mixed(docs)
    times = rows.groupBy("doc_id", "h").agg((F.sum("taken") / F.greatest(F.sum("size"), F.lit(1))).alias("share")).select(
        F.col("doc_id").alias("times_id"), F.col("h").alias("times_h"), F.round("share").cast("int").alias("times")
    )
    whole = docs.select(packed(docs).alias("row"), "doc_id", F.xxhash64(F.lit(20240131), "doc_id", "text").alias("h"))
    matched = whole.join(times, F.col("h").eqNullSafe(F.col("times_h")) & F.col("doc_id").eqNullSafe(F.col("times_id")))
    copies = matched.where("times > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"))
    return copies.select(*unpacked(docs, "row"))

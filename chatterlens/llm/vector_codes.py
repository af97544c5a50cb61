"""Vector codes: every quarter of a vector is named by the nearest entry of a codebook of 256.

Components are integers, floor(1024 * x), so that sums and distances are exact and reruns agree. The parts are
made distinct and counted once. Each round walks a lexicographic trie over them: a node holds the distances of
its prefix to all entries, accumulated from its parent's, so a prefix that many parts share is worked out once;
leaves take the nearest entry and add their part to its sum as often as it occurs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatterlens.llm._rows import column, with_results
from chatterlens.llm._tables import store

PARTS = 4
ENTRIES = 256
SCALE = 1024
ROUNDS = 4
#: Leaves whose distances are held at a time.
BLOCK = 1024


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is there and has only finite components."""
    x = column(vector)
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    return vectors.where(x.isNotNull() & ~odd)


def integers(vector: str = "embedding") -> Column:
    return F.transform(column(vector), lambda v: F.floor(v.cast("double") * SCALE))


def checked_width(rows: DataFrame, vector: str) -> tuple[int, type]:
    """Components of a part, and the number type in which all distances are exact."""
    v = integers(vector)
    low, high, least, most = rows.agg(
        F.min(F.size(column(vector))), F.max(F.size(column(vector))), F.min(F.array_min(v)), F.max(F.array_max(v))
    ).first()
    if low != high or (low or 0) % PARTS:
        raise ValueError(f"vectors must have one length, divisible by {PARTS}; found {low} to {high}")
    width, reach = (low or 0) // PARTS, max(abs(least or 0), abs(most or 0))
    bound = 4 * width * (reach + 1) ** 2
    if reach >= 1 << 31 or bound >= 1 << 63:
        raise ValueError(f"components up to {reach / SCALE:g} are too large for exact distances")
    return width, np.float64 if bound < 1 << 53 else np.int64


def nearest(parts: np.ndarray, entries: np.ndarray, number: type) -> tuple[np.ndarray, np.ndarray]:
    """(entry, distance) of every row of `parts`, whose equal prefixes lie together.

    The trie is walked depth first in runs of sibling nodes: (first leaves, end, depth, distances of the parent).
    Runs of at most BLOCK leaves are finished together, so memory is a block and one vector a level.
    """
    n, width = parts.shape
    parts, entries = parts.astype(number), entries.astype(number)
    entry, distance = np.zeros(n, np.int64), np.zeros(n, np.int64)
    stack = [(np.zeros(1, np.int64), n, 0, np.zeros(len(entries), number))] if n else []
    while stack:
        heads, end, depth, above = stack.pop()
        reached = np.broadcast_to(above, (len(heads), len(entries)))
        if depth:
            reached = reached + (parts[heads, depth - 1][:, None] - entries[:, depth - 1]) ** 2
        first = heads[0]
        if end - first <= BLOCK or depth == width:
            leaves = finished(parts[first:end], entries, heads - first, depth, reached)
            entry[first:end] = best = leaves.argmin(axis=1)
            distance[first:end] = np.take_along_axis(leaves, best[:, None], 1)[:, 0]
            continue
        for at in reversed(range(len(heads))):
            stop = heads[at + 1] if at + 1 < len(heads) else end
            column_ = parts[heads[at] : stop, depth]
            below = heads[at] + np.concatenate([[0], np.flatnonzero(column_[1:] != column_[:-1]) + 1])
            for lo, hi in reversed(runs(np.append(below, stop))):
                stack.append((below[lo:hi], below[hi] if hi < len(below) else stop, depth + 1, reached[at]))
    return entry, distance


def runs(bounds: np.ndarray) -> list[tuple[int, int]]:
    """Neighbouring nodes taken together up to BLOCK leaves; a larger node is alone."""
    out, lo, nodes = [], 0, len(bounds) - 1
    while lo < nodes:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + BLOCK, "right")) - 1)
        out.append((lo, min(hi, nodes)))
        lo = out[-1][1]
    return out


def finished(parts: np.ndarray, entries: np.ndarray, heads: np.ndarray, depth: int, reached: np.ndarray) -> np.ndarray:
    """Distances of all leaves: level by level while nodes are shared, then the rest of each leaf at once."""
    n, width = parts.shape
    while depth < width and len(heads) < n:
        new = np.zeros(n, bool)
        new[heads] = True
        parent = np.cumsum(new) - 1
        new[1:] |= parts[1:, depth] != parts[:-1, depth]
        heads = np.flatnonzero(new)
        reached = reached[parent[heads]] + (parts[heads, depth][:, None] - entries[:, depth]) ** 2
        depth += 1
    if depth < width:
        x, e = parts[:, depth:], entries[:, depth:]
        reached = reached + ((x * x).sum(1)[:, None] - 2 * (x @ e.T) + (e * e).sum(1))
    return reached if len(heads) == n else np.repeat(reached, np.diff(np.append(heads, n)), axis=0)


def distinct_parts(rows: DataFrame, width: int, vector: str) -> DataFrame:
    """position, part, n: counted before they are shuffled, then ranges of the lexicographic order."""
    v = integers(vector).cast("array<int>")
    cut = F.array(*[F.slice(v, p * width + 1, width) for p in range(PARTS)])
    counted = rows.select(F.posexplode(cut).alias("position", "part")).groupBy("position", "part").agg(F.count("*").alias("n"))
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return counted.repartitionByRange(ranges, "position", "part").sortWithinPartitions("position", "part")


def first_entries(rows: DataFrame, width: int, vector: str, vec_id: str) -> np.ndarray:
    """Parts of the rows of the 256 least ids: (position, entry, component). Rows of one id follow their
    components' order; null ids come after all others."""
    first = rows.select(column(vec_id).alias("id"), integers(vector).alias("v")).orderBy(F.col("id").asc_nulls_last(), "v").limit(ENTRIES)
    found = [r.v for r in first.collect()]
    return np.array(found, np.int64).reshape(len(found), PARTS, width).transpose(1, 0, 2)


def refine(parts: DataFrame, books: np.ndarray, number: type) -> np.ndarray:
    """One round: each entry becomes the floor of the mean of the parts nearest to it; unused entries stay."""
    width = books.shape[2]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            position, n = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            part = batch.column(1).flatten().to_numpy().reshape(-1, width)
            for p in range(PARTS):
                here = np.flatnonzero(position == p)
                entry, _ = nearest(part[here], books[p], number)
                np.add.at(total[p], entry, part[here].astype(np.int64) * n[here, None])
                np.add.at(count[p], entry, n[here])
        p, e = np.nonzero(count)
        place = [np.repeat(p, width), np.repeat(e, width), np.tile(np.arange(width), len(p))]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(x, pa.int32()) for x in place), pa.array(np.repeat(count[p, e], width)), pa.array(total[p, e].ravel())],
            names=["position", "entry", "at", "n", "total"],
        )

    found = parts.mapInArrow(sums, "position int, entry int, at int, n long, total long")
    # At most one row a codebook component: 256 times the length of a vector.
    table = found.groupBy("position", "entry", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).toArrow()
    position, entry, at, n, total = (table.column(c).to_numpy() for c in table.column_names)
    out = books.copy()
    out[position, entry, at] = total // n  # floors towards minus infinity
    return out


def learn(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (position, entry, component) of the usable rows. With fewer than 256 rows there are as many
    entries; without any there are none. Vectors of other lengths, lengths that four does not divide and
    components whose distances exceed 63 bits are refused with a ValueError."""
    rows = usable(vectors, vector)
    width, number = checked_width(rows, vector)
    books = first_entries(rows, width, vector, vec_id)
    if books.size:
        parts = store(distinct_parts(rows, width, vector), "parts")
        for _ in range(rounds):
            books = refine(parts, books, number)
    return books


def digest(books: np.ndarray) -> str:
    """sha256 of all components in decimal by position, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(vectors: DataFrame, books: np.ndarray, vector: str = "embedding") -> DataFrame:
    """Usable rows with `entries` (an index a part, ties to the lower) and `error` (squared distances, summed).

    Equal rows get equal codes; rows are coded one by one, by tries over the distinct parts of an Arrow batch. An
    empty table gives an empty result; columns of the input named `entries` or `error` give way.
    """
    rows = usable(vectors, vector)
    width, number = checked_width(rows, vector)
    results = T.StructType([T.StructField("entries", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType())])

    def code(given: pa.Array) -> pa.Array:
        v = given.flatten().to_numpy().reshape(len(given), PARTS, width)
        entries, error = np.zeros((len(v), PARTS), np.int32), np.zeros(len(v), np.int64)
        for p in range(PARTS):
            part = v[:, p]
            order = np.lexsort(part.T[::-1]) if width else np.arange(len(v))
            new = np.ones(len(v), bool)
            new[1:] = (part[order[1:]] != part[order[:-1]]).any(axis=1)
            entry, distance = nearest(part[order[new]], books[p], number)
            which = np.cumsum(new) - 1
            entries[order, p] = entry[which]
            error[order] += distance[which]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, entries.size + 1, PARTS), pa.int32()), pa.array(entries.ravel()))
        return pa.StructArray.from_arrays([lists, pa.array(error)], names=["entries", "error"])

    return with_results(rows, integers(vector).cast("array<int>"), results, code)


def error_by(coded: DataFrame, label: str = "label") -> DataFrame:
    """`coded` with `label_error`: the errors summed over rows of equal label, nulls together. Sums are made
    before they are shuffled; one row a label joins back."""
    sums = coded.groupBy(column(label).alias("_label")).agg(F.sum("error").alias("_sum"))
    return (
        coded.select(F.struct(*[column(c) for c in coded.columns if c != "label_error"]).alias("_row"), column(label).alias("_key"))
        .join(sums, F.col("_key").eqNullSafe(F.col("_label")))
        .select("_row.*", F.col("_sum").alias("label_error"))
    )

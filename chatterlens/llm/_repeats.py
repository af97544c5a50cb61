"""Windows of fixed length that also start earlier, found without comparing documents in pairs.

A text is a line of units (bytes or words). Every window of `width` units is represented by its anchor, the
least numbered gram of `gram` units inside it (the leftmost of equals), so that equal windows have equal
anchors at equal offsets. Consecutive windows with one anchor form a run.

1. Runs are bucketed by their anchor's gram. A bucket with one run holds no repeat and is dropped. Runs of a
   bucket with equal surroundings (all of their windows equal) repeat the first of them.
2. In buckets that still hold runs with other surroundings the fingerprints of all windows, made of the gram
   identifiers that cover them, are compared at each offset from the anchor.

Order is (rid, start). Copies are merged in the task that reads them, before anything is shuffled, so a passage
that a third of the documents share is shuffled once per Arrow batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterlens.llm._hash import FACTOR, MIX, signed
from chatterlens.llm._tables import store

#: Units that are worked on together; longer texts are cut into overlapping pieces.
LINE = 1 << 19
PLACE = np.uint64((1 << 24) - 1)
#: Runs with different surroundings from which a bucket is refined window by window over all tasks.
WIDE_BUCKET = 20_000
ID_BYTES = 6
REPEAT, OPEN, WIDE = 0, 1, 2


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Identifier of two identifiers in order."""
    x = a * FACTOR + b
    x = (x ^ (x >> np.uint64(32))) * MIX
    return x ^ (x >> np.uint64(29))


def gram_ids(line: np.ndarray, gram: int) -> np.ndarray:
    """Identifiers of all runs of `gram` (a power of two) units: each doubling joins two of the last."""
    ids, size = line, 1
    while size < gram:
        ids = pair(ids[:-size], ids[size:])
        size *= 2
    return ids


def window_ids(ids: np.ndarray, starts: np.ndarray, width: int, gram: int) -> np.ndarray:
    """Identifiers of windows from the gram identifiers at later offsets that cover them."""
    out = ids[starts]
    for at in [*range(gram, width - gram, gram), width - gram]:
        out = pair(out, ids[starts + at])
    return out


def lines(texts: list[bytes], units: Callable[[bytes], np.ndarray], width: int):
    """Pieces of texts laid out on lines: for each line its units and, per piece, text, offset and begin."""
    parts, total = [], 0

    def laid_out():
        begins = np.concatenate([[0], np.cumsum([len(p[2]) for p in parts])[:-1]])
        return np.concatenate([p[2] for p in parts]), np.array([p[0] for p in parts]), np.array([p[1] for p in parts]) - begins, begins

    for i, text in enumerate(texts):
        numbers = units(text)
        for at in range(0, len(numbers) - width + 1, LINE):
            piece = numbers[at : at + LINE + width - 1]
            if parts and total + len(piece) > LINE:
                yield laid_out()
                parts, total = [], 0
            parts.append((i, at, piece))
            total += len(piece)
    if parts:
        yield laid_out()


def runs_of(line: np.ndarray, begins: np.ndarray, width: int, gram: int):
    """gram ids, and per run: anchor, first and last window start, piece."""
    ids = gram_ids(line, gram)
    least, size, wide = (ids & ~PLACE) | np.arange(len(ids), dtype=np.uint64), 1, width - gram + 1
    while size * 2 <= wide:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < wide:
        least = np.minimum(least[: len(ids) - wide + 1], least[wide - size :])
    anchor = (least & PLACE).astype(np.int64)
    inside = np.ones(len(anchor), bool)
    for b in begins[1:]:
        inside[max(0, b - width + 1) : b] = False
    starts = np.flatnonzero(inside)
    anchor = anchor[starts]
    piece = np.searchsorted(begins, starts, "right") - 1
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return ids, anchor[first], starts[first], starts[last], piece[first]


def firsts(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by keys, whether each row in that order is the first with its values of all but the last two)."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys[:-2]], axis=0)
    return order, new


def batch_of(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)


def packed(docs: DataFrame) -> DataFrame:
    """rid and the compressed text."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([press(t) for t in batch.column(2).to_pylist()], pa.binary())], names=["doc_id", "rid", "z"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "rid", "text").mapInArrow(pack, f"doc_id {kind}, rid long, z binary")


def sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the rows of one value of column 0, which is sorted, stay together."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        cut = int(np.searchsorted(key, key[-1], "left"))
        if cut:
            yield pa.concat_batches([*kept, batch.slice(0, cut)])
            kept = [batch.slice(cut)]
        elif kept and kept[-1].column(0)[-1].as_py() != key[0]:
            yield pa.concat_batches(kept)
            kept = [batch]
        else:
            kept.append(batch)
    if kept:
        yield pa.concat_batches(kept)


def bucketed(docs: DataFrame, units: Callable[[bytes], np.ndarray], width: int, gram: int) -> DataFrame:
    """kind, rid, lo, span, off, h: runs that repeat an earlier one, and runs of buckets to be refined.

    lo is the first window start, span the number of further windows, off the anchor's place after lo.
    """
    names = ["h", "around", "rid", "at"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids = batch.column(0).to_numpy()
            found = []
            for line, text, offset, begins in lines(batch.column(1).to_pylist(), units, width):
                ids, anchor, lo, hi, piece = runs_of(line, begins, width, gram)
                around = pair(window_ids(ids, lo, width, gram), window_ids(ids, hi, width, gram))
                # 40 bits of the surroundings beside the 64 of the bucket, then the run's extent.
                around = (around >> np.uint64(24) << np.uint64(16)) | ((hi - lo) << 8 | (anchor - lo)).astype(np.uint64)
                found.append((signed(ids[anchor]), signed(around), rids[text[piece]], lo + offset[piece]))
            if not found:
                continue
            h, around, rid, lo = (np.concatenate(c) for c in zip(*found))
            order, new = firsts(h, around, rid, lo)
            h, around, rid, lo = (c[order] for c in (h, around, rid, lo))
            # Rows equal in id and text have one rid: the same window of the same text is not a repeat.
            known = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            keep = new | (rid != rid[known]) | (lo != lo[known])
            spread = np.where(new, h, signed(pair(rid.astype(np.uint64), lo.astype(np.uint64))))
            yield batch_of(names, *(c[keep] for c in (spread, around, rid, lo << 1 | ~new)))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sorted_groups(batches):
            h, around, rid, at = (batch.column(i).to_numpy() for i in range(4))
            lo, done = at >> 1, (at & 1).astype(bool)
            kinds = np.full(len(h), REPEAT)
            at = np.flatnonzero(~done)
            order, new = firsts(h[at], around[at], rid[at], lo[at])
            at = at[order]
            known = at[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))] if len(at) else at
            again = ~new & ((rid[at] != rid[known]) | (lo[at] != lo[known]))
            # Rows of a bucket lie together; count its different surroundings.
            bucket = np.cumsum(np.concatenate([[True], h[at][1:] != h[at][:-1]])) - 1 if len(at) else at
            several = np.bincount(bucket, weights=new)[bucket] if len(at) else at
            kinds[at] = np.where(new, np.where(several > WIDE_BUCKET, WIDE, OPEN), REPEAT)
            use = done.copy()
            use[at] = again | (new & (several > 1))
            span, off = (around >> 8) & 255, around & 255
            yield batch_of(
                ["kind", "rid", "lo", "span", "off", "h"],
                *(c[use] for c in (kinds.astype(np.int32), rid, lo, span.astype(np.int16), off.astype(np.int16), h)),
            )

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = docs.select("rid", "text").mapInArrow(read, "h long, around long, rid long, at long")
    return runs.repartition(n, "h").sortWithinPartitions("h").mapInArrow(judge, "kind int, rid long, lo long, span short, off short, h long")


def refined(docs: DataFrame, runs: DataFrame, units: Callable[[bytes], np.ndarray], width: int, gram: int) -> DataFrame:
    """rid, lo, span: windows of open runs whose identifier occurs earlier at the same offset in their bucket."""
    asked = runs.where(F.col("kind") != REPEAT).groupBy("rid").agg(F.collect_list(F.struct("h", "lo", "span", "off", "kind")).alias("runs"))
    rows = packed(docs).drop("doc_id").join(asked.hint("merge"), "rid").select("rid", "z", "runs")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, before = zstandard.ZstdDecompressor().decompress, None
        for batch in batches:
            lists = batch.column(2)
            for i, (rid, z) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if rid == before:  # a copy in id and text; those of other tasks meet in compare
                    continue
                before = rid
                h, lo, span, off, kind = (lists[i].values.field(k).to_numpy() for k in range(5))
                ids, windows = gram_ids(units(open_(z)), gram), span.astype(np.int64) + 1
                step = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
                starts = np.repeat(lo, windows) + step
                found = window_ids(ids, starts, width, gram)
                data = np.ascontiguousarray(found.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :ID_BYTES]
                # A wide bucket is dealt out by window, any other as a whole.
                wide = np.repeat(kind == WIDE, windows)
                place = np.repeat(off.astype(np.int64), windows) - step
                narrow = np.flatnonzero(kind != WIDE)
                ends = np.cumsum(windows)
                key = np.concatenate([h[narrow], signed(pair(pair(np.repeat(h, windows)[wide].view(np.uint64), place[wide].astype(np.uint64)), found[wide]))])
                blobs = [data[ends[j] - windows[j] : ends[j]].tobytes() for j in narrow] + [d.tobytes() for d in data[wide]]
                yield batch_of(
                    ["key", "rid", "lo", "off", "ids"], key, np.full(len(key), rid), np.concatenate([lo[narrow], starts[wide]]),
                    np.concatenate([off[narrow], place[wide]]).astype(np.int16), pa.array(blobs, pa.binary()),
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen, row = None, np.zeros((0, 2), np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            # Rows equal in id and text have one rid: the same windows of the same text are read once.
            fresh = np.any([np.diff(c, prepend=c[:1]) != 0 for c in (batch.column(i).to_numpy() for i in range(3))], axis=0)
            ends = [tuple(batch.column(i)[j].as_py() for i in range(3)) for j in (0, batch.num_rows - 1)]
            fresh[0], row = ends[0] != row, ends[1]
            batch = batch.filter(pa.array(fresh))
            if not batch.num_rows:
                continue
            key, rid, lo, off = (batch.column(i).to_numpy() for i in range(4))
            blobs = batch.column(4).to_pylist()
            windows = np.array([len(b) for b in blobs]) // ID_BYTES
            raw = np.zeros((windows.sum(), 8), np.uint8)
            raw[:, :ID_BYTES] = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, ID_BYTES)
            name = raw.view("<u8").ravel().view(np.int64)
            step = np.arange(len(name)) - np.repeat(np.cumsum(windows) - windows, windows)
            owner, place = np.repeat(np.arange(len(key)), windows), np.repeat(off.astype(np.int64), windows) - step
            keys, starts, rids = key[owner], lo[owner] + step, rid[owner]
            m = len(seen) if last == key[0] else 0  # what earlier batches of the key had comes first
            keys = np.concatenate([np.full(m, key[0]), keys])
            place, name = np.concatenate([seen[:m, 0], place]), np.concatenate([seen[:m, 1], name])
            order, new = firsts(keys, place, name, np.zeros(len(keys)), np.arange(len(keys)))
            repeat = np.zeros(len(keys), bool)
            repeat[order] = ~new
            of_last = keys == key[-1]
            seen = np.unique(np.stack([place[of_last], name[of_last]], axis=1), axis=0)
            last = key[-1]
            repeat = repeat[m:]
            yield batch_of(["rid", "lo", "span"], rids[repeat], starts[repeat], np.zeros(repeat.sum(), np.int16))

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = rows.mapInArrow(name, "key long, rid long, lo long, off short, ids binary")
    return named.repartition(n, "key").sortWithinPartitions("key", "rid", "lo").mapInArrow(compare, "rid long, lo long, span short")


def covered(docs: DataFrame, units: Callable[[bytes], np.ndarray], width: int, gram: int) -> DataFrame:
    """doc_id, rid, z (compressed text), runs (lo, span): every window of the text that also starts earlier."""
    runs = store(bucketed(docs, units, width, gram), "runs")
    found = runs.where(F.col("kind") == REPEAT).select("rid", "lo", "span").unionByName(refined(docs, runs, units, width, gram))
    by = found.groupBy("rid").agg(F.collect_list(F.struct("lo", "span")).alias("runs"))
    return packed(docs).join(by.hint("merge"), "rid", "left").select("doc_id", "rid", "z", "runs")


def cover(n: int, runs: pa.Scalar, width: int) -> np.ndarray:
    """Mask of the units that the windows of `runs` cover."""
    edge = np.zeros(n + 1, np.int64)
    if runs.is_valid:
        lo, span = (runs.values.field(k).to_numpy().astype(np.int64) for k in range(2))
        np.add.at(edge, lo, 1)
        np.add.at(edge, np.minimum(lo + span + width, n), -1)
    return np.cumsum(edge[:-1]) > 0

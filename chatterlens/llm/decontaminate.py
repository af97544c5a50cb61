"""Benchmark decontamination with suffix arrays of the training text.

A few megabytes of documents are a shard. Its words become numbers (words that no benchmark item has are
breaks), its suffixes are sorted, and every test window is found by binary search: the range of equal suffixes
gives all verbatim matches with their places, and windows that follow each other in text and item are chained to
matches of any length. Shorter partial matches are the neighbours of a text suffix among the test suffixes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterlens.llm._rows import kept_names, packed, unpacked
from chatterlens.llm._tables import utf8

WINDOW = 13
#: Benchmark bytes in one block, the unit that is broadcast. Larger benchmarks are searched block after block.
BLOCK_BYTES = 32 << 20
#: Text of one shard; a longer document is a shard of its own.
SHARD_BYTES = 4 << 20
# Digits, lower-case ASCII letters and all bytes of characters beyond ASCII are kept; A-Z are lowered.
TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
SCAN = "n_words long, n_hit long, longest_match long, cover binary, items array<string>, " \
    "places array<struct<n:bigint,item:string,item_at:bigint,doc_at:bigint>>"


def words_of(data: bytes) -> list[bytes]:
    return data.translate(TABLE).split()


class TestSuffixes:
    """The windows of one benchmark block as rows of word numbers, zero after the end of a short item.

    `suffixes` has the first words of every suffix, also of those too short for a window, in order.
    """

    def __init__(self, items: list[tuple[str, bytes]], width: int = WINDOW):
        self.width, self.numbers = width, {}
        rows, lengths, owners, places, tails = [], [], [], [], []
        for k, (item_id, data) in enumerate(items):
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(data)]
            size = min(width, len(ids))
            for at in range(len(ids) - size + 1 if ids else 0):
                rows.append(ids[at : at + size] + [0] * (width - size))
                lengths.append(size)
                owners.append(item_id)
                places.append((k, at))
            tails += [ids[at:] + [0] * (width - len(ids) + at) for at in range(max(0, len(ids) - size + 1), len(ids))]
        self.rows = np.array(rows, dtype=np.int64).reshape(-1, width)
        self.lengths, self.owners = np.array(lengths, dtype=np.int64), owners
        # Of each window: number of its item, place in it.
        self.places = np.array(places, dtype=np.int64).reshape(-1, 2)
        depth = int(min([3, *lengths]))
        every = np.unique(np.concatenate([self.rows, np.array(tails, dtype=np.int64).reshape(-1, width)]), axis=0)
        self.suffixes, self.suffix_keys = every, as_keys(every)
        self.depth, self.heads = depth, np.unique(self.head(every[every[:, depth - 1] > 0][:, :depth]))
        self.pairs = np.unique(self.head(every[every[:, 1] > 0][:, :2])) if width > 1 else np.zeros(0, np.int64)
        self.low = as_keys(self.rows)
        top = self.rows.copy()
        top[np.arange(width)[None, :] >= self.lengths[:, None]] = 2**32 - 1
        self.high = as_keys(top)

    def head(self, columns: np.ndarray) -> np.ndarray:
        """One number for the first words. Vocabularies of a block stay below 2^21 words."""
        code = np.zeros(len(columns), dtype=np.int64)
        for column in columns.T:
            code = (code << 21) | column
        return code


def as_keys(rows: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that sort like the rows."""
    return np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * rows.shape[1]}").ravel()


def shards(texts: list[bytes]) -> Iterator[list[bytes]]:
    part, total = [], 0
    for t in texts:
        if part and total + len(t) > SHARD_BYTES:
            yield part
            part, total = [], 0
        part.append(t)
        total += len(t)
    if part:
        yield part


def search_shard(tests: TestSuffixes, texts: list[bytes]) -> list[tuple]:
    """Per text: words, longest match, hit mask, ids of the items that occur, and the longest possible matches of at
    least a window with length, item, and first word in item and text."""
    width, lookup = tests.width, tests.numbers.get
    ids, starts, sizes = [], [], []
    for data in texts:
        words = words_of(data)
        starts.append(len(ids))
        sizes.append(len(words))
        ids.extend([lookup(w, 0) for w in words])
        ids.append(0)
    line = np.array(ids + [0] * width, dtype=np.int64)
    starts, n = np.array(starts, dtype=np.int64), len(ids)
    hit, items = np.zeros(n + 1, dtype=np.int64), [set() for _ in texts]
    longest, places = np.zeros(len(texts), dtype=np.int64), [[] for _ in texts]
    if len(tests.rows) and n:
        head = tests.head(np.stack([line[i : n + i] for i in range(tests.depth)], axis=1))
        # Matches of less than a head: one word, two words.
        two = tests.head(np.stack([line[:n], line[1 : n + 1]], axis=1))
        for size, there in ((1, line[:n] > 0), (2, (line[:n] > 0) & np.isin(two, tests.pairs))):
            longest[np.searchsorted(starts, np.flatnonzero(there), "right") - 1] = size
        slot = np.minimum(np.searchsorted(tests.heads, head), len(tests.heads) - 1)
        at = np.flatnonzero((line[:n] > 0) & (tests.heads[slot] == head))
        rows = line[at[:, None] + np.arange(width)]
        keys = as_keys(rows)
        order = np.argsort(keys, kind="stable")
        at, keys, rows = at[order], keys[order], rows[order]
        if len(at):
            lo, hi = np.searchsorted(keys, tests.low, "left"), np.searchsorted(keys, tests.high, "right")
            next_ = np.searchsorted(tests.suffix_keys, keys, "left")
            for near in (np.minimum(next_, len(tests.suffixes) - 1), np.maximum(next_ - 1, 0)):
                same = np.cumprod((rows == tests.suffixes[near]) & (rows > 0), axis=1).sum(axis=1)
                np.maximum.at(longest, np.searchsorted(starts, at, "right") - 1, same)
            hits = []
            for q in np.flatnonzero(hi > lo):
                found = at[lo[q] : hi[q]]
                np.add.at(hit, found, 1)
                np.add.at(hit, found + tests.lengths[q], -1)
                owners = np.unique(np.searchsorted(starts, found, "right") - 1)
                hits.append((found, np.full(len(found), q)))
                for d in owners:
                    items[d].add(tests.owners[q])
            if hits:
                found, q = (np.concatenate(c) for c in zip(*hits))
                item, offset = tests.places[q].T
                # Windows of one item and one text that follow each other in both are one match.
                order = np.lexsort((found, found - offset, item))
                found, q, item, offset = (c[order] for c in (found, q, item, offset))
                new = np.ones(len(found), bool)
                new[1:] = (np.diff(found) != 1) | (np.diff(offset) != 1) | (np.diff(item) != 0)
                first = np.flatnonzero(new)
                sizes_ = np.diff(np.append(first, len(found))) - 1 + tests.lengths[q[first]]
                owners = np.searchsorted(starts, found[first], "right") - 1
                np.maximum.at(longest, owners, sizes_)
                for d, size, j in zip(owners, sizes_, first):
                    places[d].append((int(size), tests.owners[q[j]], int(offset[j]), int(found[j] - starts[d])))
    covered = np.cumsum(hit[:n]) > 0
    return [
        (size, int(most), covered[at : at + size], found, sorted(where, key=lambda x: (x[3], -x[0], x[1:])))
        for at, size, most, found, where in zip(starts, sizes, longest, items, places)
    ]


def benchmark_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """Blocks of at most about `block_bytes`, each fetched when it is needed. Items without words are left out."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), utf8().alias("data"))
    total = rows.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item", "data"), F.lit(n)) == k) if n > 1 else rows
        yield [(r.item, bytes(r.data)) for r in part.collect()]


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All columns of `docs` (but one named `match`) and a struct `match`: n_words, n_hit, longest_match (words), cover (bits of hit
    words), items (sorted ids), places (length in words, item, first word in item and text of each verbatim match of
    at least `width` words or a whole shorter item, as long as it goes) and contaminated (at least one and at least a
    twentieth of the words hit). longest_match also counts matches of fewer words than `width`.

    Null and empty texts have no words; an item without words matches nothing, and a null item id counts as
    empty text. Equal items both count, and so do repeated rows; an empty table gives an empty result. No shuffle.
    All blocks are searched in one pass, so a task holds one Arrow batch and every benchmark block.
    """
    rows = _matched(docs, ("match",), benchmark, width, block_bytes)
    return rows.select(*unpacked(docs, "d", "match"), "match")


def _matched(docs: DataFrame, results: tuple[str, ...], benchmark: DataFrame, width: int, block_bytes: int) -> DataFrame:
    """d, match."""
    spark = docs.sparkSession
    field = f"c{kept_names(docs, *results).index('text')}"
    rows = docs.select(packed(docs, *results).alias("d"), F.lit(None).cast(
        "struct<" + ", ".join(p.replace(" ", ":", 1) for p in SCAN.split(", ")) + ">").alias("m"))

    for block in benchmark_blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast(block)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            tests = TestSuffixes(shared.value, width)
            for batch in batches:
                out = []
                matches = (m for part in shards(batch.column(2).to_pylist()) for m in search_shard(tests, part))
                for earlier, (size, most, mask, found, where) in zip(batch.column(1).to_pylist(), matches):
                    if earlier:
                        mask = mask | np.unpackbits(np.frombuffer(earlier["cover"], np.uint8), count=size).astype(bool)
                        most, found = max(most, earlier["longest_match"]), found | set(earlier["items"])
                        where = sorted([*where, *(tuple(p.values()) for p in earlier["places"])], key=lambda x: (x[3], -x[0], x[1:]))
                    out.append({"n_words": size, "n_hit": int(mask.sum()), "longest_match": most,
                                "cover": np.packbits(mask).tobytes(), "items": sorted(found),
                                "places": [dict(zip(("n", "item", "item_at", "doc_at"), p)) for p in where]})
                kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("longest_match", pa.int64()),
                                  ("cover", pa.binary()), ("items", pa.list_(pa.string())),
                                  ("places", pa.list_(pa.struct([("n", pa.int64()), ("item", pa.string()), ("item_at", pa.int64()), ("doc_at", pa.int64())])))])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=["d", "m"])

        schema = rows.schema
        text = F.coalesce(F.col("d").getField(field), F.lit("")).cast("binary").alias("t")
        rows = rows.select("d", "m", text).mapInArrow(scan, schema)
    return rows.select(
        "d",
        F.struct("m.*", F.expr("m.n_hit > 0 and 20 * m.n_hit >= m.n_words").alias("contaminated")).alias("match"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The clean rows, with their own columns only, whatever they are called."""
    rows = _matched(docs, (), benchmark, WINDOW, BLOCK_BYTES).where("not match.contaminated")
    return rows.select(*unpacked(docs, "d"))

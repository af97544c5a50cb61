"""Removal of passages that also start earlier.

Windows of LENGTH words meet at winnowed anchors, the least of the SEED-word grams in each, and are told apart by
fingerprints (see `_repeats`, which `suffix_dedup` uses too); overlapping windows join to maximal repeats. No seed is
grown word by word. Equality is that of 64 + 48 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from chatterlens.llm._hash import word_numbers
from chatterlens.llm._repeats import cover, covered
from chatterlens.llm._tables import numbered

LENGTH, SEED = 20, 8


def units(text: bytes) -> np.ndarray:
    return word_numbers(text.split())


def remove_repeated_passages(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_removed, spans (first word and length of each maximal repeat) and kept (the other words,
    joined by one space) for every row of `docs` (doc_id, text).

    A word goes if a window of `length` words over it also starts earlier, in a document before it or further
    left in its own. Null and empty texts have no words. Rows equal in id and text are one document and have equal
    results; see `numbered` for missing and repeated ids. Empty tables give empty results.
    """
    rows = covered(numbered(docs), units, length, seed)
    kind = rows.schema["doc_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("first", pa.int64()), ("n", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for i, z in enumerate(batch.column(1).to_pylist()):
                words = open_(z).split()
                gone = cover(len(words), batch.column(2)[i], length)
                edge = np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))
                first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                kept = b" ".join(words[j] for j in np.flatnonzero(~gone))
                out.append((len(words), int(gone.sum()), [{"first": int(a), "n": int(b - a)} for a, b in zip(first, last)], kept.decode()))
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), span, pa.string()))]],
                names=["doc_id", "n_words", "n_removed", "spans", "kept"],
            )

    return rows.select("doc_id", "z", "runs").mapInArrow(
        cut, f"doc_id {kind}, n_words long, n_removed long, spans array<struct<first:bigint,n:bigint>>, kept string"
    )

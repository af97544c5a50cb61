"""Removal of byte strings that also start earlier.

Windows of LENGTH bytes meet at winnowed 16-gram anchors and are told apart by fingerprints (see `_repeats`, which
`seed_extend` uses too). This is not bucket-pointer refinement: identifiers are doubled inside one text only, and
nothing is sorted on bucket identifiers of later offsets. Equality is that of 64 + 48 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from chatterlens.llm._hash import mixed
from chatterlens.llm._repeats import cover, covered
from chatterlens.llm._tables import numbered

LENGTH, QGRAM = 100, 16
BYTES = mixed(np.arange(1, 257, dtype=np.uint64))


def units(text: bytes) -> np.ndarray:
    return BYTES[np.frombuffer(text, np.uint8)]


def remove_repeated_bytes(docs: DataFrame, length: int = LENGTH, qgram: int = QGRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes) for every row of `docs` (doc_id, text).

    A byte goes if a string of `length` bytes over it also starts earlier, in a document before it or further
    left in its own. Null, empty and shorter texts stay as they are. Rows equal in id and text are one document
    and have equal results; see `numbered` for missing and repeated ids. Empty tables give empty results.
    """
    rows = covered(numbered(docs), units, length, qgram)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for i, z in enumerate(batch.column(1).to_pylist()):
                text = np.frombuffer(open_(z), np.uint8)
                gone = cover(len(text), batch.column(2)[i], length)
                spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                out.append((len(text), int(gone.sum()), spans, text[~gone].tobytes()))
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return rows.select("doc_id", "z", "runs").mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")



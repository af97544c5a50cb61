"""Quality by nearest-neighbour voting in a latent semantic space.

Labelled documents become rows of a term matrix: hashed byte trigrams, with case and marks, as damped counts times
inverse document frequency, and a few terms for how much of a text repeats itself or is no prose. A truncated singular value decomposition gives the space. The labelled vectors are
broadcast; every document's exact cosine to all of them is computed block by block, and its nearest neighbours
vote with their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterlens.llm._rows import packed, unpacked
from chatterlens.llm._tables import fold, utf8

HASHED = 1 << 12
#: Shares of words equal to the one before, of three-word windows seen before, of upper-case letters, of marks.
SHARES = 4
SHARE_WEIGHT = 2.0
TERMS = HASHED + SHARES
DIMENSIONS = 64
NEIGHBOURS = 15
#: Labelled rows per label that the space and the votes are made of; with DIMENSIONS it bounds what is broadcast.
MAX_LABELLED = 1024
SHARPNESS = 8
BLOCK = 1024


UPPER = bytes(range(65, 91))
PLAIN = bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123)) + b" \t\n\v\f\r.," + bytes(range(128, 256))


def terms(data: bytes) -> np.ndarray:
    """Damped counts of hashed trigrams, then the shares. White space is one space, digits are one digit."""
    words = data.split()
    out = np.zeros(TERMS, np.float32)
    if not words:
        return out
    line = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    line[(line >= 48) & (line <= 57)] = 48
    code = (line[:-2] << 16 | line[1:-1] << 8 | line[2:]) * np.uint32(2654435761)
    out[:HASHED] = np.log1p(np.bincount(code >> np.uint32(20), minlength=HASHED))
    windows = max(1, len(words) - 2)
    out[HASHED:] = (
        sum(map(eq, words, words[1:])) / len(words),
        1 - len(set(zip(words, words[1:], words[2:]))) / windows if len(words) > 2 else 0,
        (len(data) - len(data.translate(None, UPPER))) / len(data),
        len(data.translate(None, PLAIN)) / len(data),
    )
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(size > 0, size, 1)


def weighted(x: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of the term matrix: trigrams of unit length, then weighted shares."""
    return np.hstack([unit(x[:, :HASHED] * idf), SHARE_WEIGHT * x[:, HASHED:]])


def labelled_ids(labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """doc_id, label: at most `most` ids of each label outside fold 1, taken in the order of a hash of the id."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (F.pmod(fold(labels), F.lit(3)) != 1))
    once = usable.groupBy("doc_id").agg(F.min("quality").alias("label"))
    picked = [once.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for v in (0, 1)]
    return picked[0].unionByName(picked[1])


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> dict:
    """idf, axes, labelled vectors and their labels; at most 2 * most rows of TERMS numbers reach the driver."""
    chosen = docs.select("doc_id", utf8().alias("data")).join(F.broadcast(labelled_ids(labels, most)), "doc_id")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [terms(t).astype("<f4").tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary()), batch.column(2)], names=["doc_id", "v", "label"])

    table = chosen.select("doc_id", "data", "label").mapInArrow(vectors, "doc_id long, v binary, label int")
    # Rows that repeat an id would break the bound.
    rows = table.groupBy("doc_id").agg(F.min("v").alias("v"), F.min("label").alias("label")).orderBy("doc_id").toArrow()
    y = rows.column("label").to_numpy().astype(np.float32)
    x = np.frombuffer(b"".join(rows.column("v").to_pylist()), "<f4").reshape(-1, TERMS)
    idf = np.log((1 + len(x)) / (1 + (x[:, :HASHED] > 0).sum(axis=0))).astype(np.float32) + 1
    x = weighted(x, idf)
    rng = np.random.default_rng(0)
    k = min(DIMENSIONS, len(x))
    basis = rng.standard_normal((TERMS, k + 16)).astype(np.float32) if k else np.zeros((TERMS, 0), np.float32)
    for _ in range(4 if k else 0):  # subspace iteration for the leading right singular vectors
        basis, _ = np.linalg.qr(x.T @ (x @ basis))
    if k:
        _, _, turn = np.linalg.svd(x @ basis, full_matrices=False)
        basis = (basis @ turn.T)[:, :k]
    return {"idf": idf, "axes": basis, "vectors": unit(x @ basis), "labels": y}


def votes(x: np.ndarray, model: dict, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Scores of the rows of a term matrix."""
    y = model["labels"]
    if not len(y):
        return np.full(len(x), 0.5)
    cosine = unit(weighted(x, model["idf"]) @ model["axes"]) @ model["vectors"].T
    k = min(neighbours, len(y))
    near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0) ** SHARPNESS
    prior = 1e-6
    return np.clip((weight * y[near]).sum(axis=1) + prior * y.mean(), 0, None) / (weight.sum(axis=1) + prior)


def score(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """All columns of `docs` (but one named so) and `quality_score` (0 to 1).

    Null and empty texts have no neighbours and get the labelled share; without labels every score is 0.5. Rows
    are scored one by one from their text alone; repeated rows get equal scores. Of neighbours that tie at the last place
    any may vote. An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, most))
    rows = docs.select(packed(docs, "quality_score").alias("d"), utf8().alias("t"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = np.stack([terms(t or b"") for t in part.column(1).to_pylist()])
                out = np.clip(votes(x, model).astype(np.float64), 0, 1)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out)], names=["d", "quality_score"])

    return rows.mapInArrow(judge, f"d {rows.schema['d'].dataType.simpleString()}, quality_score double").select(*unpacked(docs, "d", "quality_score"), "quality_score")

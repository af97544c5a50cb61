"""Language identification by multilingual mixture inference.

A language is a distribution over hashed letter trigrams, counted over all training text. A document is a
mixture of languages: expectation-maximisation estimates the proportions, and a language joins the document's
set only while it raises the log-likelihood by more than a penalty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterlens.llm._rows import packed, unpacked
from chatterlens.llm._tables import fold, utf8

BUCKETS = 1 << 14
SMOOTHING = 0.05
#: Log-likelihood that one more language must add, times log(trigrams + 1).
PENALTY = 4.0
#: A model holds BUCKETS counts a language; more languages than this are refused.
MAX_LANGUAGES = 1000
# Letters of ASCII in lower case and all bytes beyond ASCII stay, everything else is a space.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
ASCII_LETTER = re.compile(rb"[A-Za-z]")


def trigrams(data: bytes) -> np.ndarray:
    """Counts by bucket, one space around every word."""
    line = np.frombuffer(b" " + b" ".join(data.translate(TABLE).split()) + b" ", np.uint8).astype(np.uint32)
    if len(line) < 3:
        return np.zeros(BUCKETS, np.int64)
    code = (line[:-2] << 16 | line[1:-1] << 8 | line[2:]) * np.uint32(2654435761)
    return np.bincount(code >> np.uint32(18), minlength=BUCKETS)


def has_letter(data: bytes) -> bool:
    return bool(ASCII_LETTER.search(data)) or any(map(str.isalpha, data.decode()))


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and their trigram distributions, from every row with a language and outside fold 1."""
    rows = docs.where((F.pmod(fold(docs), F.lit(3)) != 1) & F.col("lang").isNotNull()).select("lang", utf8().alias("data"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[lang] = sums.get(lang, 0) + trigrams(data)
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], names=["lang", "bucket", "n"]
            )

    sums = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = sums.limit(MAX_LANGUAGES * BUCKETS + 1).toArrow()
    langs = sorted(set(table.column("lang").to_pylist()))
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = np.zeros((len(langs), BUCKETS))
    if langs:
        number = {lang: i for i, lang in enumerate(langs)}
        counts[[number[x] for x in table.column("lang").to_pylist()], table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    smooth = counts + SMOOTHING
    return langs, smooth / smooth.sum(axis=1, keepdims=True)


def proportions(likely: np.ndarray, n: np.ndarray, rounds: int = 15) -> tuple[np.ndarray, float]:
    """Mixture proportions and log-likelihood of trigrams seen `n` times, one row of `likely` per language."""
    share, total = np.full(len(likely), 1 / len(likely)), n.sum()
    for _ in range(rounds):
        mixed = share @ likely
        new = share * (likely @ (n / mixed)) / total
        done = np.abs(new - share).max() < 1e-3
        share = new
        if done:
            break
    return share, float(n @ np.log(share @ likely))


def mixture(likely: np.ndarray, n: np.ndarray, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """(languages, proportions): the set chosen by penalised likelihood, largest first."""
    order = np.argsort(-proportions(likely, n)[0], kind="stable")
    chosen, best, cost = order[:1], float(n @ np.log(likely[order[0]])), penalty * np.log(n.sum() + 1)
    share = np.ones(1)
    for size in range(2, len(order) + 1):
        tried, fit = proportions(likely[order[:size]], n)
        if fit - best <= cost:
            break
        chosen, best, share = order[:size], fit, tried
    by = np.argsort(-share, kind="stable")
    return chosen[by], share[by]


def identify(docs: DataFrame) -> DataFrame:
    """All columns of `docs` (but one named `language`) and a struct `language`: lang_pred, score (its share of the text), and the set
    `langs` with `shares`.

    Null texts and texts without a letter are `und` with score 0, as is everything if nothing can be learned.
    Rows are judged one by one, so repeated rows get equal results; among equal shares the language that comes first in
    order goes first. An empty table gives an empty result. The model is BUCKETS numbers a language.
    """
    langs, model = learn(docs)
    shared = docs.sparkSession.sparkContext.broadcast((langs, model))
    kind = "lang_pred string, score double, langs array<string>, shares array<double>"

    def judge(data: bytes, langs: list[str], model: np.ndarray) -> tuple:
        counts = trigrams(data) if langs and has_letter(data) else np.zeros(1)
        at = np.flatnonzero(counts)
        if not len(at):
            return "und", 0.0, [], []
        chosen, share = mixture(model[:, at], counts[at].astype(float))
        return langs[chosen[0]], min(1.0, float(share[0])), [langs[i] for i in chosen], share.tolist()

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, model = shared.value
        kinds = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("langs", pa.list_(pa.string())), ("shares", pa.list_(pa.float64()))])
        names = [f.name for f in kinds]
        for batch in batches:
            out = [dict(zip(names, judge(t or b"", langs, model))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kinds)], names=["d", "language"])

    rows = docs.select(packed(docs, "language").alias("d"), utf8().alias("t"))
    fields = kind.replace(" ", ":").replace(",:", ", ")
    return rows.mapInArrow(predict, f"d {rows.schema['d'].dataType.simpleString()}, language struct<{fields}>").select(*unpacked(docs, "d", "language"), "language")

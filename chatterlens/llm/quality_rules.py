"""Quality rules by compression bands.

Prose compresses within a narrow band that depends on its length. A text whose zstandard ratio (bytes over
compressed bytes) lies above the band repeats itself; one below it is noise. The whole text is judged, and
fixed chunks of it, so that a repetitive passage in an otherwise plain text is seen too.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterlens.llm._rows import packed, unpacked
from chatterlens.llm._tables import utf8

# Smallest length in bytes, lowest and highest ratio that prose of this length has.
BANDS = (
    (0, 0.0, float("inf")),
    (128, 1.0, 2.4),
    (256, 1.15, 2.4),
    (512, 1.3, 2.6),
    (1024, 1.4, 2.8),
    (4096, 1.45, 3.0),
    (16384, 1.5, 3.4),
    (65536, 1.5, 4.0),
)
CHUNK_BYTES = 2048
BAD_CHUNK_SHARE = 0.25
LEVEL = 3
SYMBOLS = b"#*$%&|<>"
MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "zstd_ratio double, bad_chunk_share double, in_band boolean"
)


def in_band(n_bytes: int, ratio: float, bands=BANDS) -> bool:
    low, high = next((lo, hi) for least, lo, hi in reversed(bands) if n_bytes >= least)
    return low <= ratio <= high


def repeated_window_words(words: list[bytes], width: int = 3) -> int:
    """Words in a window of `width` words that occurs twice or more, its first occurrence included."""
    windows = list(zip(*(words[i:] for i in range(width))))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    total, covered = 0, 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            total += i + width - max(i, covered)
            covered = i + width
    return total


def duplicate_lines(data: bytes) -> int:
    lines = [line for line in data.split(b"\n") if line.split()]
    return len(lines) - len(set(lines))


def measure(data: bytes, compress, bands=BANDS, chunk: int = CHUNK_BYTES, bad_share: float = BAD_CHUNK_SHARE) -> tuple:
    words = data.split()
    ratio = len(data) / len(compress(data)) if data else 1.0
    bad = 0
    if len(data) > chunk:
        for at in range(0, len(data), chunk):
            piece = data[at : at + chunk]
            if not in_band(len(piece), len(piece) / len(compress(piece)), bands):
                bad += len(piece)
    share = bad / len(data) if data else 0.0
    return (
        len(words),
        len(b"".join(words).decode()),
        sum(data.count(bytes([c])) for c in SYMBOLS),
        duplicate_lines(data),
        repeated_window_words(words),
        ratio,
        share,
        in_band(len(data), ratio, bands) and share < bad_share,
    )


def _judged(docs: DataFrame, row: Column, bands, chunk: int, bad_share: float) -> DataFrame:
    """row, rules."""
    names = [part.split()[0] for part in MEASURES.split(", ")]

    @F.pandas_udf(MEASURES)
    def measured(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        for batch in texts:
            yield pd.DataFrame([measure(bytes(t), compress, bands, chunk, bad_share) for t in batch], columns=names)

    failed = F.expr("m.n_words < 50 or 100 * m.n_repeat_words > 50 * m.n_words")
    return docs.select(row.alias("row"), measured(utf8()).alias("m")).select(
        "row",
        F.struct(
            *[F.col(f"m.{n}") for n in names], failed.alias("base_failed"), (~failed & F.col("m.in_band")).alias("kept")
        ).alias("rules"),
    )


def compression_bands(docs: DataFrame, bands=BANDS, chunk: int = CHUNK_BYTES, bad_share: float = BAD_CHUNK_SHARE) -> DataFrame:
    """All columns of `docs` and a struct `rules`: MEASURES, base_failed and kept.

    Null and empty texts have no words and fail the base rules. Every row is judged by itself, so repeated rows
    get equal results; an empty table gives an empty result. A column named `rules` gives way. One scan, no shuffle;
    memory is one Arrow batch of texts.
    """
    rows = _judged(docs, packed(docs, "rules"), bands, chunk, bad_share)
    return rows.select(*unpacked(docs, "row", "rules"), "rules")


def keep_in_band(docs: DataFrame) -> DataFrame:
    """The rows that pass, with their own columns only, whatever they are called."""
    rows = _judged(docs, packed(docs), BANDS, CHUNK_BYTES, BAD_CHUNK_SHARE).where("rules.kept")
    return rows.select(*unpacked(docs, "row"))

"""64-bit numbers for words and for runs of consecutive words."""

from __future__ import annotations

import numpy as np
import xxhash

FACTOR = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(32))) * MIX
    return x ^ (x >> np.uint64(32))


def word_numbers(words: list[bytes]) -> np.ndarray:
    number = xxhash.xxh3_64_intdigest
    return np.fromiter((number(w) for w in words), np.uint64, len(words))


def runs(numbers: np.ndarray, width: int) -> np.ndarray:
    """One number for every `width` consecutive numbers."""
    n = len(numbers) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = mixed(out * FACTOR + numbers[i : n + i])
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)

"""Runs: maximal stretches of words that repeat with a period at least four times.

An enhanced suffix array (suffix order, its inverse, and the longest common prefixes of neighbours) is made for
all texts of a line at once; words of different texts never compare equal. An LCP interval of depth d holds the
suffixes that begin with one string of d words. A suffix i of all its children but the largest is checked: if i+d
or i-d is in the interval too, the string occurs twice in a row, and if the words after the two differ, it is a
branching tandem. Branching tandems are rotated to the left as far as words agree; rotations of one square merge
into a run. No tree is built.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chatterlens.llm._rows import with_results
from chatterlens.llm._tables import utf8

#: Words that are worked on together; a longer text is a line of its own.
LINE = 1 << 18
LEAST_WORDS, LEAST_PERIODS = 6, 4


class SuffixArray:
    """Of a line of numbers in which every text ends with a number of its own."""

    def __init__(self, line: np.ndarray):
        n = len(line)
        order = np.argsort(line, kind="stable")
        rank = np.empty(n, np.int64)
        new = np.ones(n, bool)
        new[1:] = line[order[1:]] != line[order[:-1]]
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        open_ = self._shared(rank, np.arange(n))
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        step = 1
        while len(open_):
            # Suffixes that share `step` words have one rank, the first place of their group.
            self.levels.append((open_, rank[open_]))
            by = np.lexsort((rank[open_ + step], rank[open_]))
            at, group, then = open_[by], rank[open_][by], rank[open_ + step][by]
            first, new = np.ones(len(at), bool), np.ones(len(at), bool)
            first[1:] = group[1:] != group[:-1]
            new[1:] = first[1:] | (then[1:] != then[:-1])
            place = np.arange(len(at))
            begin = np.maximum.accumulate(np.where(first, place, 0))
            rank[at] = group + np.maximum.accumulate(np.where(new, place, 0)) - begin
            open_ = self._shared(rank, open_)
            step *= 2
        self.inverse = rank
        self.order = np.empty(n, np.int64)
        self.order[rank] = np.arange(n)
        self.lcp = np.zeros(n, np.int64)
        if self.levels:
            # Neighbours that share the first word.
            word = line[self.order]
            at = np.flatnonzero(word[1:] == word[:-1]) + 1
            self.lcp[at] = self.agreement(self.order[at - 1], self.order[at], 1)

    @staticmethod
    def _shared(rank: np.ndarray, places: np.ndarray) -> np.ndarray:
        count = np.bincount(rank[places], minlength=1)
        return places[count[rank[places]] > 1]

    def agreement(self, a: np.ndarray, b: np.ndarray, way: int) -> np.ndarray:
        """Words that agree from a and b on (way 1), or before them (way -1), by steps of halved length."""
        shared, rank = np.zeros(len(a), np.int64), self.inverse.copy()
        for k in reversed(range(len(self.levels))):
            places, ranks = self.levels[k]
            rank[places] = ranks
            step = 1 << k
            x, y = (a + shared, b + shared) if way > 0 else (a - shared - step, b - shared - step)
            inside = np.minimum(x, y) >= 0
            shared += step * (inside & (rank[np.maximum(x, 0)] == rank[np.maximum(y, 0)]))
        return shared


def smaller_before(values: np.ndarray) -> np.ndarray:
    """Place of the nearest smaller value before each value above 0; values[0] is 0."""
    before = np.arange(-1, len(values) - 1)
    todo = np.flatnonzero(values > 0)
    while len(todo := todo[values[before[todo]] >= values[todo]]):
        before[todo] = before[before[todo]]
    return before


def branching_tandems(line: np.ndarray, array: SuffixArray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of squares whose two halves are followed by different words."""
    n, lcp = len(line), array.lcp
    after = n - smaller_before(np.concatenate([[0], lcp[::-1]]))[1:][::-1]
    at = np.flatnonzero(lcp > 0)
    low, high, depth = smaller_before(lcp)[at], after[at], lcp[at]
    by = np.lexsort((at, depth, low))
    at, low, high, depth = at[by], low[by], high[by], depth[by]
    first = np.ones(len(at), bool)
    first[1:] = (low[1:] != low[:-1]) | (depth[1:] != depth[:-1])
    interval = np.cumsum(first) - 1
    # Children: one from every place between suffixes to the next of the interval, and one before the first.
    ends = np.append(at[1:], 0)
    last = np.append(first[1:], True)[: len(at)]
    ends = np.where(last, high, ends)
    begins, ends, of = np.concatenate([low[first], at]), np.concatenate([at[first], ends]), np.concatenate([interval[first], interval])
    by = np.lexsort((begins, begins - ends, of))
    largest = np.ones(len(by), bool)
    largest[1:] = of[by][1:] != of[by][:-1]
    use = by[~largest]
    size = ends[use] - begins[use]
    place = np.repeat(begins[use] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    which = np.repeat(np.flatnonzero(first)[of[use]], size)
    suffix, low, high, depth = array.order[place], low[which], high[which], depth[which]
    starts, periods = [], []
    for other, start in ((suffix + depth, suffix), (suffix - depth, suffix - depth)):
        there = array.inverse[np.maximum(other, 0)]
        hit = np.flatnonzero((other >= 0) & (there >= low) & (there < high))
        s, d = start[hit], depth[hit]
        branching = line[s + d] != line[s + 2 * d]
        starts.append(s[branching])
        periods.append(d[branching])
    found = np.unique(np.stack([np.concatenate(starts), np.concatenate(periods)]), axis=1)
    return found[0], found[1]


def runs_of(line: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, least period) of all runs, by start and period."""
    array = SuffixArray(line)
    start, period = branching_tandems(line, array)
    turned = array.agreement(start, start + period, -1)
    start, length = start - turned, 2 * period + turned
    long = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    start, length, period = start[long], length[long], period[long]
    # A square of a square spans the same stretch: the least period names it.
    by = np.lexsort((period, length, start))
    start, length, period = start[by], length[by], period[by]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


def line_of(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words, with one more number after every text; where the texts begin."""
    begins, parts, used = [], [], 0
    at = 0
    for words in texts:
        known: dict[bytes, int] = {}
        numbers = [known.setdefault(w, len(known)) for w in words]
        numbers.append(len(known))
        parts.append(np.array(numbers, np.int64) + used)
        used += len(known) + 1
        begins.append(at)
        at += len(numbers)
    return np.concatenate(parts), np.array(begins)


def judged(texts: list[list[bytes]]) -> list[dict]:
    line, begins = line_of(texts)
    start, length, period = runs_of(line)
    edge = np.zeros(len(line) + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    kept = np.cumsum(edge[:-1]) == 0
    of = np.searchsorted(begins, start, "right") - 1
    cuts = np.searchsorted(of, np.arange(len(texts) + 1))
    out = []
    for i, words in enumerate(texts):
        here = slice(cuts[i], cuts[i + 1])
        found = zip((start[here] - begins[i]).tolist(), length[here].tolist(), period[here].tolist())
        if cuts[i] != cuts[i + 1]:
            mask = kept[begins[i] : begins[i] + len(words)].tolist()
            words = [w for w, keep in zip(words, mask) if keep]
        out.append({"runs": [dict(zip(("start", "length", "period"), r)) for r in found], "collapsed": b" ".join(words).decode()})
    return out


def collapse(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of `docs`, `runs` (start, length, least period; by start, then period) and `collapsed`.

    A run has at least six words and four periods. `collapsed` is the text's words without those that any run
    holds after its first period, joined by one space. Words are runs of other characters than white space of
    ASCII. Null, empty and blank texts have no runs and collapse to an empty text; rows are judged one by one, so
    repeated rows get equal results; columns named `runs` or `collapsed` give way. A line of words takes some
    300 bytes a word.
    """
    number = T.LongType()
    run = T.StructType([T.StructField(c, number) for c in ("start", "length", "period")])
    results = T.StructType([T.StructField("runs", T.ArrayType(run)), T.StructField("collapsed", T.StringType())])
    kind = pa.struct([("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))), ("collapsed", pa.string())])

    def work(given: pa.Array) -> pa.Array:
        out, held, n = [], [], 0
        for data in given:
            words = data.as_py().split()
            if held and n + len(words) > LINE:
                out += judged(held)
                held, n = [], 0
            held.append(words)
            n += len(words) + 1
        return pa.array(out + judged(held) if held else out, kind)

    return with_results(docs, utf8(text), results, work)

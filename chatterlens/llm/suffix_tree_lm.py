"""Language model scores from a probabilistic suffix tree over running words.

Symbols are the distinct tokens: words, and one end a text. A context is up to `depth` tokens before a token; the end
of an earlier text stands before the first word, and no context reaches beyond it. With c the training counts, s a
context, s' the same without its first token, and "" the empty one,

    P(x | "") = (c(x) + 0.1) / (N + 0.1 (V + 1))
    P(x | s)  = (c(s x) + PRIOR P(x | s')) / (c(s) + PRIOR).

A context is retained if its suffix s' is, it was seen at least LEAST times, and the sum of ln P(x | s) / P(x | s')
over all training tokens x that follow it reaches DIVERGENCE. Each token is scored in the state of its longest retained
context; the score of a text is the sum of log10 P over its tokens.

The corpus is kept as packs of texts, in which a token is an index into the pack's words. In each round a pack asks
for the counts of its distinct grams, and reports what its training tokens add to the divergence of its distinct
contexts. Questions are dealt by the hash of gram or context, so one pack sends one row a gram however often it
occurs, and a bucket holds at most one row a pack of any gram. Answers go back to the packs in the order of the
questions. A pack that alone has a part of a gram has all of the gram, and does not ask for it. Others
ask by the numbers that earlier answers gave to context and token, which are shorter than hashes. The tree is never in
one place. Words, and the grams of a pack, are told apart by 64-bit hashes.
"""

from __future__ import annotations

import os
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterlens.llm._hash import FACTOR, mixed, word_numbers
from chatterlens.llm._tables import store

#: Longest context, in tokens.
DEPTH = 2
#: Times that a context must have been seen.
LEAST = 4
#: Nats that a context's own distribution must save over its suffix's, on all that follows it.
DIVERGENCE = 3.0
#: Weight of the suffix's distribution, in tokens.
PRIOR = 4.0
#: Contributions to a divergence are whole multiples of 1 / GRAIN, so that sums do not depend on their order.
GRAIN = 1 << 20
PACK_TOKENS = 1 << 19
BUCKET_TOKENS = 1 << 21
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
END = 0
#: What is asked of a bucket: counts of single tokens, counts of longer grams, retention of contexts.
TOKENS, GRAMS, CONTEXTS = 0, 1, 2
PACK = ["pack", "sizes", "learn", "words", "line"]
ANSWERS = "turn int, kind int, bucket long, pack string, values binary, ranks binary, fresh long, ranked long"


def scattered(keys: np.ndarray, bits: int) -> np.ndarray:
    """Whole numbers of so many bits, each exchanged for another one, evenly over their range."""
    mask, half = np.uint64((1 << bits) - 1), np.uint64(max(1, bits // 2))
    for _ in range(2):
        keys = keys * FACTOR & mask
        keys ^= keys >> half
    return keys * FACTOR & mask


def squeezed(a: np.ndarray) -> bytes:
    """An array as its byte planes, compressed."""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def spread_out(data: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(dtype).ravel()


def packs(docs: DataFrame, training) -> DataFrame:
    """pack, ids, sizes, learn, words, line, n, trained: texts of some PACK_TOKENS tokens a row.

    The name of a pack is drawn at random once, and stored with it.
    """

    def numbers() -> defaultdict:
        """Numbers words as they come; the end has the first."""
        index = defaultdict(count().__next__)
        assert index[b""] == END
        return index

    def packed(ids: list, sizes: list, learn: list, index: dict, line: list, kind: pa.DataType) -> pa.RecordBatch:
        sizes, learn = np.array(sizes, np.int64), np.array(learn, np.uint8)
        columns = [
            pa.array([os.urandom(16).hex()]),
            pa.array([ids], pa.list_(kind)),
            pa.array([squeezed(sizes)]),
            pa.array([squeezed(learn)]),
            pa.array([squeezed(word_numbers(list(index)))]),
            pa.array([squeezed(np.array(line, np.int32))]),
            pa.array([len(line)]),
            pa.array([int((sizes * learn).sum())]),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["pack", "ids", "sizes", "learn", "words", "line", "n", "trained"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, learn, index, line, kind = [], [], [], numbers(), [], None
        for batch in batches:
            kind = batch.column(0).type
            for doc_id, text, learns in zip(*batch.columns):
                tokens = text.as_py().translate(LOWER).split()
                line.extend(map(index.__getitem__, tokens))
                line.append(END)
                ids.append(doc_id.as_py())
                sizes.append(len(tokens) + 1)
                learn.append(learns.as_py())
                if len(line) >= PACK_TOKENS:
                    yield packed(ids, sizes, learn, index, line, kind)
                    ids, sizes, learn, index, line = [], [], [], numbers(), []
        if ids:
            yield packed(ids, sizes, learn, index, line, kind)

    given = docs.select(
        F.col("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
        F.coalesce(training, F.lit(False)).alias("learn"),
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(
        pack, f"pack string, ids array<{kind}>, sizes binary, learn binary, words binary, line binary, n long, trained long"
    )


@dataclass
class Plan:
    """What all packs know. `widths` are the bits of a gram's number inside its bucket, by length of grams."""

    depth: int
    buckets: int
    tokens: int
    words: int = 0
    widths: list[int] = field(default_factory=list)

    def bits(self, n: int) -> int:
        """Bits of the numbers of grams of `n` tokens."""
        return (self.buckets - 1).bit_length() + self.widths[n - 1]


class Question:
    """What a pack says of the distinct things at some of its tokens, and the keys of those it asks for, ascending."""

    def __init__(self, kind: int, where: np.ndarray, at: np.ndarray, own: np.ndarray, open_: np.ndarray, keys: np.ndarray, bits: int):
        order = np.argsort(keys)
        self.kind, self.where, self.at, self.own, self.bits = kind, where, at, own, bits
        self.open, self.keys = open_[order], keys[order]

    def buckets(self, n: int) -> np.ndarray:
        over = np.uint64(max(0, self.bits - 32))
        return ((self.keys >> over) * np.uint64(n) >> np.uint64(min(self.bits, 32))).astype(np.int64)

    def settled(self, answer: tuple[np.ndarray, np.ndarray] | None, buckets: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sum and number of everything, and if other packs have it: as answered where it asked, its own elsewhere.
        Of contexts, whether they are retained takes the place of the sum."""
        total, shared, number = self.own.copy(), np.zeros(len(self.own), bool), np.zeros(len(self.own), np.uint64)
        if self.kind == CONTEXTS:
            total = total >= int(DIVERGENCE * GRAIN)
            if answer is not None:
                total[self.open] = answer[0]
        elif answer is not None:
            total[self.open], shared[self.open] = answer[0] >> 1, answer[0] & 1
            number[self.open] = (self.buckets(buckets).astype(np.uint64) << np.uint64(width)) | answer[1].astype(np.uint64)
        return total, shared, number


def summed(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Whole-number sums by index."""
    out = np.zeros(size, np.int64)
    np.add.at(out, at, values)
    return out


class Pack:
    """One pack's tokens in their order, and all that the answers of earlier rounds say about them.

    `counts[n - 1]` are the counts of the grams of n tokens that end at each token, `shared[n - 1]` says whether other
    packs hold them too, `ids[n - 1]` are their numbers if they are shared and may go on, `kept[d - 1]` says whether the
    context of d tokens before each token reaches the limits. `at[n - 1]` numbers the pack's `distinct[n - 1]` grams.
    """

    def __init__(self, row: dict, answers: dict, turns: int, plan: Plan):
        self.sizes, learn = spread_out(row["sizes"], np.int64), spread_out(row["learn"], np.uint8)
        numbers, self.line = spread_out(row["words"], np.uint64), spread_out(row["line"], np.int32)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.place = np.arange(len(self.line)) - np.repeat(self.first, self.sizes)
        self.weight = np.repeat(learn, self.sizes).astype(np.int64)
        self.word = mixed(numbers * FACTOR + np.uint64(1))
        self.grams = [self.word[self.line]]
        self.plan = plan
        self.counts, self.shared, self.ids, self.kept, self.chances = [], [], [], [], []
        self.distinct, self.at = [], []
        for turn in range(1, turns + 1):
            for question in self.questions(turn):
                self.hear(question, answers.get((turn, question.kind)))

    def before(self, values: np.ndarray, first) -> np.ndarray:
        """The values one token earlier; the end of an earlier text comes before a text's first token."""
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.first] = first
        return out

    def context(self, d: int, of: list[np.ndarray]) -> np.ndarray:
        """What `of` says of the context of `d` tokens before each token; 0 where there is none."""
        values, end = of[d - 1], self.first[0] + self.sizes[0] - 1
        return np.where(self.place >= d - 1, self.before(values, values[end]), values.dtype.type(0))

    def chance(self, n: int) -> np.ndarray:
        """P at each token for contexts of `n` tokens."""
        if n == len(self.chances):
            if n == 0:
                p = (self.counts[0] + 0.1) / (self.plan.tokens + 0.1 * (self.plan.words + 1))
            else:
                p = (self.counts[n] + PRIOR * self.chance(n - 1)) / (self.context(n, self.counts) + PRIOR)
            self.chances.append(p)
        return self.chances[n]

    def questions(self, turn: int) -> Iterator[Question]:
        """Round 1 asks for tokens, round n for grams of n tokens and for the contexts of n - 2."""
        if turn == 1:
            every = np.arange(len(self.word))
            yield Question(TOKENS, np.arange(len(self.line)), self.line, summed(self.line, self.weight, len(every)), every, self.word, 64)
            return
        if turn > 2:
            d = turn - 2
            self.chance(d - 1)
            saved = np.rint(np.log(self.chance(d) / self.chance(d - 1)) * GRAIN).astype(np.int64) * self.weight
            where = np.flatnonzero(self.context(d, self.counts) >= LEAST)
            at, ids = self.context(d, self.at)[where], self.context(d, self.ids)[where]
            open_ = self.context(d, self.shared)[where]
            yield self.question(CONTEXTS, where, at, self.distinct[d - 1], saved, open_, ids, self.plan.bits(d))
        if turn <= self.plan.depth + 1:
            d, low = turn - 1, self.plan.bits(1)
            bits = self.plan.bits(d) + low
            if len(self.grams) < turn:
                self.grams.append(mixed(self.context(d, self.grams) * FACTOR + self.grams[0]))
            where = np.flatnonzero(self.context(d, self.counts) >= LEAST)
            numbers, at = np.unique(self.grams[d][where], return_inverse=True)
            ids, word = self.context(d, self.ids)[where], self.ids[0][where]
            key, bits = (mixed(mixed(ids) * FACTOR + word), 64) if bits > 63 else ((ids << np.uint64(low)) | word, bits)
            open_ = self.context(d, self.shared)[where] & self.shared[d - 1][where] & (self.counts[d - 1][where] > 0)
            yield self.question(GRAMS, where, at, len(numbers), self.weight, open_, key, bits)

    def question(self, kind: int, where, at, size: int, value, open_, key, bits: int) -> Question:
        """About `size` distinct things, number `at` of them at each token in `where`; open where other packs may have them."""
        asks, keys = np.zeros(size, bool), np.zeros(size, np.uint64)
        asks[at], keys[at] = open_, key
        asks = np.flatnonzero(asks)
        keys = keys[asks] if bits == 64 else scattered(keys[asks], bits)
        return Question(kind, where, at, summed(at, value[where], size), asks, keys, bits)

    def hear(self, question: Question, answer: tuple[np.ndarray, np.ndarray] | None) -> None:
        width = 0 if question.kind == CONTEXTS else self.plan.widths[len(self.counts)]
        targets = (self.kept,) if question.kind == CONTEXTS else (self.counts, self.shared, self.ids)
        if question.kind != CONTEXTS:
            self.distinct.append(len(question.own))
            self.at.append(np.zeros(len(self.line), np.int64))
            self.at[-1][question.where] = question.at
        for target, values in zip(targets, question.settled(answer, self.plan.buckets, width)):
            target.append(np.zeros(len(self.line), values.dtype))
            target[-1][question.where] = values[question.at]

    def results(self) -> tuple[np.ndarray, ...]:
        """Of each text: tokens, known tokens, log10 of the base and of the tree."""
        best, alive = self.chance(0), np.ones(len(self.line), bool)
        known = np.add.reduceat((self.counts[0] > 0).astype(np.int64), self.first)
        base = np.add.reduceat(np.log10(best), self.first)
        for d, kept in enumerate(self.kept, 1):
            alive &= kept
            best = np.where(alive, self.chance(d), best)
        return self.sizes, known, base, np.add.reduceat(np.log10(best), self.first)


def heard(found: pa.Table) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """The answers to one pack by round and kind, in the order of its keys."""
    by: dict[tuple[int, int], list] = {}
    for turn, kind, *rest in zip(*(found.column(c).to_pylist() for c in ("turn", "kind", "bucket", "values", "ranks"))):
        by.setdefault((turn, kind), []).append(rest)
    return {
        k: tuple(np.concatenate([spread_out(p[i], np.int64) for p in sorted(parts)]) for i in (1, 2)) for k, parts in by.items()
    }


def asked(packed: DataFrame, known: DataFrame | None, turn: int, plan: Plan) -> DataFrame:
    """kind, bucket, pack, keys, sums: the keys a pack asks for in round `turn`, cut into buckets of equal ranges of keys.

    Within a bucket the first key is followed by the differences."""
    schema = "kind int, bucket long, pack string, keys binary, sums binary"

    def rows(pack: Pack, name: str) -> Iterator[pa.RecordBatch]:
        for q in pack.questions(turn):
            if not len(q.open):
                continue
            keys, own, bucket = np.diff(q.keys, prepend=np.uint64(0)), q.own[q.open], q.buckets(plan.buckets)
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
            ends = np.append(cuts[1:], len(keys))
            keys[cuts] = q.keys[cuts]
            columns = [
                pa.array(np.full(len(cuts), q.kind, np.int32)),
                pa.array(bucket[cuts]),
                pa.array([name] * len(cuts)),
                pa.array([squeezed(keys[a:b]) for a, b in zip(cuts, ends)], pa.binary()),
                pa.array([squeezed(own[a:b]) for a, b in zip(cuts, ends)], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "bucket", "pack", "keys", "sums"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield from rows(Pack(row, {}, 0, plan), row["pack"])

    def later(key: tuple[pa.Scalar, ...], given: pa.Table, found: pa.Table) -> pa.Table:
        row = given.to_pylist()[0]
        made = list(rows(Pack(row, heard(found), turn - 1, plan), row["pack"]))
        return pa.Table.from_batches(made, None if made else pa.schema(
            [("kind", pa.int32()), ("bucket", pa.int64()), ("pack", pa.string()), ("keys", pa.binary()), ("sums", pa.binary())]
        ))

    slim = packed.select(*PACK)
    if known is None:
        return slim.mapInArrow(first, schema)
    return slim.groupBy("pack").cogroup(known.groupBy("pack")).applyInArrow(later, schema)


def answered(questions: DataFrame, turn: int) -> DataFrame:
    """In the order of the questions: twice the sum over all packs, and 1 more if several asked; ranks in the bucket of
    what several packs have and a longer gram may hold. For contexts whether they are retained.

    `fresh` of one row a bucket is the number of its keys that occur in training, `ranked` the number of ranks.
    """

    def answer(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        kind, bucket = (k.as_py() for k in key)
        keys = [np.cumsum(spread_out(b.as_py(), np.uint64), dtype=np.uint64) for b in table.column("keys")]
        sums = np.concatenate([spread_out(b.as_py(), np.int64) for b in table.column("sums")])
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = summed(at, sums, len(distinct))
        several = np.bincount(at) > 1
        values = total >= int(DIVERGENCE * GRAIN) if kind == CONTEXTS else total * 2 + several
        named = several & (total >= (LEAST if kind == GRAMS else 1)) & (kind != CONTEXTS)
        ranks = np.where(named, np.cumsum(named) - 1, 0)
        cuts = np.cumsum([0] + [len(k) for k in keys])
        fresh, ranked = np.zeros((2, len(keys)), np.int64)
        fresh[0], ranked[0] = (total > 0).sum(), named.sum()
        return pa.table({
            "turn": pa.array([turn] * len(keys), pa.int32()),
            "kind": pa.array([kind] * len(keys), pa.int32()),
            "bucket": pa.array([bucket] * len(keys), pa.int64()),
            "pack": table.column("pack"),
            "values": pa.array([squeezed(values[at[a:b]].astype(np.int64)) for a, b in zip(cuts, cuts[1:])], pa.binary()),
            "ranks": pa.array([squeezed(ranks[at[a:b]]) for a, b in zip(cuts, cuts[1:])], pa.binary()),
            "fresh": pa.array(fresh),
            "ranked": pa.array(ranked),
        })

    return questions.groupBy("kind", "bucket").applyInArrow(answer, ANSWERS)


def stored(answers: DataFrame) -> DataFrame:
    """A table of answers; the shuffle files of its making go with the job that needed them."""
    conf, name = answers.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, "false")
    conf.set(name, "true")
    try:
        return store(answers, "answers")
    finally:
        conf.set(name, before)


def scores(docs: DataFrame, training, depth: int = DEPTH) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score for every row of `docs` (doc_id, text).

    `training` is a condition on `docs`; where it is NULL a row is not learnt from. Null and empty texts are one end.
    Every row is a text of its own, also where ids are missing or rows are given twice; a row that is repeated among
    the training rows counts as often. Equal texts have equal scores. Without training rows all counts are 0, nothing
    is retained and every token has probability 1. An empty table has no rows. Other columns are not looked at.
    """
    packed = store(packs(docs, training), "packs")
    sums = packed.agg(F.coalesce(F.sum("trained"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plan, known = Plan(depth, max(parts, -(-int(sums[1]) // BUCKET_TOKENS)), int(sums[0])), None
    turns = depth + 2 if depth else 1
    for turn in range(1, turns + 1):
        made = stored(answered(asked(packed, known, turn, plan), turn))
        of = made.where(F.col("kind") != CONTEXTS).agg(F.coalesce(F.sum("fresh"), F.lit(0)), F.coalesce(F.max("ranked"), F.lit(0))).first()
        if turn == 1:
            plan.words = int(of[0])
        plan.widths.append(int(of[1]).bit_length())
        known = made if known is None else known.unionByName(made)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def judge(key: tuple[pa.Scalar, ...], given: pa.Table, found: pa.Table) -> pa.Table:
        pack = Pack(given.drop_columns(["ids"]).to_pylist()[0], heard(found), turns, plan)
        n, seen, base, score = pack.results()
        ids = given.column("ids").combine_chunks().flatten()
        return pa.table([ids, *map(pa.array, (n, seen, np.full(len(n), plan.tokens), base, score))], names=names)

    return packed.select("ids", *PACK).groupBy("pack").cogroup(known.groupBy("pack")).applyInArrow(
        judge, f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )

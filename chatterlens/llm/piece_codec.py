"""Encoding and decoding with a merge-type SentencePiece vocabulary.

All adjacent pairs of symbols that form a piece stand on an agenda ordered by the piece's score, then by place; the
best pair is merged and its new neighbours are put on the agenda. No piece of such a vocabulary reaches from a
character into a following space, so texts are cut there first: no merge can cross a cut, and a stretch that occurs
again has the same pieces. Stretches are laid out on one line and worked on together, each with the agenda of its own
pairs; a long one has a heap. Each Arrow batch is checked against the sentencepiece library.
"""

from __future__ import annotations

import codecs
import functools
import heapq
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatterlens.llm._rows import column, with_results

SPACE = "▁"
#: Fixed numbers of the model file's format: fields, and the kinds of pieces and models.
PIECE, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGES = 2
#: Stretches of up to KEPT_CHARS characters are merged ROWS at a time and stay with their pieces, some KEPT of them
#: in a worker. Texts are worked on in groups of GROUP characters.
KEPT_CHARS, ROWS, KEPT, GROUP = 64, 1 << 14, 1 << 18, 1 << 20
CHARACTERS = 0x110000
NEVER = np.int32((1 << 31) - 1)


def fields(data: bytes) -> dict[int, list]:
    """Values of a protocol buffer message by field number."""
    out: dict[int, list] = {}
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = number()
        if key & 7 == 0:
            value: int | bytes = number()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or number()
            value = data[at : at + size]
            at += size
        out.setdefault(key >> 3, []).append(value)
    return out


class Vocabulary:
    """Pieces, scores and rules of a model. Models that are not of the merge type, have no byte pieces, rewrite
    characters or white space, or have user-defined or unused pieces are refused with a ValueError."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        said = fields(model)
        trainer, rules = (fields(said.get(f, [b""])[0]) for f in (TRAINER, NORMALIZER))
        kinds = [fields(p).get(3, [NORMAL])[0] for p in said[PIECE]]
        # Fields: trainer 3 model type, 24 space as suffix, 35 byte pieces; normalizer 2 character map, 3 first
        # space, 4 extra spaces removed, 5 spaces escaped.
        if trainer.get(3) != [MERGES] or trainer.get(35) != [1] or kinds.count(BYTE) != 256:
            raise ValueError("not a merge-type model with byte pieces")
        if any(rules.get(2, [b""])) or rules.get(4, [1]) != [0] or rules.get(5, [1]) != [1] or trainer.get(24, [0]) != [0]:
            raise ValueError("the model rewrites its input")
        if set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("the model has user-defined or unused pieces")
        self.first_space = rules.get(3, [1]) == [1]
        self.end = self.library.eos_id()
        self.kinds = kinds
        self.is_control = np.array([k == CONTROL for k in kinds])
        self.controls = {i for i, k in enumerate(kinds) if k == CONTROL}
        names = [self.library.id_to_piece(i) for i in range(len(kinds))]
        self.ids = {name: i for i, name in enumerate(names) if kinds[i] == NORMAL}
        self.scores = {name: self.library.get_score(i) for name, i in self.ids.items()}
        self.bytes = [0] * 256
        self.surface = []
        for i, (name, kind) in enumerate(zip(names, kinds)):
            if kind == BYTE:
                value = int(name[3:-1], 16)
                self.bytes[value] = i
                self.surface.append(bytes([value]))
            else:
                shown = {NORMAL: name.replace(SPACE, " "), CONTROL: "", UNKNOWN: " ⁇ "}[kind]
                self.surface.append(shown.encode())
        self.lengths = np.array([len(x) for x in self.surface], np.int64)
        self.places = np.cumsum(self.lengths) - self.lengths
        self.letters = np.frombuffer(b"".join(self.surface), np.uint8)
        pairs = {p for name in self.ids for p in zip(name, name[1:])}
        inside = {c for pair in pairs for c in pair}
        alone = "".join(re.escape(c) for c in map(chr, range(128)) if c not in inside and c != " ")
        if any(b == SPACE != a for a, b in pairs):
            self.stretches = re.compile(r"[\s\S]+")
        else:
            rest = f"[^{SPACE}{alone}]+"
            self.stretches = re.compile(f"{SPACE}*{rest}|{SPACE}+" + (f"|[{alone}]" if alone else ""))
        # A symbol is a piece's id, or a character's code after all ids.
        self.symbols = len(kinds) + np.arange(CHARACTERS, dtype=np.int32)
        for name, i in self.ids.items():
            if len(name) == 1:
                self.symbols[ord(name)] = i
        order = {x: r for r, x in enumerate(sorted(set(self.scores.values()), reverse=True))}
        joins = {}
        for name, i in self.ids.items():
            for cut in range(1, len(name)):
                a, b = self.symbol(name[:cut]), self.symbol(name[cut:])
                if a is not None and b is not None:
                    joins[self.pair(a, b)] = (i, order[self.scores[name]])
        self.pairs = np.array(sorted(joins) + [np.iinfo(np.int64).max], np.int64)
        made = np.array([joins[k] for k in self.pairs[:-1].tolist()] + [(0, NEVER)], np.int32).T
        self.made, self.order = made[0].copy(), made[1].copy()
        self.forget()

    def forget(self) -> None:
        """Start with no stretch kept: where its ids begin in `flat`, and how many there are."""
        self.known: dict[str, int] = {}
        self.flat, self.begins, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def symbol(self, text: str) -> int | None:
        return int(self.symbols[ord(text)]) if len(text) == 1 else self.ids.get(text)

    def pair(self, a, b):
        return a * np.int64(len(self.kinds) + CHARACTERS) + b

    def look(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places of pairs of symbols in `pairs`; the last one for pairs that form no piece."""
        key = self.pair(a, b)
        at = np.searchsorted(self.pairs, key)
        return np.where(self.pairs[at] == key, at, len(self.made) - 1)

    def merge_together(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all stretches, how many each has): one merge in each at a time, its first pair in order, the
        leftmost of equals."""
        sizes = np.array([len(s) for s in stretches])
        owner = np.arange(len(stretches))
        symbols = self.symbols[np.frombuffer("".join(stretches).encode("utf-32-le"), "<u4")]
        last = len(self.made) - 1
        ends = np.cumsum(sizes)
        pairs = np.append(self.look(symbols[:-1], symbols[1:]), last)
        pairs[ends - 1] = last
        agenda = self.order[pairs]
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(sizes):
            best = np.minimum.reduceat(agenda, ends - sizes)
            open_ = best != NEVER
            keep = np.repeat(open_, sizes)
            if not open_.all():
                done.append((owner[~open_], sizes[~open_], symbols[~keep]))
                owner, sizes, best = owner[open_], sizes[open_], best[open_]
                symbols, pairs, agenda = symbols[keep], pairs[keep], agenda[keep]
                ends = np.cumsum(sizes)
            if not len(sizes):
                break
            at = np.flatnonzero(agenda == np.repeat(best, sizes))
            of = np.searchsorted(ends, at, "right")
            at = at[np.append(True, of[1:] != of[:-1])]
            symbols[at] = self.made[pairs[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, pairs, agenda = symbols[keep], pairs[keep], agenda[keep]
            sizes = sizes - 1
            ends = np.cumsum(sizes)
            at = at - np.arange(len(at))
            for left, ok in ((at - 1, at > ends - sizes), (at, at < ends - 1)):
                some = left[ok]
                pairs[some] = self.look(symbols[some], symbols[some + 1])
                agenda[some] = self.order[pairs[some]]
            over = at[at == ends - 1]
            pairs[over], agenda[over] = last, NEVER
        owner, sizes, symbols = (np.concatenate(x) for x in zip(*done))
        order, begins = np.argsort(owner), np.cumsum(sizes) - sizes
        sizes, begins = sizes[order], begins[order]
        ends = np.cumsum(sizes)
        symbols = symbols[np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1])]
        odd = np.flatnonzero(symbols >= len(self.kinds))
        if not len(odd):
            return symbols, sizes
        # Characters that are no piece become their bytes.
        spelled = [self.spelled([x]) for x in symbols[odd].tolist()]
        lengths = np.ones(len(symbols), np.int64)
        lengths[odd] = [len(x) for x in spelled]
        ids, upto = np.repeat(symbols, lengths), np.cumsum(lengths)
        for x, end in zip(spelled, upto[odd].tolist()):
            ids[end - len(x) : end] = x
        return ids, np.add.reduceat(lengths, ends - sizes)

    def spelled(self, symbols: list[int]) -> list[int]:
        """Symbols as ids; characters that are no piece as their bytes."""
        n = len(self.kinds)
        return [i for s in symbols for i in ([s] if s < n else [self.bytes[b] for b in chr(s - n).encode()])]

    def merged(self, stretch: str) -> list[str]:
        """Symbols that are left when no adjacent pair forms a piece."""
        scores, symbols, n = self.scores, list(stretch), len(stretch)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[float, int, int, str]] = []

        def put(a: int, b: int) -> None:
            joined = symbols[a] + symbols[b]
            if joined in scores:
                heapq.heappush(agenda, (-scores[joined], a, b, joined))

        for i in range(n - 1):
            put(i, i + 1)
        while agenda:
            _, a, b, joined = heapq.heappop(agenda)
            # A pair of which a symbol has been merged meanwhile is over.
            if not symbols[a] or not symbols[b] or right[a] != b or len(symbols[a]) + len(symbols[b]) != len(joined):
                continue
            symbols[a], symbols[b] = joined, ""
            right[a] = right[b]
            if right[a] < n:
                left[right[a]] = a
                put(a, right[a])
            if left[a] >= 0:
                put(left[a], a)
        return [s for s in symbols if s]

    def ids_of(self, stretch: str) -> list[int]:
        return self.spelled([self.symbol(s) for s in self.merged(stretch)])

    def learned(self, new: list[str]) -> bool:
        """Keep the ids of stretches that are not kept yet; whether there are long ones among them."""
        short, long = [s for s in new if len(s) <= KEPT_CHARS], [s for s in new if len(s) > KEPT_CHARS]
        parts = [self.merge_together(short[at : at + ROWS]) for at in range(0, len(short), ROWS)]
        for s in long:
            ids = self.ids_of(s)
            parts.append((np.array(ids, np.int32), np.array([len(ids)])))
        flat, sizes = (np.concatenate(x) for x in zip(*parts))
        self.known.update(zip(short + long, range(len(self.known), len(self.known) + len(new))))
        self.begins = np.concatenate([self.begins, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
        return bool(long)

    def encode_group(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end id; how many each has)."""
        stretches, upto_text = [], []
        for t in texts:
            stretches += self.stretches.findall((SPACE if self.first_space and t else "") + t.replace(" ", SPACE))
            upto_text.append(len(stretches))
        if len(self.known) > KEPT:
            self.forget()
        known, long = self.known, False
        found = list(map(known.get, stretches))
        unknown = [k for k, i in enumerate(found) if i is None]
        if unknown:
            new = [stretches[k] for k in unknown]
            long = self.learned(list(set(new)))
            for k, s in zip(unknown, new):
                found[k] = known[s]
        which = np.array(found, np.int64)
        sizes = self.sizes[which]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.repeat(self.begins[which] - upto[:-1], sizes) + np.arange(upto[-1])]
        ends = upto[upto_text]
        if long:
            self.forget()
        return np.insert(ids, ends, self.end), np.diff(ends, prepend=0) + 1

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts, each with the end id."""
        out = []
        for group in groups(texts, len):
            ids, counts = self.encode_group(group)
            ends, ids = np.cumsum(counts).tolist(), ids.tolist()
            out += [ids[a:b] for a, b in zip([0, *ends], ends)]
        return out

    def decode_group(self, ids: np.ndarray, counts: np.ndarray) -> list[str | None]:
        """Texts of lists of ids, which follow one another in `ids`."""
        ends = np.cumsum(counts)
        if not len(ids) or ids.min() < 0 or ids.max() >= len(self.kinds):
            return [self.decode(ids[a:b].tolist()) for a, b in zip(ends - counts, ends)]
        # Surfaces are copied byte by byte from where they begin.
        upto = np.concatenate([[0], np.cumsum(self.lengths[ids])])
        data = self.letters[np.repeat(self.places[ids] - upto[:-1], self.lengths[ids]) + np.arange(upto[-1])].tobytes()
        control = np.concatenate([[0], np.cumsum(self.is_control[ids])])
        inside = (control[np.maximum(ends - 1, ends - counts)] > control[ends - counts]).tolist()
        cuts, out = upto[ends].tolist(), []
        for a, b, begin, end, parted in zip([0, *cuts], cuts, (ends - counts).tolist(), ends.tolist(), inside):
            first = ids[begin] if begin < end else self.end
            try:
                if parted:
                    raise UnicodeError
                text = data[a:b].decode()
                out.append(text[1:] if self.first_space and text[:1] == " " and self.kinds[first] == NORMAL else text)
            except UnicodeError:  # bytes that form no character, or control ids before the end
                out.append(self.decode(ids[begin:end].tolist()))
        return out

    def decode(self, ids: list[int]) -> str | None:
        """The text of ids; None if one is missing or not in the vocabulary."""
        if not all(i is not None and 0 <= i < len(self.kinds) for i in ids):
            return None
        parts = [self.surface[i] for i in ids]
        if self.first_space:
            first = next((k for k, i in enumerate(ids) if self.kinds[i] != CONTROL), None)
            if first is not None and self.kinds[ids[first]] == NORMAL and parts[first].startswith(b" "):
                parts[first] = parts[first][1:]
        # Control ids part bytes; bytes that form no character become one replacement character each.
        cuts = [k for k, i in enumerate(ids) if i in self.controls]
        return "".join(
            b"".join(parts[a:b]).decode("utf-8", "chatterlens_each_byte") for a, b in zip([0, *cuts], [*cuts, len(ids)])
        )


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("chatterlens_each_byte", _each_byte)


def groups(items: list, size: Callable[[object], int]) -> Iterator[list]:
    """Neighbouring items of some GROUP in size; a larger one is alone."""
    held, total = [], 0
    for item in items:
        if held and total + size(item) > GROUP:
            yield held
            held, total = [], 0
        held.append(item)
        total += size(item)
    if held:
        yield held


@functools.lru_cache(maxsize=2)
def vocabulary(model: bytes) -> Vocabulary:
    """One a worker and model."""
    return Vocabulary(model)


def read_model(path: str) -> bytes:
    """The model file, read by the driver; tasks get its bytes, some hundred KB."""
    with open(path, "rb") as file:
        model = file.read()
    vocabulary(model)
    return model


def encode(docs: DataFrame, model: bytes, text: str = "text", check: bool = True, decoded: bool = False) -> DataFrame:
    """All columns of `docs`, `ids` (with the end id) and `agrees`: whether the library gives the same ids, null
    without `check`. With `decoded` also what `decode` makes of the ids, in the same pass. Null texts count as empty
    and have the end id alone. Rows are encoded one by one; columns named as the results give way."""
    results = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("agrees", T.BooleanType())])
    if decoded:
        results = results.add("decoded", T.StringType())
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def one_group(words: Vocabulary, texts: list[str]) -> pa.StructArray:
        ids, counts = words.encode_group(texts)
        ends = np.concatenate([[0], np.cumsum(counts)])
        same: list[bool | None] = [None] * len(texts)
        if check:
            mine, theirs = ids.tolist(), words.library.encode(texts, add_eos=True, num_threads=1)
            same = [mine[a:b] == x for a, b, x in zip(ends[:-1].tolist(), ends[1:].tolist(), theirs)]
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
        columns = [lists, pa.array(same, pa.bool_())]
        if decoded:
            columns.append(pa.array(words.decode_group(ids, counts), pa.string()))
        return pa.StructArray.from_arrays(columns, names=results.names)

    def work(given: pa.Array) -> pa.Array:
        words = vocabulary(shared.value)
        # Lengths in bytes bound those in characters; a group's texts alone are Python objects.
        parts = [
            one_group(words, given.slice(at[0], len(at)).to_pylist())
            for at in groups(list(range(len(given))), pc.binary_length(given).to_pylist().__getitem__)
        ]
        return pa.concat_arrays(parts) if parts else one_group(words, [])

    return with_results(docs, F.coalesce(column(text).cast("string"), F.lit("")), results, work)


def decode(rows: DataFrame, model: bytes, ids: Column | str = "ids") -> DataFrame:
    """All columns of `rows` and `decoded`: the text of `ids`, null where the list is null or holds a null or an id
    outside the vocabulary. A column named `decoded` gives way."""
    results = T.StructType([T.StructField("decoded", T.StringType())])
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def work(given: pa.Array) -> pa.Array:
        words = vocabulary(shared.value)
        out: list[str | None] = []
        lists = given.fill_null([])
        counts = lists.value_lengths().to_numpy().astype(np.int64)
        for at in groups(list(range(len(lists))), counts.tolist().__getitem__):
            ids = lists.slice(at[0], len(at)).flatten().fill_null(-1).to_numpy()
            out += words.decode_group(ids, counts[at[0] : at[-1] + 1])
        out = [x if ok else None for x, ok in zip(out, given.is_valid().to_pylist())]
        return pa.StructArray.from_arrays([pa.array(out, pa.string())], names=["decoded"])

    return with_results(rows, column(ids) if isinstance(ids, str) else ids, results, work)

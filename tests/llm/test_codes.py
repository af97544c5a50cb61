"""Vector codes, periodic runs and piece ids against plain Python, the library and SQL."""

import hashlib
import math
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import check_oracle
from chatterlens.llm import periodic_runs, piece_codec, queries, twins, vector_codes

from .conftest import messy_rows

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
MODEL = piece_codec.read_model(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.mark.parametrize("name", sorted(twins.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert check_oracle.compare(spark, check_oracle.connect(SF_DIR), name, SF_DIR) == ""


# Vector codes


def codes_model(rows, rounds=4):
    """(vec_id -> (code, error)), codebooks, all distances spelled out."""
    kept = [(i, v) for i, v, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ints = [(i, [math.floor(1024 * x) for x in v]) for i, v in kept]
    ints.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    books, out = [], [[i, "", 0] for i, _ in ints]
    for p in range(4):
        w = len(ints[0][1]) // 4
        parts = [v[p * w : (p + 1) * w] for _, v in ints]
        book = parts[:256]

        def near(part):
            return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

        for _ in range(rounds):
            members = {}
            for part in parts:
                members.setdefault(near(part)[1], []).append(part)
            book = [[sum(c) // len(members[k]) for c in zip(*members[k])] if k in members else e for k, e in enumerate(book)]
        books.append(book)
        for row, part in zip(out, parts):
            distance, k = near(part)
            row[1] += f"{k:02x}"
            row[2] += distance
    return sorted(map(tuple, out), key=repr), books


def vector_rows(seed, n=420, width=8):
    """Repeated parts, negative components, ties between entries, missing and odd values, ids given twice."""
    rng = random.Random(seed)
    pool = [[rng.randint(-4, 4) / 1024 for _ in range(width // 4)] for _ in range(30)]
    rows = [(i * 3, [x for _ in range(4) for x in rng.choice(pool)], rng.choice([None, 1, 2])) for i in range(n // 3)]
    rows += [(i, [rng.gauss(0, 0.01) for _ in range(width)], 3) for i in range(n)]
    rows += [(None, rows[0][1], None), (None, rows[1][1], 1), (7, None, 1), (8, [], 1), (9, [None] * width, 1)]
    rows += [(10, [math.nan] * width, 1), (11, [math.inf] + [0.0] * (width - 1), 2)]
    return [r for r in rows if r[1] != []]


SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("block", [vector_codes.BLOCK, 3])
def test_codes_equal_the_model(spark, monkeypatch, block):
    monkeypatch.setattr(vector_codes, "BLOCK", block)
    rows = vector_rows(1)
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(3)
    books = vector_codes.learn(vectors)
    want, model = codes_model(rows)
    assert books.tolist() == model
    coded = vector_codes.error_by(vector_codes.encode(vectors, books))
    got = coded.collect()
    assert sorted(((r.vec_id, "".join(f"{e:02x}" for e in r.entries), r.error) for r in got), key=repr) == want
    sums = {}
    for r in got:
        sums[r.label] = sums.get(r.label, 0) + r.error
    assert all(r.label_error == sums[r.label] for r in got)
    assert vector_codes.digest(books) == hashlib.sha256(",".join(str(x) for b in model for e in b for x in e).encode()).hexdigest()


def test_few_equal_and_no_vectors(spark):
    same = spark.createDataFrame([(i, [0.5, 0.5, -0.5, 0.25], 1) for i in range(5)], SCHEMA)
    books = vector_codes.learn(same)
    assert books.shape == (4, 5, 1)
    assert {(tuple(r.entries), r.error) for r in vector_codes.encode(same, books).collect()} == {((0, 0, 0, 0), 0)}
    none = same.limit(0)
    books = vector_codes.learn(none)
    assert vector_codes.error_by(vector_codes.encode(none, books)).collect() == [] and vector_codes.digest(books)


def test_vectors_that_are_refused(spark):
    for vectors in ([[0.0] * 6], [[0.0] * 4, [0.0] * 8], [[1e12] * 4]):
        with pytest.raises(ValueError):
            vector_codes.learn(spark.createDataFrame([(i, v, 1) for i, v in enumerate(vectors)], SCHEMA))


def test_large_components_use_whole_numbers(spark):
    rows = [(i, [float((i * 7919 + j * 104729) % 1000003) for j in range(4)], i % 3) for i in range(300)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    books = vector_codes.learn(vectors)
    want, model = codes_model(rows)
    assert books.tolist() == model
    got = vector_codes.encode(vectors, books).collect()
    assert sorted(((r.vec_id, "".join(f"{e:02x}" for e in r.entries), r.error) for r in got), key=repr) == want


def test_clashing_vector_columns(spark):
    names = ("entries", "error", "label_error", "_", "c", "c0", "row", "made", "given", "position", "part", "n", "_label", "_sum", "_key", "_row")
    rows = spark.createDataFrame(vector_rows(2, 60), SCHEMA)
    books = vector_codes.learn(rows.withColumns({c: F.lit("taken") for c in names}))
    plain = vector_codes.error_by(vector_codes.encode(rows, books))
    crowded = vector_codes.error_by(vector_codes.encode(rows.withColumns({c: F.lit("taken") for c in names}), books))
    assert sorted(map(repr, crowded.select(plain.columns).collect())) == sorted(map(repr, plain.collect()))
    assert crowded.select("position").distinct().collect()[0][0] == "taken"


# Periodic runs


def runs_model(words):
    found, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in found.items())


def collapsed_model(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def by_period(runs):
    return sorted(runs, key=lambda r: (r[0], r[2]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 3), st.integers(1, 12)), max_size=6), min_size=1, max_size=5), st.integers(1, 5))
def test_runs_equal_the_model(spec, vocabulary):
    texts = []
    for parts in spec:
        words: list[bytes] = []
        for kind, n in parts:
            unit = [b"%d" % ((kind * 7 + i * i) % vocabulary) for i in range(kind + 1)]
            words += (unit * n)[: n * 2]
        texts.append(words)
    for words, got in zip(texts, periodic_runs.judged(texts)):
        runs = runs_model(words)
        assert [(r["start"], r["length"], r["period"]) for r in got["runs"]] == by_period(runs)
        assert got["collapsed"] == collapsed_model([w.decode() for w in words], runs)


@pytest.mark.parametrize("line", [periodic_runs.LINE, 50])
def test_runs_of_tables(spark, messy, repeated_rows, clashing, empty, monkeypatch, line):
    monkeypatch.setattr(periodic_runs, "LINE", line)
    loops = spark.createDataFrame(
        [(1, "a b " * 40 + "a a a a a a a"), (2, "x " * 5), (3, "x " * 6), (4, "a b c a b c a b c a b c"), (5, "a b c a b c a b c a b")],
        "doc_id long, text string",
    )
    for docs in (loops, messy, repeated_rows, clashing, empty):
        rows = periodic_runs.collapse(docs)
        assert set(docs.columns) < set(rows.columns)
        for r in rows.collect():
            words = [w.decode() for w in (r.text or "").encode().split()]
            if len(words) > 10_000:
                continue
            runs = runs_model(words)
            assert [tuple(x) for x in r.runs] == by_period(runs)
            assert r.collapsed == collapsed_model(words, runs)
        assert rows.count() == docs.count()


def test_long_loop(spark):
    rows = spark.createDataFrame([(1, "the end " * 30_000), (2, "x " * 60_000)], "doc_id long, text string")
    got = {r.doc_id: r for r in periodic_runs.collapse(rows).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 60_000, 2)] and got[1].collapsed == "the end"
    assert [tuple(x) for x in got[2].runs] == [(0, 60_000, 1)] and got[2].collapsed == "x"


def test_run_columns_give_way(messy):
    rows = periodic_runs.collapse(messy.withColumns({"runs": F.lit(1), "Collapsed": F.lit(2)}))
    assert [c.lower() for c in rows.columns].count("runs") == 1 and [c.lower() for c in rows.columns].count("collapsed") == 1
    assert rows.where("doc_id = 9").first().collapsed == "the end"


def test_planted_periods(repeated_rows):
    for r in queries.with_planted_periods(repeated_rows).join(repeated_rows.distinct().select(F.col("doc_id").alias("id"), F.col("text").alias("old")), F.col("doc_id").eqNullSafe(F.col("id"))).collect():
        h = zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode())
        if h % 10:
            continue
        words = [w.decode() for w in (r.old or "").encode().split()]
        if r.doc_id is None or r.doc_id == 10:
            continue
        n, g = len(words), h // 10
        if n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        assert (r.text or "").split(" ") == (words or [""])


# Pieces


def test_pieces_equal_the_library(messy, repeated_rows, clashing, empty):
    library = piece_codec.vocabulary(MODEL).library
    for docs in (messy, repeated_rows, clashing, empty):
        rows = piece_codec.encode(docs, MODEL, decoded=True)
        apart = piece_codec.decode(piece_codec.encode(docs, MODEL, check=False).drop("agrees"), MODEL)
        assert sorted(map(repr, apart.collect())) == sorted(map(repr, rows.drop("agrees").collect()))
        assert set(docs.columns) < set(rows.columns)
        for r in rows.collect():
            assert r.agrees and list(r.ids) == library.encode(r.text or "", add_eos=True) and r.decoded == library.decode(list(r.ids))
        assert rows.count() == docs.count()


odd = st.sampled_from([" ", "   ", "▁", "▁▁", "\n", "\t", "</s>", "<0x0A>", "<unk>", "é", "日本", "\x00", "the", " the", "x" * 70, "ing", "0", "12"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(odd, st.text(st.characters(exclude_categories=("Cs",)), max_size=8)), max_size=12))
def test_any_text(parts):
    words, text = piece_codec.vocabulary(MODEL), "".join(parts)
    ids = words.encode([text, text])[1]
    assert ids == words.library.encode(text, add_eos=True) and words.decode(ids) == words.library.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31_999)), max_size=12))
def test_any_ids(ids):
    words = piece_codec.vocabulary(MODEL)
    assert words.decode(ids) == words.library.decode(ids)


def test_long_and_short_stretches_take_the_same_merges():
    words = piece_codec.vocabulary(MODEL)
    for r in messy_rows():
        stretches = {s for s in words.stretches.findall((r[1] or "").replace(" ", "▁")) if len(s) <= piece_codec.KEPT_CHARS}
        if stretches:
            ids, sizes = words.merge_together(sorted(stretches))
            assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [words.ids_of(s) for s in sorted(stretches)]


def test_groups_of_lists_are_decoded_as_single_ones():
    words, rng = piece_codec.vocabulary(MODEL), random.Random(4)
    lists = [[rng.choice([rng.randrange(300), rng.randrange(32_000), 1, 2, 29871]) for _ in range(rng.randrange(9))] for _ in range(4000)]
    counts = np.array([len(x) for x in lists])
    got = words.decode_group(np.array([i for x in lists for i in x], np.int32), counts)
    assert got == [words.library.decode(x) for x in lists]


def test_kept_stretches_make_no_difference(monkeypatch):
    words, texts = piece_codec.vocabulary(MODEL), [r[1] or "" for r in messy_rows()]
    want = words.encode(texts)
    for name, value in (("KEPT", 0), ("GROUP", 10), ("ROWS", 2), ("KEPT_CHARS", 4)):
        monkeypatch.setattr(piece_codec, name, value)
        words.forget()
        assert words.encode(texts[:6] + texts[9:]) == want[:6] + want[9:]


def test_ids_that_have_no_text(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [5, None]), (4, [-1]), (5, [32_000]), (6, [2, 2])], "k int, ids array<int>")
    got = {r.k: r.decoded for r in piece_codec.decode(rows.withColumn("decoded", F.lit(1)), MODEL).collect()}
    assert got == {1: None, 2: "", 3: None, 4: None, 5: None, 6: ""}


def test_models_that_are_refused():
    with pytest.raises(Exception):
        piece_codec.Vocabulary(b"")
    broken = bytearray(MODEL)
    at = MODEL.rindex(b"\x18\x02\x20")  # model type 2 in the trainer's settings
    broken[at + 1] = 1
    with pytest.raises(ValueError):
        piece_codec.Vocabulary(bytes(broken))

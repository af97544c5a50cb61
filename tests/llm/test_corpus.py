"""Operators that compare documents or learn from them: repeats, near-duplicates, languages, quality, language model."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatterlens.llm import _repeats, language_mix, near_dedup, neighbour_votes, queries, seed_extend, suffix_dedup, suffix_tree_lm
from chatterlens.llm._tables import fold, numbered

from .conftest import prose

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def known(docs):
    """rid -> text, and rid of each row of numbered(docs)."""
    rows = numbered(docs.select("doc_id", "text")).collect()
    return {r.rid: bytes(r.text) for r in rows}, [(r.doc_id, r.rid) for r in rows]


def repeats_model(texts, length):
    """Mask per rid of the units under windows that start earlier too."""
    seen, out = set(), {}
    for rid in sorted(texts):
        units, gone = texts[rid], np.zeros(len(texts[rid]), bool)
        for s in range(len(units) - length + 1):
            key = tuple(units[s : s + length])
            if key in seen:
                gone[s : s + length] = True
            seen.add(key)
        out[rid] = gone
    return out


@pytest.fixture(scope="module")
def passages(spark):
    """Shared passages in other surroundings, overlapping repeats, periodic text, repeats inside one text."""
    rng = random.Random(5)
    shared = [prose(100 + i, 45) for i in range(4)]
    texts = []
    for i in range(40):
        parts = [prose(i, rng.randint(0, 60))]
        for p in rng.sample(shared, 2):
            words = p.split(" ")
            at = rng.randint(0, 20)
            parts += [" ".join(words[at : at + rng.randint(15, 30)]), prose(1000 + i, rng.randint(0, 9))]
        texts.append(" ".join(parts))
    texts += ["ab" * 400, "la " * 200, shared[0] + " " + shared[0], "a" * 99, "a" * 100, "a" * 101]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("wide", [_repeats.WIDE_BUCKET, 3])
def test_repeats_equal_the_model(passages, messy, repeated_rows, monkeypatch, wide):
    monkeypatch.setattr(_repeats, "WIDE_BUCKET", wide)
    for docs in (passages, messy, repeated_rows) if wide > 3 else (passages,):
        texts, rows = known(docs)
        ids = {}
        for doc_id, rid in rows:
            ids.setdefault(doc_id, []).append(rid)
        gone = repeats_model(texts, 100)
        want = sorted(str((d, len(texts[r]), int(gone[r].sum()), int((np.diff(np.concatenate([[False], gone[r]]).astype(int)) == 1).sum()),
                           bytes(np.frombuffer(texts[r], np.uint8)[~gone[r]]))) for d, r in rows)
        got = sorted(str((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))) for r in suffix_dedup.remove_repeated_bytes(docs).collect())
        assert got == want
        words = {r: t.split() for r, t in texts.items()}
        gone = repeats_model(words, 20)
        want = sorted(str((d, len(words[r]), int(gone[r].sum()), b" ".join(w for w, g in zip(words[r], gone[r]) if not g).decode())) for d, r in rows)
        rows_ = seed_extend.remove_repeated_passages(docs).collect()
        assert sorted(str((r.doc_id, r.n_words, r.n_removed, r.kept)) for r in rows_) == want
        assert all(sum(s.n for s in r.spans) == r.n_removed for r in rows_)


@pytest.mark.parametrize("wide", [_repeats.WIDE_BUCKET, 1])
def test_rows_given_twice_keep_first_occurrences(spark, monkeypatch, wide):
    """The repeated row comes first in order and shares a passage with texts of other surroundings."""
    monkeypatch.setattr(_repeats, "WIDE_BUCKET", wide)
    texts = [f"{prose(700 + i, 60)} {prose(70, 50)} {prose(710 + i, 60)}" for i in range(4)]
    docs = spark.createDataFrame([(0, texts[0])] * 3 + list(enumerate(texts)), "doc_id long, text string").repartition(3)
    texts, rows = known(docs)
    bytes_, words = repeats_model(texts, 100), repeats_model({r: t.split() for r, t in texts.items()}, 20)
    for got, gone in ((suffix_dedup.remove_repeated_bytes(docs), bytes_), (seed_extend.remove_repeated_passages(docs), words)):
        assert sorted((r.doc_id, r.n_removed) for r in got.collect()) == sorted((d, int(gone[r].sum())) for d, r in rows)


def test_long_texts_are_cut_into_pieces(passages, monkeypatch):
    want = sorted(tuple(r) for r in suffix_dedup.remove_repeated_bytes(passages).collect())
    texts = [bytes(r.text) for r in numbered(passages).orderBy("rid").collect()]
    laid = list(_repeats.lines(texts, suffix_dedup.units, 100))
    assert want and laid
    monkeypatch.setattr(_repeats, "LINE", 256)
    starts = sum(max(0, len(t) - 99) for t in texts)
    got = 0
    for line, text, offset, begins in _repeats.lines(texts, suffix_dedup.units, 100):
        _, _, lo, hi, piece = _repeats.runs_of(line, begins, 100, 16)
        got += int((hi - lo + 1).sum())
    assert got == starts


def components_model(texts, width, percent=80):
    sets = {}
    for rid, t in texts.items():
        w = [x for x in bytes(c + 32 if 65 <= c <= 90 else c for c in t).split()]
        sets[rid] = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    parent = {r: r for r in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in texts:
        for b in texts:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {r: (len(sets[r]), root(r)) for r in texts}


def edited(text, rng, n):
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def copies(spark):
    """Groups around the threshold: many members are similar to some of the group only."""
    rng = random.Random(11)
    texts = []
    for g in range(6):
        base = prose(300 + g, 200)
        texts += [edited(base, rng, rng.choice([0, 2, 4, 5, 6, 7, 8, 9])) for _ in range(25)]
    texts += [prose(500 + i, 80) + " " + prose(7, 60) for i in range(20)]
    rng.shuffle(texts)
    return spark.createDataFrame([(i * 3, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)


def test_near_duplicates_equal_the_model(copies, messy, repeated_rows):
    for docs, width in ((copies, 4), (copies, 5), (messy, 4), (repeated_rows, 5)):
        texts, rows = known(docs)
        want = components_model(texts, width)
        got = near_dedup.near_duplicates(docs, width).collect()
        assert sorted(r.rid for r in got) == sorted(rid for _, rid in rows)
        for r in got:
            assert (r.n_shingles, r.component) == want[r.rid]


def test_component_is_an_id(repeated_rows, spark, tmp_path):
    """Also where ids are missing or repeated and documents are told apart by rank."""
    base = prose(90, 200)
    more = [(400, base, "en", "a", 1), (300, base + " more", "en", "a", 1), (500, prose(91, 80), "en", "a", 1)]
    docs = repeated_rows.unionByName(spark.createDataFrame(more, repeated_rows.schema))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    texts, rows = known(docs)
    heads, ids = {r: c for r, (_, c) in components_model(texts, 4).items()}, {r: d for d, r in rows}
    got = queries.op10_signature_join(spark, str(tmp_path)).collect()
    assert sorted(map(str, ((r.doc_id, r.component_id, r.kept) for r in got))) == sorted(str((d, ids[heads[r]], heads[r] == r)) for d, r in rows)
    assert {r.doc_id: r.component_id for r in got if r.doc_id in (300, 400, 500)} == {300: 300, 400: 300, 500: 500}


def test_first_of_each(copies, clashing, repeated_rows, empty):
    for docs in (copies, clashing, repeated_rows, empty):
        texts, _ = known(docs)
        kept = near_dedup.first_of_each(docs)
        assert kept.columns == docs.columns
        assert kept.count() == sum(r == c for r, (_, c) in components_model(texts, 5).items())


def test_languages(spark, messy, repeated_rows, empty, clashing):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = language_mix.identify(docs).where(F.pmod(fold(docs), F.lit(3)) == 1).collect()
    assert np.mean([r.lang == r.language.lang_pred for r in rows]) > 0.95
    langs, model = language_mix.learn(docs)
    halves = [next(r.text for r in docs.where(F.col("lang") == v).where("n_chars > 1500").limit(1).collect()).encode()[:1500] for v in ("en", "de")]
    n = language_mix.trigrams(b" ".join(halves))
    at = np.flatnonzero(n)
    chosen, share = language_mix.mixture(model[:, at], n[at].astype(float))
    assert {langs[i] for i in chosen} == {"en", "de"} and abs(share[0] - 0.5) < 0.15 and abs(share.sum() - 1) < 1e-6
    for odd in (messy, repeated_rows, clashing, empty):
        for r in language_mix.identify(odd).collect():
            letters = any(map(str.isalpha, r.text or ""))
            assert (r.language.lang_pred == "und") == (not letters) and 0 <= r.language.score <= 1
    assert language_mix.identify(messy.withColumn("lang", F.lit(None).cast("string"))).where("language.lang_pred <> 'und'").count() == 0


def test_quality_votes(spark, messy, repeated_rows, empty, clashing):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = neighbour_votes.score(docs, labels).join(labels, "doc_id").where(F.pmod(fold(docs), F.lit(3)) == 1).collect()
    good, bad = ([r.quality_score for r in rows if r.quality == v] for v in (1, 0))
    assert np.mean([(g > b) + (g == b) / 2 for g in good for b in bad]) > 0.95
    for odd in (messy, repeated_rows, clashing, empty):
        marks = odd.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
        for table in (marks, marks.limit(0)):
            assert all(0 <= r.quality_score <= 1 for r in neighbour_votes.score(odd, table).collect())


def test_votes_are_exact():
    rng = np.random.default_rng(1)
    x = np.abs(rng.standard_normal((40, neighbour_votes.TERMS))).astype(np.float32)
    axes = rng.standard_normal((neighbour_votes.TERMS, 8)).astype(np.float32)
    idf = np.ones(neighbour_votes.HASHED, np.float32)
    vectors = neighbour_votes.unit(neighbour_votes.weighted(x[:30], idf) @ axes)
    model = {"idf": idf, "axes": axes, "vectors": vectors, "labels": (np.arange(30) % 2).astype(np.float32)}
    got = neighbour_votes.votes(x, model, 5)
    for row, score in zip(neighbour_votes.unit(neighbour_votes.weighted(x, idf) @ axes), got):
        near = sorted(((max(0, float(row @ v)) ** neighbour_votes.SHARPNESS, y) for v, y in zip(vectors, model["labels"])), reverse=True)[:5]
        assert abs(score - sum(w * y for w, y in near) / sum(w for w, _ in near)) < 1e-3


def tokens(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + [None]


def tree_model(texts, learn, depth):
    """Scores of all texts by a plain tree over the training texts."""
    lines = [["<end>"] + ["<end>" if t is None else t + " " for t in tokens(text)] for text in texts]
    counts, after = Counter(), {}
    for line, learns in zip(lines, learn):
        for i in range(1, len(line)) if learns else ():
            for d in range(min(i, depth) + 1):
                counts[tuple(line[i - d : i + 1])] += 1
                after.setdefault(tuple(line[i - d : i]), Counter())[line[i]] += 1
    seen = {s: sum(n.values()) for s, n in after.items()}
    total, size = seen.get((), 0), len(after.get((), ()))

    def chance(s, x):
        if not s:
            return (counts[(x,)] + 0.1) / (total + 0.1 * (size + 1))
        return (counts[(*s, x)] + suffix_tree_lm.PRIOR * chance(s[1:], x)) / (seen.get(s, 0) + suffix_tree_lm.PRIOR)

    kept = {()}
    for s in sorted(after, key=len):
        if s and s[1:] in kept and seen[s] >= suffix_tree_lm.LEAST:
            if sum(n * math.log(chance(s, x) / chance(s[1:], x)) for x, n in after[s].items()) >= suffix_tree_lm.DIVERGENCE:
                kept.add(s)
    out = []
    for line in lines:
        score = 0.0
        for i in range(1, len(line)):
            d = max(d for d in range(min(i, depth) + 1) if tuple(line[i - d : i]) in kept)
            score += math.log10(chance(tuple(line[i - d : i]), line[i]))
        out.append(score)
    return out, kept, total, size, counts


@pytest.mark.parametrize("pack_tokens", [suffix_tree_lm.PACK_TOKENS, 700])
def test_model_scores(spark, messy, repeated_rows, empty, clashing, monkeypatch, pack_tokens):
    monkeypatch.setattr(suffix_tree_lm, "PACK_TOKENS", pack_tokens)
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for docs, depth in ((given, 2), (given, 3), (repeated_rows, 2), (messy, 0), (clashing, 1), (empty, 2)):
        rows = docs.select("doc_id", "text").collect()
        learn = [zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 10 > 0 for r in rows]
        scores, kept, total, size, counts = tree_model([r.text for r in rows], learn, depth)
        want = []
        for r, score in zip(rows, scores):
            seen = [counts[("<end>" if t is None else t + " ",)] for t in tokens(r.text)]
            base = sum(math.log10((c + 0.1) / (total + 0.1 * (size + 1))) for c in seen)
            want.append((r.doc_id or -1, len(seen), sum(c > 0 for c in seen), total, base, score))
        got = suffix_tree_lm.scores(docs, F.pmod(fold(docs), F.lit(10)) != 0, depth).collect()
        got = sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
        assert len(got) == len(want)
        for a, b in zip(got, sorted(want)):
            assert a[:4] == b[:4] and np.allclose(a[4:], b[4:], rtol=1e-9, atol=1e-6)
        assert docs is not given or {len(s) for s in kept} == set(range(depth + 1))


def test_order_of_words_counts(spark):
    texts = ["the cat sat on the mat"] * 30 + ["a dog ran to a park"] * 30 + ["the cat sat on the mat", "mat the on sat cat the"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = {r.doc_id: r for r in suffix_tree_lm.scores(docs, F.col("doc_id") < 60).collect()}
    assert rows[60].base_score == pytest.approx(rows[61].base_score) and rows[60].score > rows[61].score + 5
    unlearnt = suffix_tree_lm.scores(docs, F.lit(None).cast("boolean")).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score == 0 for r in unlearnt) and len(unlearnt) == len(texts)


def test_a_context_spread_over_packs_is_tested_as_one(spark, monkeypatch):
    """No pack sees the hot context often enough; all together do."""
    monkeypatch.setattr(suffix_tree_lm, "PACK_TOKENS", 4)
    docs = spark.createDataFrame([(i, f"hot w{i % 3} {prose(i, 2)}") for i in range(200)], "doc_id long, text string").repartition(7)
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    want, kept, *_ = tree_model(texts, [True] * 200, 2)
    assert ("hot ",) in kept
    got = [r.score for r in suffix_tree_lm.scores(docs, F.lit(True)).orderBy("doc_id").collect()]
    assert np.allclose(got, want, atol=1e-6)


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF_DIR).checkpoint() if spark.sparkContext.getCheckpointDir() else stage(spark, kept, SF_DIR).cache()
        assert kept.columns == names, name
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in kept.collect())
    assert all(r.text == texts[r.doc_id] for r in rows) and max(Counter(r.doc_id for r in rows).values()) <= 3
    assert {(r.shard, r.slot) for r in rows} == {(i % 16, i // 16) for i in range(len(rows))}


def test_every_query_keeps_every_document(spark):
    for name, query in queries.queries().items():
        table, key = ("embeddings", "vec_id") if name.startswith("op11_") else ("documents", "doc_id")
        n = spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
        rows = query(spark, SF_DIR)
        assert rows.select(key).distinct().count() == rows.count() == n, name

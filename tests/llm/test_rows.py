"""Operators that judge, mix and place single documents: rules, decontamination, mixing, sharding."""

import hashlib
import os
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chatterlens.llm import decontaminate, language_mix, mixing, near_dedup, neighbour_votes, quality_rules, queries, sharding

from .conftest import CLASHING

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rule_model(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def test_rules_equal_the_model(messy, repeated_rows):
    for docs in (messy, repeated_rows):
        for r in quality_rules.compression_bands(docs).collect():
            x = r.rules
            assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) == rule_model(r.text)
            assert not (x.base_failed and x.kept)


def test_bands(spark):
    noise = "".join(chr(33 + int.from_bytes(hashlib.sha256(str(i).encode()).digest()[:2], "big") % 90) for i in range(6000))
    plain = " ".join(hashlib.md5(str(i % 700).encode()).hexdigest()[:5] for i in range(1500))
    loop = " ".join(f"line {i % 60} says the same thing again" for i in range(900))
    rows = spark.createDataFrame([(1, noise.replace("A", " ")), (2, plain), (3, loop)], "doc_id long, text string")
    got = {r.doc_id: r.rules for r in quality_rules.compression_bands(rows).collect()}
    assert not got[1].kept and not got[3].kept
    assert quality_rules.in_band(1000, 2.0) and not quality_rules.in_band(1000, 2.7) and not quality_rules.in_band(5000, 1.2)


def test_clean_labelled_documents_are_kept(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").join(spark.read.parquet(f"{SF_DIR}/labels.parquet"), "doc_id")
    rows = quality_rules.compression_bands(docs).where("not rules.base_failed").groupBy("quality").agg(F.avg(F.expr("cast(rules.kept as int)")).alias("kept")).collect()
    assert {r.quality: r.kept for r in rows}[1] == 1.0


def bench_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def contamination_model(text, items):
    words, hit, ids = bench_words(text), set(), set()
    for item_id, item in items:
        w = bench_words(item)
        size = min(13, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            for j in range(len(words) - size + 1):
                if words[j : j + size] == w[i : i + size]:
                    hit.update(range(j, j + size))
                    ids.add(str(item_id))
    return len(words), len(hit), sorted(ids)


ITEMS = [(1, "Zaba Deto mika"), (2, None), (3, ""), (10, "日本語 テキスト"), (4, " ".join(f"w{i}" for i in range(20))), (5, "one"), (5, "the end the end")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_contamination_equals_the_model(spark, block_bytes):
    texts = ["zaba, DETO. mika zaba deto mika", "x w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 y", " ".join(f"W{i}" for i in range(3, 16)),
             "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11", None, "", "the end the end the end", "日本語 テキスト次", "日本語-テキスト", "one", "zaba deto"] + ["far " * 300 + "one"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    for r in decontaminate.contamination(docs, bench, block_bytes=block_bytes).collect():
        n, hit, ids = contamination_model(r.text, ITEMS)
        assert (r.match.n_words, r.match.n_hit, r.match["items"]) == (n, hit, ids), r.text
        assert r.match.contaminated == (hit > 0 and 20 * hit >= n)


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_longest_matches_and_their_places(spark, block_bytes):
    """Matches longer than a window and shorter than a head, in every document that has them."""
    long = [f"p{i}" for i in range(400)]
    items = [(1, " ".join(["q1", *long, "q2"])), (2, "zaba deto mika olo " * 2 + " ".join(long[50:70])), (3, " ".join(f"w{i}" for i in range(20)))]
    texts = ["x y " + " ".join(long) + " z", " ".join(long[:30] + ["x"] + long[30:60]), "w17 w18 w19 x", "a w3 w4 w5 w6 b", "w3 w4 w5 w6 w7 c", "mika x deto mika", "w19", "x", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {str(i): bench_words(t) for i, t in items}
    for r in decontaminate.contamination(docs, bench, block_bytes=block_bytes).collect():
        words, want, places = bench_words(r.text), 0, []
        for item, w in found.items():
            for a in range(len(words)):
                for b in range(len(w)):
                    n = 0
                    while a + n < len(words) and b + n < len(w) and words[a + n] == w[b + n]:
                        n += 1
                    want = max(want, n)
                    if n >= 13 and not (a and b and words[a - 1] == w[b - 1]):
                        places.append((n, item, b, a))
        assert r.match.longest_match == want, r.text
        assert sorted(tuple(p) for p in r.match.places) == sorted(places)


def test_contamination_of_real_tables(spark):
    got = queries.op3_training_suffix_arrays(spark, SF_DIR).collect()
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    grams = {}
    for item_id, item in items:
        w = bench_words(item)
        for i in range(len(w) - 12):
            grams.setdefault(tuple(w[i : i + 13]), set()).add(str(item_id))
    assert sum(r.contaminated for r in got) > 0
    for r in got:
        w = bench_words(texts[r.doc_id])
        found = [(j, grams[g]) for j in range(len(w) - 12) if (g := tuple(w[j : j + 13])) in grams]
        hit = {p for j, _ in found for p in range(j, j + 13)}
        ids = sorted(set().union(*[s for _, s in found]))
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest())


def target_model(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * w[s] / sum(w[r] for r in rest) for s in rest}
        over = [s for s in rest if share[s] > 3 * sizes[s] + 1e-9]
        if not over:
            return capped | share
        capped |= {s: 3 * sizes[s] for s in over}


def check_mix(docs):
    rows, cut = mixing.mixed(docs)
    got = rows.collect()
    sizes = Counter()
    for r in docs.collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    goal = target_model(dict(sizes)) if got else {}
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - goal[r.source]) < 1e-6 * max(1, goal[r.source])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    assert len(got) == docs.count()
    return got, goal, taken, cut


def test_mix_of_real_tables(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got, goal, taken, cut = check_mix(docs)
    for s in goal:
        assert abs(taken[s] - goal[s]) <= max(5 * 32, 0.03 * goal[s])
    again = mixing.mixed(docs.repartition(5))[0].collect()
    assert sorted(tuple(r) for r in again) == sorted(tuple(r) for r in got)
    slots = cut.groupBy("slot").agg(F.sum("n_words").alias("n"), F.countDistinct("source").alias("sources")).collect()
    assert all(r.n <= 32 and r.sources == 1 for r in slots)


def test_mix_of_messy_rows(messy, repeated_rows, empty, clashing):
    for docs in (messy, repeated_rows, empty, clashing):
        check_mix(docs)
    assert mixing.repeated(clashing).columns == clashing.columns
    assert mixing.repeated(empty).count() == 0


def test_capped_source_reaches_its_cap(spark):
    docs = spark.createDataFrame([(i, "w " * 40, "big") for i in range(200)] + [(1000, "v " * 50, "a")], "doc_id long, text string, source string")
    got, goal, taken, _ = check_mix(docs)
    assert goal["a"] == 150 and abs(taken["a"] - 150) <= 64


def test_every_source_reaches_its_target(spark):
    """A source far below the grain of a slot, beside so many words that slots once grew with them."""
    docs = spark.range(2000).selectExpr("id doc_id", "repeat('w ', 40000) text", "'big' source").unionByName(
        spark.createDataFrame([(10_000 + i, "v " * n, s) for i, (s, n) in enumerate([("a", 5), ("b", 7), (None, 1)])], "doc_id long, text string, source string")
    )
    rows, cut = mixing.mixed(docs)
    got = {r.source: r for r in rows.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()}
    assert all(abs(r.taken - r.target) <= 0.5 for r in got.values()) and [got[s].taken for s in ("a", "b")] == [15, 21]
    most = cut.groupBy("slot").agg(F.sum("n_words").alias("n"), F.countDistinct(F.coalesce("source", F.lit("-"))).alias("sources"))
    assert most.where("n > 32 or sources > 1").count() == 0


def test_shards(spark, messy, repeated_rows, empty, clashing):
    for docs in (messy, repeated_rows, clashing, spark.read.parquet(f"{SF_DIR}/documents.parquet")):
        rows = sharding.shuffled(docs, bucket_bytes=1 << 16).collect()
        assert len(rows) == docs.count()
        by = {}
        for r in rows:
            by.setdefault(r.shard, []).append(r.slot)
        counts = [len(by.get(s, [])) for s in range(16)]
        assert max(counts) - min(counts) <= 1
        assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert sharding.shuffled(empty).count() == 0


def test_shuffle_agrees_with_itself_and_moves_rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    one = [tuple(r) for r in sharding.shuffled(docs, bucket_bytes=1 << 17).select("shard", "slot", "doc_id").orderBy("slot", "shard").collect()]
    two = [tuple(r) for r in sharding.shuffled(docs.repartition(5), bucket_bytes=1 << 17).select("shard", "slot", "doc_id").orderBy("slot", "shard").collect()]
    other = [tuple(r) for r in sharding.shuffled(docs, seed=8, bucket_bytes=1 << 17).select("shard", "slot", "doc_id").orderBy("slot", "shard").collect()]
    assert one == two != other
    ids = [r[2] for r in one]
    assert sum(abs(a - b) == 1 for a, b in zip(ids, ids[1:])) < len(ids) / 10


def test_shard_query_and_files(spark, tmp_path):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in queries.op9_two_pass_shuffle(spark, SF_DIR).collect():
        assert r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r["size"] == len(texts[r.doc_id].encode()) + 1
        assert r.grown_shard is None and r.law == "rows"
    rows = sharding.shuffled(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    sharding.write_shards(rows, str(tmp_path / "shards"), slots_per_file=5)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(r.doc_id for r in back.collect()) == sorted(texts)


def test_names_may_clash(clashing, spark, empty):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    for result, rows in (
        ("rules", quality_rules.compression_bands(clashing)),
        ("match", decontaminate.contamination(clashing, bench)),
        ("language", language_mix.identify(clashing)),
        ("quality_score", neighbour_votes.score(clashing, clashing.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")))),
    ):
        assert rows.columns == [*[c for c in clashing.columns if c != result], result] and rows.count() == clashing.count()
        assert {r.bucket for r in rows.collect()} == {"taken"} and rows.where(F.col(result).cast("string") == "taken").count() == 0
    for rows in (quality_rules.keep_in_band(clashing), decontaminate.remove_contaminated(clashing, bench), near_dedup.first_of_each(clashing), mixing.repeated(clashing)):
        assert rows.columns == clashing.columns and rows.count() and {r[c] for r in rows.collect() for c in CLASHING} == {"taken"}
    assert quality_rules.keep_in_band(empty).count() == decontaminate.remove_contaminated(empty, bench).count() == 0
    assert decontaminate.contamination(clashing, bench.limit(0)).where("match.n_hit > 0").count() == 0

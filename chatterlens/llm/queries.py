"""One registered query per operator, over whole tables, and SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterlens.llm import (
    decontaminate,
    language_mix,
    mixing,
    near_dedup,
    neighbour_votes,
    periodic_runs,
    piece_codec,
    quality_rules,
    seed_extend,
    sharding,
    suffix_dedup,
    suffix_tree_lm,
    twins,
    vector_codes,
)
from chatterlens.llm._tables import WORD, fold, ids_are_unique, read, store


def op1_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.compression_bands(docs).select(
        "doc_id",
        "rules.n_words",
        "rules.word_chars",
        "rules.n_symbols",
        "rules.n_dup_lines",
        "rules.n_repeat_words",
        "rules.base_failed",
        "rules.kept",
        "rules.zstd_ratio",
        "rules.bad_chunk_share",
    )


def op2_neighbour_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = neighbour_votes.score(docs, read(spark, sf_dir, "labels"))
    return rows.select(
        "doc_id",
        (F.pmod(fold(rows), F.lit(3)) == 1).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.5).cast("int").alias("predicted"),
    )


def op3_training_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = decontaminate.contamination(docs, read(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id",
        "match.n_words",
        "match.n_hit",
        F.size("match.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("match.items", ",").cast("binary"), 256).alias("items_sha256"),
        "match.contaminated",
        "match.longest_match",
    )


def op4_bucket_refinement(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeated_bytes(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op5_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = language_mix.identify(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return rows.select(
        "doc_id",
        (F.pmod(fold(rows), F.lit(3)) == 1).alias("held_out"),
        "language.lang_pred",
        "language.score",
        F.size("language.langs").alias("n_langs"),
    )


def op6_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return seed_extend.remove_repeated_passages(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


def op7_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = suffix_tree_lm.scores(docs, F.pmod(fold(docs), F.lit(10)) != 0)
    return rows.select(
        "doc_id",
        (F.pmod(fold(rows), F.lit(10)) == 0).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op8_source_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = mixing.mixed(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op9_two_pass_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shuffled(docs).select(
        "doc_id",
        sharding.byte_size().alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_signature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = near_dedup.near_duplicates(docs, width=4)
    component_id = F.col("component")
    if not ids_are_unique(docs):
        # Ranks stand for the documents: the component is the id of the document with its rank.
        rows = store(rows, "near")
        heads = rows.where("rid = component").select("component", F.col("doc_id").alias("head_id")).distinct()
        rows, component_id = rows.join(store(heads, "heads").hint("merge"), "component"), F.col("head_id")
    return rows.select(
        "doc_id",
        "n_shingles",
        component_id.alias("component_id"),
        (F.col("rid") == F.col("component")).alias("kept"),
    )


def op11_trie_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    books = vector_codes.learn(vectors)
    coded = store(vector_codes.encode(vectors, books).drop("embedding"), "codes")
    return vector_codes.error_by(coded).select(
        "vec_id",
        F.array_join(F.transform("entries", lambda e: F.lower(F.lpad(F.hex(e), 2, "0"))), "").alias("code"),
        "error",
        "label_error",
        F.lit(vector_codes.digest(books)).alias("codebooks_sha256"),
    )


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id, text: where crc32 of the id is divisible by 10, the words from one on repeat with a period."""
    h = fold(docs)
    g = F.expr("h div 10")

    def joined(words):
        n = F.size(words)
        a = F.when(n > 0, (g % n).cast("int")).otherwise(0)
        p = F.floor((n - a) / (3 + g % 8)).cast("int") + 1
        again = F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))
        return F.array_join(F.concat(F.slice(words, 1, a), F.slice(F.flatten(again), 1, n - a)), " ")

    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    planted = F.transform(F.array(words), joined)[0]
    return docs.withColumn("h", h).select("doc_id", F.when(F.col("h") % 10 == 0, planted).otherwise(F.col("text")).alias("text"))


def op12_branching_tandems(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    rows = periodic_runs.collapse(with_planted_periods(docs)).withColumn("best", best)
    start, length, period = -F.col("best.col2"), F.col("best.length"), -F.col("best.col3")
    told = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(told, lambda t: F.concat(t, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_piece_agenda(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = piece_codec.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = piece_codec.encode(docs, model, decoded=True)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        "agrees",
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_compression_bands,
            op2_neighbour_votes,
            op3_training_suffix_arrays,
            op4_bucket_refinement,
            op5_language_mixture,
            op6_seed_extend,
            op7_suffix_tree_scores,
            op8_source_schedule,
            op9_two_pass_shuffle,
            op10_signature_join,
            op11_trie_codes,
            op12_branching_tandems,
            op13_piece_agenda,
        )
    }


def oracle_sql() -> dict[str, str]:
    return twins.oracle_sql()

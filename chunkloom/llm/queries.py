"""The operators over their whole tables, with production parameters, as registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.llm import (
    conversation_tries,
    difference_cover,
    multi_index,
    odd_sketch,
    quality_rules,
    raking,
    rank_merging,
    sentence_rules,
    subword_lattice,
    suffix_arrays,
    token_planes,
    url_templates,
    warc,
)
from chunkloom.llm.common import table
from chunkloom.operators.storage import scratch_path


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_raked_mix(spark: SparkSession, folder: str) -> DataFrame:
    plan = raking.sampling_plan(table(spark, folder, "documents"))
    return plan.select("doc_id", "n_tokens", "topic", F.round("probability", 8).alias("probability"), "kept")


def op2_token_planes(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_planes.write_token_files(table(spark, folder, "documents"), path, tokenizer_path())
    return token_planes.document_digests(token_planes.token_files(spark, path))


def op3_subword_lattice(spark: SparkSession, folder: str) -> DataFrame:
    return subword_lattice.score_documents(
        table(spark, folder, "documents"), subword_lattice.held_out_seventh(), tokenizer_path("piece_bpe_32k.model")
    )


def op4_warc_chains(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    warc.write_archives(table(spark, folder, "pages"), path)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_odd_sketch(spark: SparkSession, folder: str) -> DataFrame:
    return odd_sketch.near_duplicates(table(spark, folder, "documents"), width=4, similarity=0.8)


def op6_suffix_arrays(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_arrays.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    measures = quality_rules.clean_lines(table(spark, folder, "documents"), with_text=False)
    return measures.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op8_url_templates(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_templates.judged_urls(table(spark, folder, "pages"), table(spark, folder, "labels"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "template", F.round("purity", 8).alias("purity"))


def op9_sentence_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = sentence_rules.scan_licences(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "n_sentences",
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licences", ",").alias("licences"),
        "kind",
    )


def op10_difference_cover(spark: SparkSession, folder: str) -> DataFrame:
    return difference_cover.remove_repeats(table(spark, folder, "documents"))


def op11_rank_merging(spark: SparkSession, folder: str) -> DataFrame:
    return rank_merging.token_counts(table(spark, folder, "documents"), tokenizer_path())


def op12_conversation_tries(spark: SparkSession, folder: str) -> DataFrame:
    found = conversation_tries.sequences(table(spark, folder, "conversations"))
    return conversation_tries.prefix_trie(conversation_tries.rebuilt(found)).drop("node")


def op13_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    rows = multi_index.scaled(table(spark, folder, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.withColumn("label", moved)
    return multi_index.hard_negatives(rows, rows.where("vec_id % 50 = 0"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_raked_mix": op1_raked_mix,
    "op2_token_planes": op2_token_planes,
    "op3_subword_lattice": op3_subword_lattice,
    "op4_warc_chains": op4_warc_chains,
    "op5_odd_sketch": op5_odd_sketch,
    "op6_suffix_arrays": op6_suffix_arrays,
    "op7_quality_rules": op7_quality_rules,
    "op8_url_templates": op8_url_templates,
    "op9_sentence_rules": op9_sentence_rules,
    "op10_difference_cover": op10_difference_cover,
    "op11_rank_merging": op11_rank_merging,
    "op12_conversation_tries": op12_conversation_tries,
    "op13_multi_index": op13_multi_index,
}

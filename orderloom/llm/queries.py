"""The registered queries of the operators, over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import chat, crf, hnsw, mixing, packing, pii, quality, repair, simhash, substrings, topk, trie, turns
from orderloom.llm.common import table
from orderloom.session import scratch_path


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.learn(docs, table(spark, folder, "labels"))
    score = F.col("score_")
    return quality.scored(docs.select("doc_id", "text"), model).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        score.alias("score"),
        (score >= quality.CUTOFF).cast("int").alias("predicted"),
    )


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, folder, "documents"), tokenizer_path())
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "tier",
        "step_group",
    )


def op3_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_products(table(spark, folder, "embeddings"))


def op4_chat_rotation(spark: SparkSession, folder: str) -> DataFrame:
    spans = F.transform("mask", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return chat.rotated(table(spark, folder, "conversations")).withColumn("mask", F.array_join(spans, ","))


def op5_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )


def op6_hnsw(spark: SparkSession, folder: str) -> DataFrame:
    return hnsw.nearest_neighbours(table(spark, folder, "embeddings"))


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(table(spark, folder, "documents"))

    def count(number: int, kind: str):
        # A second parameter of the lambda, even a default one, would be the place in the array.
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(number, kind) for number, kind in enumerate(pii.PATTERNS)),
        F.sha2(pii.listed("base").cast("binary"), 256).alias("base_sha256"),
        pii.listed("spans").alias("spans"),
    )


def op8_crf_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return crf.extract(table(spark, folder, "pages"))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = substrings.remove_repeats(table(spark, folder, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op11_repair(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "ids")
    repair.write(table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return repair.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(table(spark, folder, "conversations"))


def op13_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    return turns.digests(turns.repaired(turns.damaged(table(spark, folder, "conversations"))))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_packing": op2_packing,
    "op3_exact_topk": op3_exact_topk,
    "op4_chat_rotation": op4_chat_rotation,
    "op5_simhash_dedup": op5_simhash_dedup,
    "op6_hnsw": op6_hnsw,
    "op7_pii": op7_pii,
    "op8_crf_extraction": op8_crf_extraction,
    "op9_mixing": op9_mixing,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_repair": op11_repair,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_structure_repair": op13_structure_repair,
}

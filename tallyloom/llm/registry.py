"""Registered queries of the subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import bpe, chat, decontaminate, langid, licenses, merkle, mixing, runs, simhash, substrings, tokens, topk, toxicity
from tallyloom.llm.common import read_table

TOKEN_LIMIT = 2048


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(langid.learned_from()))
    held_out = F.coalesce(~langid.learned_from(), F.lit(False))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0, k=20)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("word_bpe_49k.json")
    return tokens.count_tokens(docs, path, TOKEN_LIMIT).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.leaks(docs, read_table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


#: Categories of the chain, in order: a text full of junk is judged before its tone is.
CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1"}


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), CATEGORIES)
    return toxicity.predict(docs, chain)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations")
    return chat.link(chat.as_tool_traffic(conversations), chat.REPLY)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    proofs = merkle.prove(merkle.build(docs, carry={"tampered": F.when(hit, merkle.tampered_leaf())}))
    folded = proofs.withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("steps")))
    return folded.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.proof_text(F.col("steps")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return encoded.select(
        "doc_id",
        bpe.token_count(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = runs.find_runs(docs.withColumn("text", runs.planted(F.col("doc_id"), F.col("text"))))
    longest = runs.longest(F.col("runs"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[longest[c].alias(c) for c in ("start", "length", "period")],
        longest["exponent_milli"].alias("exponent_milli"),
        F.sha2(runs.listing(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_exact_topk": op2_exact_topk,
    "op3_token_counts": op3_token_counts,
    "op4_decontamination": op4_decontamination,
    "op5_license_scan": op5_license_scan,
    "op6_toxicity": op6_toxicity,
    "op7_mixing": op7_mixing,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_bpe_roundtrip": op12_bpe_roundtrip,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE: dict[str, str] = {
    "op2_exact_topk": topk.ORACLE_SQL,
    "op5_license_scan": licenses.ORACLE_SQL,
    "op10_chat_formatting": chat.ORACLE_SQL,
    "op11_merkle_manifest": merkle.ORACLE_SQL,
}

"""One query per operator over its whole table, and the SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kalulu.llm.common import id_crc, read_table
from kalulu.llm.mixing import mix_sql
from kalulu.llm.source_audit import audit_sql


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kalulu.llm.lm_scoring import score_documents
    return score_documents(read_table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kalulu.llm.substring_dedup import substring_dedup
    done = substring_dedup(read_table(spark, sf_dir, "documents"), words=13)
    return done.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
        F.size("spans").cast("long").alias("n_spans"))


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kalulu.llm.simhash_dedup import simhash_components
    return simhash_components(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=2).select(
        "doc_id", "fingerprint", "component_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kalulu.llm.toxicity import FOLDS, learn, score_documents
    docs = read_table(spark, sf_dir, "documents")
    scored = score_documents(docs, learn(docs, read_table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", (id_crc() % FOLDS == 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kalulu.llm.decontamination import contaminated
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kalulu.llm.mixing import mix
    return mix(read_table(spark, sf_dir, "documents"))


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kalulu.llm.winnowing import compare_with_edits
    return compare_with_edits(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kalulu.llm.chat_format import expand, format_conversations, read_examples
    said = "\\### Assistant: </turn> ok"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return read_examples(expand(format_conversations(rows))).select(
        "conv_id", "n_turns", digest("turns").alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
        digest("loss_text").alias("loss_sha256"), "formatted_chars")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kalulu.llm.license_scan import fit, sample_lines, scan
    docs = read_table(spark, sf_dir, "documents")
    return scan(docs, fit(sample_lines(docs)))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kalulu.llm.suffix_dedup import suffix_dedup
    done = suffix_dedup(read_table(spark, sf_dir, "documents"), length=100)
    return done.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kalulu.llm.pii import KINDS, count_kind, find_pii, span_text
    found = find_pii(read_table(spark, sf_dir, "documents"))
    plain = F.transform("added", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    return found.select(
        "doc_id", *[count_kind(F.col("base"), k).alias(f"n_{k}") for k in KINDS],
        F.sha2(span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        span_text(F.sort_array(F.concat("base", plain))).alias("spans"), F.size("added").cast("long").alias("n_added"))


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kalulu.llm.source_audit import audit
    return audit(read_table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kalulu.llm.token_alignment import align
    found = align(read_table(spark, sf_dir, "documents"))
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_simhash_dedup": op3_simhash_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_decontamination": op5_decontamination,
    "op6_winnowing": op6_winnowing,
    "op7_source_mixing": op7_source_mixing,
    "op8_chat_format": op8_chat_format,
    "op9_license_scan": op9_license_scan,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_pii": op11_pii,
    "op12_source_audit": op12_source_audit,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE_SQL: dict[str, str] = {"op7_source_mixing": mix_sql(), "op12_source_audit": audit_sql()}

"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, decontaminate, fertility, fim, licenses, packing, secrets, sharding, simhash, spotsigs, tokenfiles, toxicity, urls
from .common import new_folder, read_table
from .oracle import ORACLE_SQL  # noqa: F401


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "passages")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spotsigs.fingerprint_documents(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), spotsigs.digest("sigs").alias("fingerprint"),
        spotsigs.digest("edited_sigs").alias("edited_fingerprint"),
        spotsigs.likeness("sigs", "edited_sigs").alias("near_edited"),
        spotsigs.likeness(spotsigs.hashes("sigs"), "next_sigs").alias("near_next"))


def op2_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.near_copies(read_table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = tokenfiles.write_token_files(read_table(spark, sf_dir, "documents"), new_folder(spark, "tokens"))
    return tokenfiles.read_token_files(manifest).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(read_table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(read_table(spark, sf_dir, "documents"))
    span = lambda m: F.concat_ws(":", m["license"], m["first"].cast("string"), m["end"].cast("string"),
                                 F.round(m["containment"], 4).cast("string"))
    return found.select("doc_id", F.size("matches").cast("bigint").alias("n_matches"),
                        licenses.names(F.col("matches")).alias("licenses"),
                        F.array_join(F.transform("matches", span), ",").alias("spans"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] != "random")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(secrets.joined(base), 256).alias("base_sha256"),
                        secrets.joined(F.col("spans")).alias("spans"))


def op11_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judge_documents(read_table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = fim.transform_documents(read_table(spark, sf_dir, "documents"))
    return fim.restore_documents(moved).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_filters(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_fingerprints": op2_fingerprints,
    "op2_near_copies": op2_near_copies,
    "op3_sharding": op3_sharding,
    "op4_token_files": op4_token_files,
    "op5_packing": op5_packing,
    "op6_decontamination": op6_decontamination,
    "op7_simhash": op7_simhash,
    "op8_url_filter": op8_url_filter,
    "op9_licenses": op9_licenses,
    "op10_secrets": op10_secrets,
    "op11_fertility": op11_fertility,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_filter_audit": op13_filter_audit,
}



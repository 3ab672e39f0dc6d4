"""Registered queries of this package: each takes (spark, sf_dir) and returns its full result."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm import (
    bpe,
    conversation_repair,
    decontaminate,
    fingerprints,
    jaccard_join,
    language,
    line_dedup,
    pii,
    quality_rules,
    spelling_variants,
    suffix_dedup,
    url_rules,
    warc,
)
from riskflow.llm.common import materialize, table
from riskflow.sources.scratch import scratch_path

VOCABULARY = "word_bpe_49k.json"


def op1_bpe(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    rows = bpe.encode(docs, public_tokenizers.path(VOCABULARY), decoded="decoded")
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op3_url_rules(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return url_rules.judge_urls(pages, pages.join(labels, "page_id")).drop("url")


def op4_pii(spark: SparkSession, sf: str) -> DataFrame:
    rows = pii.find_pii(table(spark, sf, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return rows.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(F.concat("base", "learned")).alias("spans"),
    )


def op5_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = language.train(docs)
    return language.identify(docs.select("doc_id", "text", language.held_out().alias("held_out")), model).drop("text")


def op6_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = suffix_dedup.remove_repeats(table(spark, sf, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_warc(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    warc.write_archives(warc.archive_records(table(spark, sf, "pages")), path)
    number = lambda c: F.regexp_extract(c, "^<urn:page:(.*)>$", 1).try_cast("long")
    response = F.col("type") == "response"
    return warc.read_records(spark, path).select(
        number("record_id").alias("page_id"),
        F.when(response, F.col("payload_size")).otherwise(F.col("http_length")).alias("payload_bytes"),
        F.when(response, warc.base32(F.col("payload_sha1"))).otherwise(F.col("declared_digest")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        number("refers_to").alias("refers_to"),
    )


def op9_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op10_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf, "documents"))


def op8_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.similar_documents(table(spark, sf, "documents"))


def op11_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    found = spelling_variants.runs(table(spark, sf, "documents"), spelling_variants.MIN_LENGTH)
    return spelling_variants.group_variants(spelling_variants.counted_words(spelling_variants.misspelled(found)))


def op12_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations")
    report = conversation_repair.repair_report(conversation_repair.repair(conversation_repair.damaged(rows)))
    every = rows.select(F.col("conv_id").alias("_id")).distinct()
    found = every.join(report, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    numbers = ["gaps", *conversation_repair.COUNTS, "cost"]
    return found.select(
        F.col("_id").alias("conv_id"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    stored = materialize(quality_rules.ledger(table(spark, sf, "documents")), "ledger")
    base = F.col("failures").bitwiseAND(F.lit(quality_rules.BASE)) != 0
    return quality_rules.apply_policy(stored).select(
        "doc_id",
        *["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"],
        base.alias("base_failed"),
        "kept",
        "failures",
    )


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_line_dedup": op2_line_dedup,
    "op3_url_rules": op3_url_rules,
    "op4_pii": op4_pii,
    "op5_language": op5_language,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_warc": op7_warc,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_decontaminate": op9_decontaminate,
    "op10_fingerprints": op10_fingerprints,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_quality_rules": op13_quality_rules,
}

"""The queries over the text tables, each with its SQL counterpart (None: checked by brute force in tests/llm)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    conversation_repair, decontamination, extraction, filter_audit, jaccard_join, licenses, line_dedup, quality, sentencepiece_codec,
    suffix_dedup, token_counts, url_filter, warc,
)
from .common import table


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    return sentencepiece_codec.encode(
        table(spark, sf_dir, "documents"), model, outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict on every document."""
    labels = table(spark, sf_dir, "labels").selectExpr("doc_id as id", "quality = 1 as good")
    return quality.quality_verdicts(table(spark, sf_dir, "documents"), labels)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage, with the item and the place."""
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_key")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, places and labels of license wording in every document."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extraction.extract(table(spark, sf_dir, "pages"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document without the bytes that are repeated anywhere."""
    return suffix_dedup.digests(suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document after line dedup: its lines, the removed ones and a digest of what is left."""
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars"), F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents")).drop("row_key", "component_key")


def op10_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metadata and a conversion record of every page's response."""
    return warc.summary(warc.derive(warc.responses(table(spark, sf_dir, "pages"))))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes from every part, in every order."""
    labels = table(spark, sf_dir, "labels").selectExpr("doc_id as id", "quality = 1 as good", "toxic = 1 as toxic")
    return filter_audit.audit(table(spark, sf_dir, "documents"), labels)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and repaired text's digest of every conversation, after a fixed damage."""
    return conversation_repair.repair_conversations(table(spark, sf_dir, "conversations"), conversation_repair.damage_key())


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), model)


QUERIES = {
    "op1_sentencepiece": (op1_sentencepiece, None),
    "op2_quality_rules": (op2_quality_rules, quality.sql()),
    "op3_url_filter": (op3_url_filter, None),
    "op4_decontamination": (op4_decontamination, None),
    "op5_license_scan": (op5_license_scan, licenses.sql()),
    "op6_html_extraction": (op6_html_extraction, None),
    "op7_suffix_dedup": (op7_suffix_dedup, None),
    "op8_line_dedup": (op8_line_dedup, None),
    "op9_jaccard_join": (op9_jaccard_join, None),
    "op10_warc_derivatives": (op10_warc_derivatives, None),
    "op11_filter_audit": (op11_filter_audit, filter_audit.sql()),
    "op12_conversation_repair": (op12_conversation_repair, None),
    "op13_token_counts": (op13_token_counts, None),
}

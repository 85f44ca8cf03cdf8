"""Corpus pipeline: from raw documents to token digests of what is worth training on.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last return the
columns of ``documents``; run() applies them one after another, each written to the shared folder and read again.

1. quality rules: documents that the base rules or a risk-controlled cutoff reject go.
2. line dedup: runs of lines (50 words or more) that stood in an earlier document are deleted; ``n_chars`` follows the text,
   and a document of which nothing is left goes.
3. n-gram Jaccard join: of documents linked by a similarity of 0.8 on five-word shingles the one with the smallest id stays.
4. benchmark decontamination: documents that hold a passage of ``benchmark`` go.
5. SentencePiece: number of tokens and digests of ids and decoded text.

Null texts and ids, empty tables and repeated rows are handled as the operators state; equal rows stay or go together, except that stage 3 keeps one of each
group, and rows without any word (their sets are empty) are never linked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from incidentlake.llm import decontamination, jaccard_join, line_dedup, quality, sentencepiece_codec
from incidentlake.llm.common import table
from incidentlake.session import scratch_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").selectExpr("doc_id as id", "quality = 1 as good")
    return quality.keep_good(docs, labels).select(*COLUMNS)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(docs.select(*COLUMNS))
    changed = F.col("n_removed") > 0
    return done.filter(~changed | F.col("text").rlike(r"\S")).withColumn(
        "n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs.select(*COLUMNS), words=5, num=80, den=100)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    return sentencepiece_codec.encode(docs, model, outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("jaccard_join", jaccard_stage),
    ("decontamination", decontamination_stage),
    ("sentencepiece", sentencepiece_stage),
]
#: SQL has no winnowing, latent space or merges: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

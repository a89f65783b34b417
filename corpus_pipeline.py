"""Corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; run() writes every result to the shared folder as Parquet and reads it
back as the next stage's docs. All stages but the last return the columns of
documents. Rows without a doc_id cannot be followed through the stages and go
in the first one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.llm.common import scratch_path, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the evidence settles on. The rest (no letters, or
    none of the known languages probable enough) goes. Only the rejected ids
    meet the texts: few, and broadcast where their written table is small."""
    from barforge.llm.queries import languages_of
    found = languages_of(spark, docs, sf_dir).groupBy("doc_id").agg(F.max("kept").alias("kept"))
    rejected = written(found.where(~F.col("kept")).select("doc_id"), "pipeline-rejected")
    return docs.where(F.col("doc_id").isNotNull()).join(rejected, "doc_id", "left_anti").select(*COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest
    doc_id. Ids that occur in several rows keep one of them; only those rows
    are shuffled for it."""
    from barforge.llm.simhash import near_duplicates
    found = near_duplicates(docs, shingle=3, max_bits=2).groupBy("doc_id").agg(
        F.max(F.col("doc_id") == F.col("component_id")).alias("first"), F.count(F.lit(1)).alias("n"))
    found = written(found.where(~F.col("first") | (F.col("n") > 1)), "pipeline-copies")
    once = docs.where(F.col("doc_id").isNotNull()).join(found.select("doc_id"), "doc_id", "left_anti")
    again = docs.join(found.where(F.col("first") & (F.col("n") > 1)).select("doc_id"), "doc_id", "left_semi")
    return once.select(*COLUMNS).union(again.select(*COLUMNS).dropDuplicates(["doc_id"]))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    from barforge.llm.decontaminate import contaminated
    hit = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = written(hit.select("doc_id").distinct(), "pipeline-contaminated")
    return docs.join(hit, "doc_id", "left_anti").select(*COLUMNS)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows."""
    from barforge.llm.pii import redact
    return redact(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token piece of every document with its sequence and offset."""
    import public_tokenizers

    from barforge.llm.packing import pack, token_pieces
    return pack(token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=False))


STAGES: list[tuple[str, Callable]] = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii", pii),
    ("best_fit_packing", best_fit_packing),
]

#: SQL cannot express the stages (XXH64 fingerprints, trained models, a
#: tokenizer); tests/llm holds run() against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

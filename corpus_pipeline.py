"""The corpus pipeline: quality model, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.  All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkledger.llm import common, minhash, packing, quality_lm, substring

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: What a row that goes takes in a broadcast table; texts are shuffled to meet those rows only if these are too many.
GONE_BYTES = 32


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts whose perplexity lies outside the quantiles of trusted text of their language."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = quality_lm.classify(docs, labels, keep_cols=("text", "lang", "source", "n_chars"))
    return judged.where("accepted").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near-duplicates; rows that share an id fare each by its own text."""
    gone = minhash.near_duplicates(docs).where("not kept").select("doc_id", "text_hash").distinct()
    gone = common.materialize(gone, "gone")
    few = gone.count() * GONE_BYTES <= quality_lm.BROADCAST_BYTES
    keyed = docs.withColumn("text_hash", F.xxhash64("text"))
    return keyed.join(F.broadcast(gone) if few else gone.hint("merge"), ["doc_id", "text_hash"], "left_anti").select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 20 words and more that also start earlier; texts of which nothing is left go."""
    marked = substring.mark_repeats(docs, keep_cols=("lang", "source"), as_text="spans")
    left = marked.where("n_removed = 0 or n_removed < n_words")
    return left.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths with their ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality classifier", quality), ("MinHash near-dedup", near_duplicates), ("substring dedup", repeated_passages), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = common.materialize(docs, f"stage-{number}")
    return docs

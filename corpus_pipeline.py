"""From raw documents to training tokens, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written before the next
stage reads it. ``sf_dir`` holds the further tables that a stage needs.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custoria.llm import decontaminate, linededup, quality, sentencepiece, simhash
from custoria.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOKENIZER = "piece_bpe_32k.model"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose likelihood ratio reaches the fitted threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep(docs.select(COLUMNS), quality.fit(docs, labels))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the runs of lines that stand earlier in the corpus."""
    found = linededup.dedup_lines(docs)
    chars = F.when(F.col("lines_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", chars).select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near-duplicates."""
    return simhash.keep_first(docs).select(COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is test text; they stay as they are."""
    found = decontaminate.find(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(~decontaminate.contaminated()).select(COLUMNS)


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its piece ids, their byte spans, and whether the ids decode to the text."""
    coded = sentencepiece.encode(docs, public_tokenizers.path(TOKENIZER), decoded=True)
    return coded.select(
        *COLUMNS, "piece_ids", "piece_begins", "piece_ends", F.size("piece_ids").cast("long").alias("n_tokens"), F.col("decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("round_trip")
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("sentencepiece encoding", piece_encoding),
]

#: Fitted ratios, XXH64 fingerprints and merges have no form in SQL; the tests state each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is stored for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""A training-data pipeline of five operators over the documents table; each stage reads what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxtally.llm import mixing, quality_rules, segmentation, simhash, suffix_dedup
from rxtally.llm.queries import good_ids, table, tokenizer
from rxtally.llm.storage import shared_folder, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.judged(docs, good_ids(spark, sf_dir), *COLUMNS).filter("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of fingerprints of three-word shingles that link at two or fewer differing bits."""
    return simhash.first_of_each_class(docs, budget=2, width=3).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document with a smaller doc_id has; n_chars counts what is left."""
    kept = suffix_dedup.deduplicated(docs, "doc_id", "lang", "source", result="kept_text")
    text = F.col("kept_text")
    return kept.select("doc_id", text.alias("text"), "lang", "source", F.char_length(text).cast("long").alias("n_chars"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    taken = mixing.mixed(docs, *COLUMNS[:3], "n_chars")
    copies = taken.filter("reps > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("reps").cast("int"))))
    return copies.select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every document."""
    found = segmentation.sampled(docs, tokenizer(), "doc_id", "source", k=2)
    return found.select("doc_id", "source", "rank", "ids", "log_prob", "log_inclusion", "round_trip")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("source_mixing", mixture),
    ("sentencepiece_encoding", encoded),
]

# Hashes of shingles, suffixes and seeded draws have no SQL of their own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is stored before the next one reads it."""
    docs, folder = table(spark, sf_dir, "documents"), shared_folder(spark)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

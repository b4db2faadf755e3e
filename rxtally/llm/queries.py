"""One query for each operator, over the whole of its table; digest columns come from the operators' rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxtally.llm import (
    collocations,
    html_text,
    language_model,
    mixing,
    nearest,
    periodic_runs,
    personal_data,
    quality_classifier,
    quality_rules,
    segmentation,
    simhash,
    suffix_dedup,
    token_counts,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer(name: str = "piece_bpe_32k.model") -> str:
    """The path of a public tokenizer's file, which every machine has with its package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def good_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of documents labelled good and not toxic: the trusted target of the quality rules."""
    return table(spark, folder, "labels").filter("quality = 1 and toxic = 0").select("doc_id")


def op1_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.held_out_scores(table(spark, folder, "documents"))


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.classes(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.mixed(table(spark, folder, "documents"), "doc_id")
    return mix.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("reps")).alias("taken"))


def op4_segmentation(spark: SparkSession, folder: str) -> DataFrame:
    """Two sampled segmentations of every document, and the text that each one's pieces decode to; ``round_trip``: it is
    the document's."""
    found = segmentation.sampled(table(spark, folder, "documents"), tokenizer(), "doc_id", k=2)
    pieces = F.size("ids").cast("long").alias("n_pieces")
    marks = F.xxhash64("ids").alias("ids_hash")
    columns = ["doc_id", "rank", "n_pieces", "ids_hash", "log_prob", "log_inclusion", "round_trip"]
    texts = segmentation.decoded(found.select("*", pieces, marks), tokenizer(), *columns)
    return texts.select(*columns, F.sha2("text", 256).alias("text_sha256"))


def op5_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.nearest(table(spark, folder, "embeddings"))


def op6_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extracted(table(spark, folder, "pages"), "page_id", "url")


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.held_out_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.deduplicated(table(spark, folder, "documents"), "doc_id")
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judged(table(spark, folder, "documents"), good_ids(spark, folder), "doc_id")


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.counted(table(spark, folder, "documents"), tokenizer())


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.digests(table(spark, folder, "documents"))


def op12_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data.digests(table(spark, folder, "documents"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_model": op1_language_model,
    "op2_simhash": op2_simhash,
    "op3_mixing": op3_mixing,
    "op4_segmentation": op4_segmentation,
    "op5_nearest": op5_nearest,
    "op6_html_text": op6_html_text,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_token_counts": op10_token_counts,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_personal_data": op12_personal_data,
    "op13_collocations": op13_collocations,
}

ORACLE: dict[str, str] = {"op13_collocations": collocations.ORACLE}

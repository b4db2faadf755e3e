"""Bradley-Terry ranking: held-out accuracy, whole scoring and edge rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rxtally.llm import quality_classifier as qc


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = qc.held_out_scores(documents, labels)
    assert found.count() == documents.count()
    held = found.filter("held_out").join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in held]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in held)


def test_labels_of_held_out_rows_are_not_read(spark):
    folder = "/root/testdata/sf0.001"
    documents, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    other = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    rows = [sorted(tuple(r) for r in qc.held_out_scores(documents, x).collect()) for x in (labels, other)]
    assert rows[0] == rows[1]


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "word " * 30_000), (None, "x"), (2, ""), (4, "!!!! ####"), (5, "A plain line.")]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(5, 1), (4, 0), (None, 1), (1, None), (2, 7)], "doc_id bigint, quality int")
    found = qc.held_out_scores(documents, labels).collect()
    assert len(found) == len(rows) and all(r["score"] is not None for r in found)
    none = qc.held_out_scores(documents, labels.limit(0)).collect()
    assert {round(r["score"], 9) for r in none} == {qc.CUT} and {r["predicted"] for r in none} <= {0, 1}
    assert qc.held_out_scores(documents.limit(0), labels).collect() == []


def test_fit_orders_pairs():
    draw = np.random.default_rng(1)
    quality = (draw.random(400) < 0.7).astype(int)
    rows = draw.normal(size=(400, 5)) + quality[:, None] * np.array([3, 0, 0, 1, 0])
    ranking = qc.fit(rows, quality)
    assert np.mean((ranking.scores(rows) >= qc.CUT) == quality) > 0.9  # the best possible is 0.945


def test_repeated_rows_and_ties(spark):
    """A labelled document that stands in the table many times teaches once; equal good and bad ones teach nothing."""
    texts = [(k, f"good words of a text number {k} here" if k % 2 else f"BAD!!! {k} {k} {k} ###") for k in range(1, 41)]
    labels = spark.createDataFrame([(k, k % 2) for k, _ in texts], "doc_id bigint, quality int")
    shape = "doc_id bigint, text string"
    once = qc.learn(spark.createDataFrame(texts, shape), labels)
    often = qc.learn(spark.createDataFrame(texts + texts[:1] * 500, shape), labels)
    assert (once.weights == often.weights).all() and once.cut == often.cut
    same = spark.createDataFrame([(k, "the same text") for k in range(20)], shape)
    tied = qc.learn(same, labels)
    assert not tied.weights.any()
    assert [r["score"] for r in qc.scored(same, tied, "doc_id").collect()] == pytest.approx([qc.CUT] * 20)

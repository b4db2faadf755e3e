"""Every stage of the pipeline against plain Python over what the stage before kept."""

import corpus_pipeline
from pyspark.sql import functions as F
from test_mixing import brute_mix
from test_quality_rules import brute_kept
from test_simhash import brute_classes, brute_fingerprint
from test_suffix_dedup import brute as brute_spans

SF = "/root/testdata/sf0.001"


def rows_of(frame):
    return [(r["doc_id"], r["text"]) for r in frame.collect()]


def test_stages_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)

    good = {r["doc_id"] for r in labels.filter("quality = 1 and toxic = 0").collect()}
    kept = stages["quality_rules"](spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(rows_of(kept)) == sorted((d, t) for (d, t), v in zip(rows_of(docs), brute_kept(rows_of(docs), good)) if v[-1])

    kept = spark.createDataFrame(kept.collect(), docs.schema)
    single = stages["simhash_near_dedup"](spark, kept, SF)
    classes = brute_classes([(d, brute_fingerprint(t)) for d, t in rows_of(kept)])
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(d for d, _, least in classes if d == least)
    assert single.columns == docs.columns

    single = spark.createDataFrame(single.collect(), docs.schema)
    cut = stages["suffix_array_dedup"](spark, single, SF)
    removed = {d: gone for d, _, gone, _, _ in brute_spans(rows_of(single))}
    before = dict(rows_of(single))
    assert cut.columns == docs.columns and cut.count() == single.count()
    for r in cut.collect():
        lost = len(before[r["doc_id"]].encode()) - len(r["text"].encode())
        assert removed[r["doc_id"]] - 6 <= lost <= removed[r["doc_id"]] and r["n_chars"] == len(r["text"])

    cut = spark.createDataFrame(cut.collect(), docs.schema)
    mix = stages["source_mixing"](spark, cut, SF)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in cut.collect()]
    draws = [r[0] for r in cut.select(F.xxhash64(F.lit(0), "doc_id", "text")).collect()]
    expected = {d: reps for d, _, size, _, _, reps in brute_mix(rows, draws) if reps}
    assert {r["doc_id"]: r["n"] for r in mix.groupBy("doc_id").agg(F.count("*").alias("n")).collect()} == expected

    encoded = stages["sentencepiece_encoding"](spark, mix, SF)
    assert encoded.filter("not round_trip").count() == 0
    assert {r[0] for r in encoded.select("doc_id").distinct().collect()} == set(expected)


def test_run(spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.count() > 0 and found.filter("not round_trip").count() == 0

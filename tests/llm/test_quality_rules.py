"""Rule counts and likelihood ratios against plain Python."""

import math
import re
import struct
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from rxtally.llm import quality_rules as qr

words_of = re.compile(r"[^\x20\x09-\x0D]+").findall


def brute_counts(text):
    text = text or ""
    words = words_of(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if words_of(line)]
    n = len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = n < 10 or 100 * len(inside) > 20 * n
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside), failed


def signed(h):
    return h - (h >> 63 << 64)


def buckets_of(text, buckets):
    hashes = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in words_of(text or "")]
    pairs = []
    for a, b in zip(hashes, hashes[1:]):
        first = xxhash.xxh64_intdigest(struct.pack("<q", a), 42)
        pairs.append(signed(xxhash.xxh64_intdigest(struct.pack("<q", b), first)))
    return [h % buckets for h in hashes + pairs]


def brute_kept(rows, trusted, buckets=qr.BUCKETS, threshold=qr.THRESHOLD):
    """doc_id, counts, llr and verdict of all rows."""
    raw, target = Counter(), Counter()
    for doc, text in rows:
        ids = buckets_of(text, buckets)
        raw.update(ids)
        if doc in trusted:
            target.update(ids)
    share = lambda counts, i: math.log((counts[i] + 1) / (counts.total() + buckets))
    out = []
    for doc, text in rows:
        ids, counts = buckets_of(text, buckets), brute_counts(text)
        llr = sum(share(target, i) - share(raw, i) for i in ids) / len(ids) if ids else 0.0
        out.append((doc, *counts, llr, not counts[-1] and llr >= threshold))
    return out


def compare(frame, trusted_ids, **settings):
    rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
    trusted = frame.sparkSession.createDataFrame([(i,) for i in trusted_ids], "doc_id bigint")
    found = sorted(map(tuple, qr.judged(frame, trusted, "doc_id", **settings).collect()), key=repr)
    expected = sorted(brute_kept(rows, {i for i in trusted_ids if i is not None}, **settings), key=repr)
    assert len(found) == len(expected)
    for f, e in zip(found, expected):
        assert f[:7] == e[:7] and f[8] == e[8]
        assert f[7] == pytest.approx(e[7], abs=1e-9)


def test_edge_texts(spark):
    five = "a b c d e "
    texts = [
        None, "", " \t", "one", "a b c d", five * 2, five * 2000, "x " * 3000, "l\nl\n\n \nl", "#*$ %&| <> é🙂",
        "a b c d e f a b c d e", "a b c d e b c d e a b c d", "Ten words are here so that nothing fails at all today",
    ]
    rows = list(enumerate(texts)) + [(None, five * 2), (3, "one"), (3, "one")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("words_", F.lit("clash"))
    frame = frame.withColumn("ratios_", F.lit(1)).withColumn("llr", F.lit(1)).withColumn("trusted_id", F.lit(1))
    compare(frame, [3, 12, None, 99], buckets=64)
    compare(frame, [], buckets=64)
    trusted = spark.createDataFrame([(1,)], "doc_id bigint")
    assert qr.judged(frame.limit(0), trusted, "doc_id").collect() == []


def test_driver_documents(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    compare(frame, list(range(0, 200, 2)))


def test_clean_documents_stay_and_junk_goes(spark):
    from rxtally.llm.queries import op9_quality_rules

    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = op9_quality_rules(spark, "/root/testdata/sf0.01").filter("not base_failed").join(labels, "doc_id")
    kept = {(r[0], r[1]): r[2] for r in found.groupBy("quality", "toxic").agg(F.avg(F.col("kept").cast("int"))).collect()}
    assert kept[1, 0] == 1.0 and kept[0, 0] < 0.2

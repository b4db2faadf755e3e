"""SimHash classes against pairwise comparison."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rxtally.llm import components, simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_classes(rows):
    marks = sorted({mark for _, mark in rows})
    root = {m: m for m in marks}

    def top(m):
        while root[m] != m:
            m = root[m]
        return m

    for k, a in enumerate(marks):
        for b in marks[:k]:
            if (a ^ b).bit_count() <= 2:
                root[max(top(a), top(b))] = min(top(a), top(b))
    least = {}
    for doc, mark in rows:
        if doc is not None:
            least[top(mark)] = min(doc, least.get(top(mark), doc))
    return sorted(((doc, mark, least.get(top(mark))) for doc, mark in rows), key=repr)


def found(df):
    return sorted(((r[0], r[1] & (1 << 64) - 1, r[2]) for r in df.collect()), key=repr)


def test_edge_texts(spark):
    texts = [None, "", " \t\n", "a", "A", "a b", "one two three", "One TWO three four", "é É é É", "x " * 70_000, "a"]
    rows = list(enumerate(texts)) + [(None, "a"), (3, "a")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("fingerprint", F.lit("clash"))
    frame = frame.withColumn("root", F.lit(1)).withColumn("u", F.lit(1))
    assert found(simhash.classes(frame)) == brute_classes([(d, brute_fingerprint(t)) for d, t in rows])
    assert simhash.classes(frame.limit(0)).collect() == []
    kept = simhash.first_of_each_class(frame)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.filter("doc_id is not null").collect())[:2] == [0, 3]


def test_driver_documents(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(r[0], brute_fingerprint(r[1])) for r in frame.collect()]
    assert found(simhash.classes(frame)) == brute_classes(rows)


@pytest.mark.parametrize("subtree", [8, 40, 10_000])
def test_trie_join(spark, monkeypatch, subtree):
    """Dense balls, chains and random fingerprints, with the trie cut at several depths."""
    monkeypatch.setattr(simhash, "SUBTREE", subtree)
    draw = np.random.default_rng(subtree)
    centres = [int(x) for x in draw.integers(0, 2**63, 12)]
    marks = {0, 2**64 - 1, *centres}
    for c in centres:
        for _ in range(25):
            c ^= 1 << int(draw.integers(64))
            marks |= {c, c ^ 1 << 63, c ^ 3 << int(draw.integers(63))}
    rows = list(enumerate(sorted(marks)))
    frame = spark.createDataFrame([(d, m - (m >> 63 << 64)) for d, m in rows], "doc_id bigint, fingerprint bigint")
    links = simhash.links(frame.select("fingerprint"))
    nodes = frame.select(F.col("fingerprint").alias("node"), "doc_id")
    by_root = {}
    for r in components.with_component(nodes, links).collect():
        by_root.setdefault(r["root"], []).append(r["doc_id"])
    expected = {}
    for doc, _, least in brute_classes(rows):
        expected.setdefault(least, []).append(doc)
    assert sorted(sorted(x) for x in by_root.values()) == sorted(sorted(x) for x in expected.values())


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(5, i) for i in range(200, 260)]
    frame = spark.createDataFrame(chain + star + [(7, 7), (259, 5), (5, 259)], "u bigint, v bigint")
    roots = {r["node"]: r["root"] for r in components.components(frame).collect()}
    assert {roots[i] for i in range(101, 161)} == {100} and {roots[i] for i in range(200, 260)} == {5}
    assert components.components(frame.limit(0)).collect() == []


def test_pairs_are_searched_in_bounded_memory():
    import tracemalloc

    draw = np.random.default_rng(3)
    marks = draw.integers(0, 1 << 64, 100_000, dtype=np.uint64)
    near = marks[:5000] ^ (np.uint64(1) << draw.integers(0, 64, 5000, dtype=np.uint64))
    marks = np.unique(np.r_[marks, near])
    tracemalloc.start()
    found = sum(len(i) for i, _ in simhash.close_pairs(marks, (0, len(marks)), (0, len(marks)), 0, 2))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 5000 and peak < 100e6

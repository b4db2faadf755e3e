"""Water-filling and the choice of documents against plain Python."""

import pytest
from pyspark.sql import functions as F

from rxtally.llm import mixing
from test_quality_rules import words_of


def brute_targets(sizes, weights, cap=3.0):
    level, free = {s: 0.0 for s in sizes}, {s for s in sizes if weights.get(s, 0) > 0}
    left = float(sum(sizes.values()))
    while free:
        rate = left / sum(weights[s] for s in free)
        over = {s for s in free if weights[s] * rate > cap * sizes[s]}
        if not over:
            return level | {s: weights[s] * rate for s in free}
        for s in over:
            level[s] = cap * sizes[s]
            left -= level[s]
        free -= over
    return level


def brute_mix(rows, draws):
    """(doc_id, source, size, source_size, target, reps) of rows (doc_id, text, source), with their draws."""
    size = [len(words_of(text or "")) for _, text, _ in rows]
    sizes = {}
    for (_, _, source), n in zip(rows, size):
        sizes[source] = sizes.get(source, 0) + n
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    level = brute_targets(sizes, {s: k % 3 + 1 for k, s in enumerate(names)})
    out = []
    for source in names:
        own = [i for i, r in enumerate(rows) if r[2] == source]
        whole = int(level[source] // sizes[source]) if sizes[source] else 0
        rest, before = level[source] - whole * sizes[source], 0
        for i in sorted(own, key=lambda i: ((draws[i] & (1 << 64) - 1), repr(rows[i][0]))):
            taken = before + size[i] / 2 <= rest and rest > 0
            before += size[i]
            out.append((rows[i][0], source, size[i], sizes[source], level[source], whole + taken))
    return sorted(out, key=repr)


def found(frame):
    rows = mixing.mixed(frame, "doc_id").collect()
    return sorted(((r["doc_id"], r["source"], r["size"], r["source_size"], r["target"], r["reps"]) for r in rows), key=repr)


def compare(frame):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in frame.collect()]
    draws = [r[0] for r in frame.select(F.xxhash64(F.lit(0), "doc_id", "text")).collect()]
    mine, plain = found(frame), brute_mix(rows, draws)
    assert [(m[:4], m[5]) for m in mine if m[2]] == [(p[:4], p[5]) for p in plain if p[2]]
    assert [m[:4] for m in mine] == [p[:4] for p in plain]
    for m, p in zip(mine, plain):
        assert m[4] == pytest.approx(p[4]) and m[5] <= 3


def test_driver_documents(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "source")
    compare(frame)
    assert found(frame) == found(frame.repartition(7))
    sums = {}
    for _, source, size, _, target, reps in found(frame):
        sums.setdefault(source, [0, target, 0])
        sums[source][0] += size * reps
        sums[source][2] = max(sums[source][2], size)
    assert all(abs(taken - target) <= largest for taken, target, largest in sums.values())


def test_edge_rows(spark):
    rows = [(i, "w " * n, s) for i, (n, s) in enumerate([(1, "b"), (500, "B"), (3, "é"), (40, None), (7, "b"), (0, "zero")])]
    rows += [(None, "x y", "b"), (9, None, "b"), (4, "w " * 7, "b"), (20, "w " * 30_000, "a"), (21, "", None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    frame = frame.withColumn("size", F.lit("clash")).withColumn("bucket", F.lit(1)).withColumn("target", F.lit(1))
    compare(frame)
    assert found(frame.limit(0)) == []


def test_caps_are_reshared(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 10), ("c", 1000)], "source string, source_size bigint")
    weights = spark.createDataFrame([("a", 50), ("b", 1), ("c", 1)], "source string, weight int")
    got = {r["source"]: r["target"] for r in mixing.targets(sizes, weights).collect()}
    assert got == pytest.approx(brute_targets({"a": 10, "b": 10, "c": 1000}, {"a": 50, "b": 1, "c": 1}))
    assert got["a"] == 30.0 and sum(got.values()) == pytest.approx(1020)

"""Approximate neighbours against brute force: recall, exact scores, ties and rows that take no part."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rxtally.llm import nearest as nn


def brute(rows, every=20, k=20):
    good = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v) or len(v) != 4:
            continue
        good.setdefault((i, tuple(np.float32(v).astype(float))), None)
    out = []
    for q in sorted({i for i, _ in good if i % every == 0}):
        own = min(v for i, v in good if i == q)
        scores = {}
        for i, v in good:
            if i != q:
                scores[i, v] = (np.array(own) * np.array(v)).sum()
        ranked = sorted((-s, i) for (i, _), s in scores.items())[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(ranked)]
    return out


@pytest.mark.parametrize("cell", [16, 10_000])
def test_exact_with_full_confidence(spark, cell):
    draw = np.random.default_rng(5)
    rows = [(int(i), [float(np.float32(x)) for x in draw.normal(size=4) * draw.choice([0.1, 1, 5])]) for i in range(300)]
    rows += [(1000 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(60)] + [(400, rows[3][1]), (7, rows[7][1])]
    rows += [(500, None), (501, [0.0] * 4), (502, [float("nan"), 1.0, 1.0, 1.0]), (503, [float("inf"), 1.0, 1.0, 1.0])]
    rows += [(504, [None, 1.0, 1.0, 1.0]), (505, []), (506, [1.0]), (None, [1.0] * 4)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("cell", F.lit("clash"))
    found = [tuple(r) for r in nn.nearest(frame, cell=cell, confidence=1.0).orderBy("query_id", "rank").collect()]
    expected = brute(rows)
    assert [f[:3] for f in found] == [e[:3] for e in expected]
    assert np.allclose([f[3] for f in found], [e[3] for e in expected], rtol=1e-12)


@pytest.mark.parametrize("parts", [1, 7])
def test_repeated_rows_in_a_group_of_copies(spark, parts):
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(45) for _ in range(2)] + [(0, [1.0, 2.0, 3.0, 4.0])] * 40
    rows += [(100 + i, [0.1, 0.2, 0.3, float(i)]) for i in range(2)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(parts)
    found = [tuple(r)[:3] for r in nn.nearest(frame, confidence=1.0).orderBy("query_id", "rank").collect()]
    assert found == [e[:3] for e in brute(rows)]


def test_few_and_no_rows(spark):
    frame = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in nn.nearest(frame).collect()] == [(0, 1, 1, 2.0)]
    assert nn.nearest(frame.limit(0)).collect() == []
    assert nn.nearest(frame.limit(1)).collect() == []


def test_recall_on_driver_vectors(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = frame.select("vec_id", "embedding").toPandas()
    ids, x = rows["vec_id"].to_numpy(), np.array(rows["embedding"].tolist(), np.float64)
    found = nn.nearest(frame, cell=1024).toPandas()
    hits = total = 0
    for n in np.flatnonzero(ids % 20 == 0):
        score = x @ x[n]
        score[n] = -np.inf
        best = set(ids[np.argsort(-score)[:20]])
        own = found[found["query_id"] == ids[n]]
        assert sorted(own["rank"]) == list(range(1, 21))
        hits, total = hits + len(best & set(own["vec_id"])), total + 20
    assert hits / total >= 0.9


@pytest.mark.parametrize("block", [(40, 4), (7, 10_000), (10_000, 3)])
def test_small_blocks_give_the_same_rows(spark, block):
    draw = np.random.default_rng(6)
    rows = [(int(i), [float(np.float32(x)) for x in draw.normal(size=4)]) for i in range(300)]
    rows += [(1000 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(60)] * 2
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = nn.nearest(frame, cell=64, confidence=1.0, block=block).orderBy("query_id", "rank").collect()
    expected = brute(rows)
    assert [tuple(f)[:3] for f in found] == [e[:3] for e in expected]
    assert np.allclose([f["score"] for f in found], [e[3] for e in expected], rtol=1e-12)


def test_folding_nothing():
    assert len(nn.folded(np.zeros(0, np.int64), np.zeros((0, 3)), 5)) == 0


def test_the_stopping_test_passes_rows_over():
    """A larger ratio verifies fewer rows; clear neighbours stay found."""
    draw = np.random.default_rng(2)
    middle = draw.normal(size=(40, 32)) * 4
    vectors = (middle[:, None, :] + draw.normal(size=(40, 50, 32)) * 0.2).reshape(-1, 32)
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    ids = np.arange(len(vectors))
    index = nn.build_index(vectors, 1.0, len(vectors), 10**9, 7)
    asks, nothing = vectors[::50], np.full(40, -np.inf)
    shares = []
    for ratio in (1.0, 1.5):
        limit = nn.chi_square_limit(nn.DIMENSIONS, nn.CONFIDENCE) / ratio**2
        n, row, _, verified = nn.search(index, ids, vectors, ids[::50], asks, nothing, 20, limit)
        shares.append(verified / len(asks) / len(vectors))
        scores = asks @ vectors.T
        scores[np.arange(40), np.arange(0, 2000, 50)] = -np.inf
        best = [set(np.argsort(-s)[:20]) for s in scores]
        assert np.mean([i in best[q] for q, i in zip(n, row)]) >= 0.9
    assert shares[1] <= shares[0] < 0.5

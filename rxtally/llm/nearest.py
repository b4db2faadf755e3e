"""Approximate nearest neighbours by stable projections and a kd-tree (operator 5).

Largest inner product becomes least Euclidean distance by one more component, ``sqrt(M^2 - |x|^2)``, that queries have
as zero. Vectors are projected to ``DIMENSIONS`` numbers by Gaussian, that is 2-stable, projections: the squared
projected distance of a pair over its squared distance is chi-square distributed. A kd-tree indexes the projections. A
query meets them by growing projected distance and verifies each on the original vectors. It stops when the chi-square
test says that a vector ``RATIO`` times nearer than its present k-th neighbour would, with chance ``CONFIDENCE``, have
come already: projected distances beyond that are passed over, by boxes of cells, by boxes of leaves and row by row.

The top of the tree is fitted on a bounded sample (``SAMPLE`` rows with the smallest hashes) and cuts space into
cells; every row is put into its cell, so each is indexed. Queries first search their own cell, then only the cells
whose boxes pass the same test. Inside a task the tree goes on to leaves of ``LEAF`` rows, which are visited in order
of their boxes. Nothing else is capped: with a confidence of one every row is verified.

No group grows with the data. A cell's rows are dealt by hash into parts of about ``ROWS``, the queries that reach it into
blocks of about ``ASKS``, and every block meets every part. Their numbers come from counts of rows and queries by cell,
a table of at most an eighth of the sample.

Copies of a vector are folded before they move: of equal vectors in a batch only the k + 1 smallest different ids can be
among anyone's k nearest. Repeated rows are taken out first, and once more in their cell.

Defined results: vectors that are null, zero, of another length than most of the sample, or with null or non-finite
components take no part, nor do rows without an id. A repeated row counts once; an id with several vectors is a
candidate with each and a query with the least of them. Fewer than k candidates give all. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rxtally.llm.storage import stored

DIMENSIONS = 16  # even: the chi-square distribution then has a closed form
CONFIDENCE = 0.9
RATIO = 1.0
SAMPLE = 16_384
CELL = 16_384  # rows in a cell, on average
LEAF = 256
QUERIES = 1024  # queries searched together
ROWS = 65_536  # rows of a cell in one task's group, about
ASKS = 16_384  # queries in one task's group, about


def chi_square_limit(degrees: int, confidence: float) -> float:
    """The value that a chi-square variable of an even number of degrees stays under with this chance."""
    if confidence >= 1:
        return math.inf

    def above(x: float) -> float:
        term, total = 1.0, 1.0
        for i in range(1, degrees // 2):
            term *= x / 2 / i
            total += term
        return math.exp(-x / 2) * total

    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if above(middle) > 1 - confidence else (low, middle)
    return high


@dataclass(frozen=True)
class Index:
    """Projection, norm bound and the top of the tree: cut axis and value of every inner node, by level."""

    projection: np.ndarray
    bound: float
    axes: np.ndarray
    values: np.ndarray
    depth: int

    def projected(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        rest = np.zeros(len(vectors))
        if not query:
            rest = np.sqrt(np.maximum(self.bound**2 - np.einsum("ij,ij->i", vectors, vectors), 0))
        return vectors @ self.projection[:-1] + rest[:, None] * self.projection[-1]

    def cells(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            right = points[np.arange(len(points)), self.axes[node]] > self.values[node]
            node = 2 * node + 1 + right
        return node - (2**self.depth - 1)


def build_index(sample: np.ndarray, bound: float, rows: int, cell: int, seed: int, dimensions: int = DIMENSIONS) -> Index:
    """Median cuts along the widest axis of the projected sample, to about ``rows / cell`` cells."""
    projection = np.random.default_rng(seed).normal(size=(sample.shape[1] + 1, dimensions))
    depth = max(0, min(math.ceil(math.log2(max(rows / cell, 1))), int(math.log2(max(len(sample) / 8, 1)))))
    flat = Index(projection, bound, np.zeros(0, np.int64), np.zeros(0), 0)
    axes, values = np.zeros(2**depth - 1, np.int64), np.zeros(2**depth - 1)
    parts = {0: flat.projected(sample)}
    for node in range(2**depth - 1):
        points = parts.pop(node)
        if len(points):
            axes[node] = np.argmax(np.ptp(points, axis=0))
            values[node] = np.median(points[:, axes[node]])
        right = points[:, axes[node]] > values[node]
        parts[2 * node + 1], parts[2 * node + 2] = points[~right], points[right]
    return Index(projection, bound, axes, values, depth)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def folded(ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows to keep: of each vector the k + 1 smallest different ids, each once."""
    if not len(ids):
        return np.zeros(0, np.int64)
    order = np.lexsort((ids, *rows.T[::-1]))
    fresh = np.r_[True, (rows[order[1:]] != rows[order[:-1]]).any(axis=1)]
    single = fresh | np.r_[True, ids[order[1:]] != ids[order[:-1]]]
    order, fresh = order[single], fresh[single]
    start = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - start <= k]


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances from every point to every box."""
    out = np.zeros((len(points), len(low)))
    for axis in range(points.shape[1]):
        p = points[:, axis, None]
        out += np.maximum(np.maximum(low[:, axis] - p, p - high[:, axis]), 0) ** 2
    return out


def point_distances(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Squared distances of every point to every other, within rounding."""
    squares = np.einsum("ij,ij->i", points, points)[:, None] + np.einsum("ij,ij->i", others, others)[None, :]
    return squares - 2 * points @ others.T


def leaves(points: np.ndarray, leaf: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Row numbers of the tree's leaves, with their boxes."""
    waiting, done = [np.arange(len(points))], []
    while waiting:
        rows = waiting.pop()
        if len(rows) <= leaf:
            done.append(rows)
            continue
        axis = np.argmax(np.ptp(points[rows], axis=0))
        order = np.argpartition(points[rows, axis], len(rows) // 2)
        waiting += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return done, np.array([points[r].min(0) for r in done]), np.array([points[r].max(0) for r in done])


def squared_reach(queries: np.ndarray, kth: np.ndarray, bound: float) -> np.ndarray:
    """Squared distance of the k-th neighbour, from its inner product; infinite if there is none yet."""
    return np.maximum(np.einsum("ij,ij->i", queries, queries) + bound**2 - 2 * kth, 0)


def exact_scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products row by row, always added up in the same order, so that copies score alike."""
    return (queries * vectors).sum(axis=1)


def search(index: Index, ids, vectors, query_ids, queries, floor, k: int, limit: float):
    """(query number, row number, score) of the k best of one cell for each query, where they reach ``floor``.

    Last comes the number of pairs verified on the original vectors. ``floor`` is the k-th score that a query has from elsewhere; minus infinity if it has fewer.
    """
    points = index.projected(vectors)
    parts, low, high = leaves(points, LEAF)
    out, verified = [], 0
    # Rounding must not part equal points, nor lose equal scores before they are added up in one order.
    hair = 1e-9 * (1 + index.bound**2)
    for at in range(0, len(queries), QUERIES):
        block = slice(at, min(at + QUERIES, len(queries)))
        q, own = queries[block], query_ids[block]
        seen = index.projected(q, query=True)
        ahead = box_distances(seen, low, high)
        order = np.argsort(ahead, axis=1)
        kth = floor[block].copy()
        best_score, best_row = np.full((len(q), k), -np.inf), np.full((len(q), k), -1)
        active = np.arange(len(q))
        for step in range(len(parts)):
            leaf = order[active, step]
            reach = squared_reach(q[active], kth[active], index.bound) * limit
            go = ~(ahead[active, leaf] > reach)
            active, leaf = active[go], leaf[go]
            if not len(active):
                break
            for part in np.unique(leaf):
                asks, rows = active[leaf == part], parts[part]
                reach = squared_reach(q[asks], kth[asks], index.bound) * limit
                take = ~(point_distances(seen[asks], points[rows]) > reach[:, None] + hair)
                verified += int(take.sum())
                near = take.any(axis=0)
                rows, take = rows[near], take[:, near]
                rough = q[asks] @ vectors[rows].T
                take &= rough >= np.maximum(kth[asks], best_score[asks, -1])[:, None] - hair
                take &= own[asks][:, None] != ids[rows][None, :]
                for n in np.flatnonzero(take.any(axis=1)):
                    ask, found = asks[n], rows[take[n]]
                    score = np.concatenate([best_score[ask], exact_scores(q[ask][None, :], vectors[found])])
                    row = np.concatenate([best_row[ask], found])
                    tie = np.where(row >= 0, ids[row], np.iinfo(np.int64).max)
                    first = np.lexsort((tie, -score))[:k]
                    best_score[ask], best_row[ask] = score[first], row[first]
                    kth[ask] = max(floor[block][ask], best_score[ask, -1])
        n, place = np.nonzero(best_row >= 0)
        out.append((n + at, best_row[n, place], best_score[n, place]))
    return *(np.concatenate(x) for x in zip(*out)), verified


def nearest(
    vectors: DataFrame, every: int = 20, k: int = 20, cell: int = CELL, confidence: float = CONFIDENCE, seed: int = 7,
    ratio: float = RATIO, dimensions: int = DIMENSIONS, block: tuple[int, int] = (ROWS, ASKS),
):
    """query_id, rank, vec_id, score: the k nearest of every row whose vec_id is divisible by ``every``.

    ``confidence``, ``ratio`` and ``dimensions`` (even) trade recall for work; ``block`` bounds rows and queries of a group.
    """
    spark = vectors.sparkSession
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    good = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
        .filter("vec_id is not null and size(vector) > 0")
        .filter(finite)
        .withColumn("square", square)
        .filter("square > 0 and square < double('infinity')")
    )
    shape = "vec_id bigint, square double, vector array<double>"
    sample = good.select("vec_id", "square", "vector").orderBy(F.xxhash64("vec_id", "vector")).limit(SAMPLE).collect()
    answer = "query_id bigint, rank int, vec_id bigint, score double"
    if not sample:
        return spark.createDataFrame([], answer)
    widths = [len(r["vector"]) for r in sample]
    width = max(set(widths), key=lambda w: (widths.count(w), w))
    good = good.filter(F.size("vector") == width)
    total = good.agg(F.count("*"), F.max("square")).first()
    index = build_index(np.array([r["vector"] for r in sample if len(r["vector"]) == width]), math.sqrt(total[1]), total[0], cell, seed, dimensions)
    limit = chi_square_limit(dimensions, confidence) / ratio**2

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column(0).to_numpy(), matrix(batch.column(2), width)
            kept = folded(ids, rows, k)
            ids, rows = ids[kept], rows[kept]
            home = index.cells(index.projected(rows))
            values = pa.array(rows.ravel())
            lists = pa.ListArray.from_arrays(np.arange(len(ids) + 1, dtype=np.int32) * width, values)
            yield pa.record_batch([pa.array(home), pa.array(ids), lists], names=["cell", "vec_id", "vector"])

    rows = stored(good.select(*shape.replace(",", "").split()[::2]).mapInArrow(placed, "cell bigint, vec_id bigint, vector array<double>"))

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home = index.cells(index.projected(matrix(batch.column(1), width), query=True))
            yield pa.record_batch([pa.array(home), *batch.columns], names=["cell", "query_id", "vector"])

    asked = good.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = stored(asked.mapInArrow(homes, "cell bigint, query_id bigint, vector array<double>"))

    def found(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, own = left.column("vec_id").to_numpy(), right.column("query_id").to_numpy()
        empty = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        n, row, score = empty
        if len(ids) and len(own):
            vectors_, asks = (matrix(t.column("vector").combine_chunks(), width) for t in (left, right))
            if len(np.unique(ids)) < len(ids):  # rows that repeat in several batches would take places of others
                kept = folded(ids, vectors_, k)
                ids, vectors_ = ids[kept], vectors_[kept]
            floor = right.column("floor").to_numpy().astype(np.float64)
            n, row, score, _ = search(index, ids, vectors_, own, asks, floor, k, limit)
        return pa.table({"query_id": own[n], "vec_id": ids[row], "score": score})

    sizes = rows.groupBy("cell").agg(F.ceil(F.count("*") / block[0]).cast("int").alias("parts"))

    def searched(queries: DataFrame) -> DataFrame:
        asks = queries.groupBy("cell").agg(F.ceil(F.count("*") / block[1]).cast("int").alias("blocks"))
        plan = F.broadcast(sizes.join(asks, "cell"))  # a row for each cell: at most an eighth of the sample

        def dealt(frame: DataFrame, own: str, total: str, other: str, others: str, *by: str) -> DataFrame:
            every_other = F.explode(F.sequence(F.lit(0), F.col(others) - 1))
            place = F.pmod(F.xxhash64(*by), F.col(total)).cast("int")
            return frame.join(plan, "cell").withColumn(own, place).withColumn(other, every_other).drop("parts", "blocks")

        left = dealt(rows, "part", "parts", "asked", "blocks", "vec_id", "vector")
        right = dealt(queries, "asked", "blocks", "part", "parts", "query_id")
        keys = ["cell", "part", "asked"]
        pairs = left.groupBy(*keys).cogroup(right.groupBy(*keys))
        return pairs.applyInArrow(lambda left, right: found(left, right), "query_id bigint, vec_id bigint, score double")

    first = stored(searched(asked.withColumn("floor", F.lit(float("-inf")))))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    floors = (
        first.distinct().withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k)
        .select(F.col("query_id").alias("asker"), F.col("score").alias("floor"))
    )
    boxes = _boxes(rows, index, width)

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, low, high = boxes
        for batch in batches:
            asks, floor = matrix(batch.column(2), width), batch.column(3).to_numpy(zero_copy_only=False)
            ahead = box_distances(index.projected(asks, query=True), low, high)
            reach = squared_reach(asks, np.where(np.isnan(floor), -np.inf, floor), index.bound) * limit
            go = ~(ahead > reach[:, None]) & (cells[None, :] != batch.column(0).to_numpy()[:, None])
            n, c = np.nonzero(go)
            taken = batch.take(pa.array(n))
            yield pa.record_batch([pa.array(cells[c]), *taken.columns[1:]], names=["cell", "query_id", "vector", "floor"])

    aware = asked.join(floors, F.col("query_id") == F.col("asker"), "left").select(
        "cell", "query_id", "vector", F.coalesce("floor", F.lit(float("-inf"))).alias("floor")
    )
    second = searched(aware.mapInArrow(others, "cell bigint, query_id bigint, vector array<double>, floor double"))
    ranked = first.unionByName(second).distinct().withColumn("rank", F.row_number().over(best).cast("int"))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _boxes(rows: DataFrame, index: Index, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers and boxes of the cells, a few numbers for each: their count is bounded by the sample's."""

    def corners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, points = batch.column(0).to_numpy(), index.projected(matrix(batch.column(1), width))
            for cell in np.unique(cells):
                own = points[cells == cell]
                low, high = (pa.array([x.tolist()], pa.list_(pa.float64())) for x in (own.min(0), own.max(0)))
                yield pa.record_batch([pa.array([cell]), low, high], names=["cell", "low", "high"])

    edges = rows.select("cell", "vector").mapInArrow(corners, "cell bigint, low array<double>, high array<double>")
    size = index.projection.shape[1]
    least = [F.min(F.get("low", F.lit(i))).alias(f"l{i}") for i in range(size)]
    most = [F.max(F.get("high", F.lit(i))).alias(f"h{i}") for i in range(size)]
    found = np.array([tuple(r) for r in edges.groupBy("cell").agg(*least, *most).collect()], np.float64)
    return found[:, 0].astype(np.int64), found[:, 1 : 1 + size], found[:, 1 + size :]

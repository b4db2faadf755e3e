"""SimHash near-duplicates by a self-join of a binary trie (operator 2).

Fingerprints hold one bit for each of 64 positions: set if more than half of the shingle hashes have it set. Equal
fingerprints are put together first, so a group of copies is one entry. The distinct fingerprints form a binary trie.
Its nodes are traversed in pairs from the root; a pair carries the differing bits on its way, and is dropped when they
exceed the budget. The top ``depth`` levels are traversed as a Spark join: each fingerprint goes to every pair of
subtrees that is still within the budget, of which there are ``1 + depth + depth * (depth - 1) / 2`` for each subtree.
The rest of a pair is traversed in one task, one level of all its node pairs at a time.

A task returns a spanning forest of the links it found, at most one row for each fingerprint it got, and not the pairs
themselves. Forests are joined by ``components``. A fingerprint has at most 1 + 64 + 2016 others within two bits, so
the pairs a task looks at grow with its fingerprints and not with their square.

Defined results: null and empty texts have fingerprint zero and link like any other. Rows without a doc_id get their
class, but never name one; a class of such rows alone has a null name. Repeated rows are separate members of a class.
An empty table gives an empty table. Only named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxtally.llm.components import with_component
from rxtally.llm.storage import stored
from rxtally.llm.text import let, lowered, words

BITS = 64
SUBTREE = 16_384  # fingerprints in a subtree, on average
HASHES = 1 << 16  # hashes whose bits are spread out at a time
LEAF = 64  # pairs below a node pair that are compared outright
NODES = 32_768  # node pairs held and split at a time


def shingle_hashes(text: Column, width: int = 3) -> Column:
    """XXH64, seed 42, of every shingle of ``width`` lower-case words; of the whole sequence if there are fewer."""

    def hashes(ws: Column) -> Column:
        n = F.size(ws)
        shingle = lambda i: F.xxhash64(F.concat_ws(" ", *[F.get(ws, i + k) for k in range(width)]))
        return (
            F.when(n == 0, F.array().cast("array<bigint>"))
            .when(n < width, F.array(F.xxhash64(F.array_join(ws, " "))))
            .otherwise(F.transform(F.sequence(F.lit(0), n - width), shingle))
        )

    return let(words(lowered(text)), hashes)


def majority(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Fingerprints of the runs ``hashes[offsets[i]:offsets[i + 1]]``; zero for an empty run."""
    counts = np.zeros((len(offsets) - 1, BITS), np.int64)
    filled = np.flatnonzero(np.diff(offsets))
    starts, ends = offsets[:-1][filled], offsets[1:][filled]
    for begin in range(0, len(hashes), HASHES):
        end = min(begin + HASHES, len(hashes))
        bits = np.unpackbits(hashes[begin:end].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first, last = np.searchsorted(ends, begin, "right"), np.searchsorted(starts, end, "left")
        at = np.maximum(starts[first:last], begin) - begin
        counts[filled[first:last]] += np.add.reduceat(bits, at, axis=0, dtype=np.int32)
    over = (2 * counts > np.diff(offsets)[:, None]).astype(np.uint8)
    return np.packbits(over, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(documents: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, fingerprint (long, the 64 bits as they are)."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            values = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
            marks = majority(np.ascontiguousarray(values), offsets - offsets[0]).view(np.int64)
            yield pa.record_batch([batch.column(0), pa.array(marks)], names=["doc_id", "fingerprint"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", shingle_hashes(F.col("text"), width).alias("hashes"))
    return rows.mapInArrow(batches, f"doc_id {kind}, fingerprint bigint")


def _split(marks: np.ndarray, low: np.ndarray, bit: int) -> np.ndarray:
    """For ranges that share all bits above ``bit``, where the part with that bit set begins, if it lay anywhere."""
    kept = ~((np.uint64(1) << np.uint64(bit + 1)) - np.uint64(1)) if bit < BITS - 1 else np.uint64(0)
    return np.searchsorted(marks, (marks[low] & kept) | (np.uint64(1) << np.uint64(bit)))


def _cross(low_a, high_a, low_b, high_b) -> tuple[np.ndarray, np.ndarray]:
    """All index pairs of a list of range pairs."""
    width = high_b - low_b
    sizes = (high_a - low_a) * width
    owner = np.repeat(np.arange(len(sizes)), sizes)
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return low_a[owner] + within // width[owner], low_b[owner] + within % width[owner]


def close_pairs(marks: np.ndarray, a: tuple[int, int], b: tuple[int, int], depth: int, budget: int):
    """Yields arrays (i, j) of places in the sorted ``marks`` that differ in at most ``budget`` bits.

    ``a`` and ``b`` are the ranges of two subtrees at ``depth``; the same range twice is a self-join, of which each
    pair comes once. A node pair is a pair of ranges with the differing bits of its path.
    """
    start = np.array([[a[0], a[1], b[0], b[1]]], np.int64).T
    path = int(np.bitwise_count((marks[a[0]] ^ marks[b[0]]) >> np.uint64(BITS - depth))) if depth else 0
    # Depth first, in lists of at most ``NODES`` node pairs of a level, so that few are held at a time.
    waiting = [(BITS - 1 - depth, start, np.array([path], np.int64))]
    while waiting:
        bit, frontier, errors = waiting.pop()
        low_a, high_a, low_b, high_b = frontier
        small = (high_a - low_a) * (high_b - low_b) <= LEAF if bit >= 0 else np.ones(len(low_a), bool)
        if small.any():
            i, j = _cross(*frontier[:, small])
            near = (np.bitwise_count(marks[i] ^ marks[j]) <= budget) & (i < j)
            if near.any():
                yield i[near], j[near]
        frontier, errors = frontier[:, ~small], errors[~small]
        if not len(errors):
            continue
        low_a, high_a, low_b, high_b = frontier
        middle_a = np.clip(_split(marks, low_a, bit), low_a, high_a)
        middle_b = np.clip(_split(marks, low_b, bit), low_b, high_b)
        same = low_a == low_b  # of ranges at one level: the same node
        children = [
            (low_a, middle_a, low_b, middle_b, errors, None),
            (middle_a, high_a, middle_b, high_b, errors, None),
            (low_a, middle_a, middle_b, high_b, errors + 1, None),
            (middle_a, high_a, low_b, middle_b, errors + 1, same),
        ]
        kept = []
        for l1, h1, l2, h2, wrong, twice in children:
            live = (l1 < h1) & (l2 < h2) & (wrong <= budget)
            live &= True if twice is None else ~twice
            kept.append(np.stack([l1, h1, l2, h2, wrong])[:, live])
        joined = np.concatenate(kept, axis=1)
        for at in range(0, joined.shape[1], NODES):
            waiting.append((bit - 1, joined[:4, at : at + NODES], joined[4, at : at + NODES]))


def _hook(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Put the trees of i and j together, in place; every node points to the least node of its tree."""
    while True:
        ri, rj = root[i], root[j]
        apart = ri != rj
        if not apart.any():
            return
        i, j = i[apart], j[apart]
        np.minimum.at(root, np.maximum(ri, rj)[apart], np.minimum(ri, rj)[apart])
        while (jumped := root[root] != root).any():
            root[jumped] = root[root[jumped]]


def links(distinct: DataFrame, budget: int = 2) -> DataFrame:
    """u, v: a spanning forest of the fingerprints that differ in at most ``budget`` bits, in parts.

    ``distinct`` has one column, fingerprint, without repeats; it should be stored.
    """
    depth = max(0, (distinct.count() // SUBTREE).bit_length())
    ways = [0] + [1 << i for i in range(depth)] + [1 << i | 1 << j for i in range(depth) for j in range(i)]
    masks = [m for m in ways if m.bit_count() <= budget]
    if budget > 2:
        masks = [m for m in range(1 << depth) if m.bit_count() <= budget]
    top = F.shiftrightunsigned("fingerprint", BITS - depth) if depth else F.lit(0).cast("long")
    pairs = (
        distinct.withColumn("own", top)
        .withColumn("mask", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])))
        .select(
            F.least("own", F.col("own").bitwiseXOR(F.col("mask"))).alias("a"),
            F.greatest("own", F.col("own").bitwiseXOR(F.col("mask"))).alias("b"),
            "own",
            "fingerprint",
        )
    )

    def forest(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        a, b = (x.as_py() for x in key)
        marks = np.sort(table.column("fingerprint").to_numpy().view(np.uint64))
        root = np.arange(len(marks))
        shift = np.uint64(BITS - depth) if depth else None
        cut = int(np.searchsorted(marks >> shift, b)) if a != b else 0
        ranges = ((0, cut), (cut, len(marks))) if a != b else ((0, len(marks)), (0, len(marks)))
        if all(low < high for low, high in ranges):
            for i, j in close_pairs(marks, *ranges, depth, budget):
                _hook(root, i, j)
        tied = np.flatnonzero(root != np.arange(len(marks)))
        signed = marks.view(np.int64)
        return pa.table({"u": signed[tied], "v": signed[root[tied]]})

    return pairs.select("a", "b", "fingerprint").groupBy("a", "b").applyInArrow(forest, "u bigint, v bigint")


def classes(documents: DataFrame, budget: int = 2, width: int = 3) -> DataFrame:
    """doc_id, fingerprint (long), component_id: the least doc_id of the class, for every row."""
    marked = stored(fingerprints(documents, width))
    distinct = stored(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    nodes = distinct.select(F.col("fingerprint").alias("node"), "least")
    rooted = stored(with_component(nodes, links(distinct.select("fingerprint"), budget)))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select(F.col("node").alias("named"), "component_id")
    return marked.join(named, F.col("fingerprint") == F.col("named")).select("doc_id", "fingerprint", "component_id")


def first_of_each_class(documents: DataFrame, budget: int = 2, width: int = 3) -> DataFrame:
    """The document of every class that names it. Rows that repeat its doc_id stay, as do all rows without a doc_id."""
    named = classes(documents, budget, width).filter("doc_id = component_id")
    kept = named.select(F.col("doc_id").alias("kept_id")).distinct()
    found = documents.join(kept, F.col("doc_id") == F.col("kept_id"), "left_semi")
    return found.unionByName(documents.filter("doc_id is null"))

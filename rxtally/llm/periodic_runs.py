"""Periodic runs of words (operator 11): difference-cover extensions drive a harmonic grid of run candidates.

A run with period q has at least ``max(LEAST, EXPONENT * q)`` words, so the places whose word equals the one q further
on make a stretch of at least ``step(q)``. A grid of every ``step(q)``-th place therefore meets each run of that
period, and all grids of a text of n words have about ``n * ln(n) / 3`` places. Where a grid place's word is repeated
q words on, extensions to the right and to the left (``common_prefix.Extensions`` over the words and over their
reverse) give the whole stretch in constant time, whatever its length. A stretch is found for multiples of its period
too; as it has four periods, they span the same words, and the least one stays.

Texts are worked on in blocks of about ``WORDS`` words of a partition's rows, parted by values that occur once; a
longer text is a block of its own. There is no shuffle, and a text never leaves its row.

Defined results: null and empty texts have no words and no runs. A null doc_id is hashed as an empty text. Repeated
rows come out as often as they stand in the input. An empty table gives an empty table. Only named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxtally.llm.common_prefix import Extensions

LEAST = 6
EXPONENT = 4
WORDS = 1 << 19  # words of a block
PLACES = 1 << 21  # grid places looked at together


def step(period: np.ndarray) -> np.ndarray:
    """The shortest stretch of repeated words that a run of that period has."""
    return np.maximum(LEAST, EXPONENT * period) - period


def numbered(texts: Iterable[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words with a value of its own before, between and after texts; where each text begins."""
    known: dict[bytes, int] = {}
    parts, sizes = [], []
    for words in texts:
        parts.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)))
        sizes.append(len(words) + 1)
    starts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]) + 1
    values = np.empty(starts[-1], np.int64)
    values[starts - 1] = len(known) + np.arange(len(starts))
    for start, part in zip(starts, parts):
        values[start : start + len(part)] = part
    return values, starts


def grid(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of all grids of all texts, some of them at a time."""
    periods = np.where(sizes >= LEAST, np.maximum(sizes // EXPONENT, 1), 0)
    text = np.repeat(np.arange(len(sizes)), periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    stride = step(period)
    counts = (sizes[text] - period + stride - 1) // stride
    ends = np.cumsum(counts)
    low = 0
    while low < len(text):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + PLACES, "right")))
        own = counts[low:high]
        inside = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        yield (
            np.repeat(starts[text[low:high]], own) + inside * np.repeat(stride[low:high], own),
            np.repeat(period[low:high], own),
        )
        low = high


def runs(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, length, period of every run, by start and period; starts are places in ``values``."""
    found = []
    for place, period in grid(starts, sizes):
        hit = values[place] == values[place + period]
        found.append(np.stack([place[hit], period[hit]]))
    place, period = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    if not len(place):
        return np.zeros((0, 3), np.int64)
    right = Extensions(values)(place, place + period)
    n = len(values)
    left = Extensions(values[::-1])(n - place, n - place - period)
    whole = left + right >= step(period)
    start, end, period = (place - left)[whole], (place + right + period)[whole], period[whole]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[first], end[first], period[first]
    order = np.lexsort((period, start))
    return np.stack([start[order], (end - start)[order], period[order]], axis=1)


def kept(size: int, found: np.ndarray) -> np.ndarray:
    """Which words are in no run after its first period."""
    cover = np.zeros(size + 1, np.int64)
    np.add.at(cover, found[:, 0] + found[:, 2], 1)
    np.add.at(cover, found[:, 0] + found[:, 1], -1)
    return np.cumsum(cover[:-1]) == 0


def runs_of_texts(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of every text, as ``runs`` gives them, with starts as word numbers."""
    values, starts = numbered(texts)
    sizes = np.diff(starts) - 1
    found = runs(values, starts[:-1], sizes)
    owner = np.searchsorted(starts, found[:, 0], "right") - 1
    found[:, 0] -= starts[owner]
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [found[a:b] for a, b in zip(bounds, bounds[1:])]


def in_blocks(rows: Iterable[tuple], words_of) -> Iterator[tuple[list[tuple], list[list[bytes]]]]:
    """Rows with their words, in blocks of about ``WORDS`` words."""
    held, texts, size = [], [], 0
    for row in rows:
        words = words_of(row)
        if held and size + len(words) > WORDS:
            yield held, texts
            held, texts, size = [], [], 0
        held.append(row)
        texts.append(words)
        size += len(words)
    if held:
        yield held, texts


def repeated_tail(words: list[bytes], key: str) -> list[bytes]:
    """The digest query's test case: one text in ten, by its key's checksum, ends in a repeated stretch."""
    mark, n = zlib.crc32(key.encode()), len(words)
    if mark % 10 or not n:
        return words
    g = mark // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    stretch = words[a : a + p]
    return words[:a] + (stretch * ((n - a) // len(stretch) + 1))[: n - a]


SHAPE = (
    "n_runs bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed binary"
)


def collapsed(documents: DataFrame, *keep: str, tails: bool = False) -> DataFrame:
    """The kept columns with n_runs, runs, and collapsed: the words outside runs or in their first period, as bytes.

    ``tails`` puts ``repeated_tail`` in place of each text; its key is doc_id.
    """
    rows = documents.select(
        *[F.col(name).alias(f"keep_{k}") for k, name in enumerate(keep)],
        (F.coalesce(F.col("doc_id").cast("string"), F.lit("")) if tails else F.lit("")).alias("key"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    fields = [documents.schema[name] for name in keep]
    shape = ", ".join([f"keep_{k} {f.dataType.simpleString()}" for k, f in enumerate(fields)] + [SHAPE])
    item = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def words_of(row: tuple) -> list[bytes]:
        words = row[2].split()
        return repeated_tail(words, row[1]) if tails else words

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            columns = [batch.column(k) for k in range(len(fields))]
            keys, contents = batch.column(len(fields)), batch.column(len(fields) + 1)
            rows = ((k, key.as_py(), text.as_py()) for k, (key, text) in enumerate(zip(keys, contents)))
            at = 0
            for held, texts in in_blocks(rows, words_of):
                own = runs_of_texts(texts)
                left = [
                    b" ".join([w for w, stays in zip(words, kept(len(words), r).tolist()) if stays] if len(r) else words)
                    for words, r in zip(texts, own)
                ]
                size = len(held)
                offsets = np.concatenate([[0], np.cumsum([len(r) for r in own])]).astype(np.int32)
                every = np.concatenate(own) if own else np.zeros((0, 3), np.int64)
                structs = pa.StructArray.from_arrays([pa.array(c) for c in every.T], fields=list(item))
                yield pa.record_batch(
                    [
                        *[c.slice(at, size) for c in columns],
                        pa.array(np.diff(offsets).astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets), structs),
                        pa.array(left, pa.binary()),
                    ],
                    names=[*[f"keep_{k}" for k in range(len(fields))], "n_runs", "runs", "collapsed"],
                )
                at += size

    made = rows.mapInArrow(batches, shape)
    return made.select(
        *[F.col(f"keep_{k}").alias(name) for k, name in enumerate(keep)], "n_runs", "runs", "collapsed"
    )


def digests(documents: DataFrame) -> DataFrame:
    """doc_id, the number of runs, the longest run, and digests of all runs and of the collapsed words."""
    found = collapsed(documents, "doc_id", tails=True)
    longest = F.array_min(
        F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", longest)
    return best.select(
        "doc_id",
        "n_runs",
        F.col("best.s").alias("start"),
        (-F.col("best.l")).alias("length"),
        F.col("best.p").alias("period"),
        F.expr("(1000 * -best.l) div best.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

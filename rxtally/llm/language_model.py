"""Interpolated modified Kneser-Ney language model (operator 1), counted in Spark and kept in sorted hash arrays.

Counting has one step for each order. Tasks reduce their texts to distinct n-grams with counts and send them, sorted and
packed, to the parts of their keys; parts add up what came. The highest order counts occurrences, each lower one the
different words in front, which a part knows for its own n-grams, as each n-gram is in one part alone. An n-gram's part
is that of the words between its first and its last one, so that a part has all n-grams of a context and all words in
front of an n-gram of the next lower order, and sends either once. Where the word before the last stands more than
``CELL`` times in the texts, its n-grams are spread over parts by their last word, as many as its count asks for.
Contexts are n-grams of the next lower order, but for those of a text's start alone: their totals and the numbers of
n-grams seen once, twice and more often go to the parts of that order, and are written beside its n-grams.

Words are cut and hashed from the bytes of a slice of texts at once. They are numbered by the place of their hash in
sorted arrays, the vocabulary. Each part of an order writes the sorted
hashes of its n-grams with their counts, and their totals as contexts, as files in the shared folder, which must be
mounted; tables between two orders are removed when the lower one is written. Scoring maps these files, each once for a
worker: it holds no part of the model itself, and workers of a machine share the pages they read. Texts are gathered as
for counting, so that what a look-up does in each part is spread over many tokens. Each distinct n-gram of theirs is
looked up once for its count and, as the context of the tokens behind it, for its totals. Probabilities are interpolated
from these.

Words are told apart by 64-bit hashes, n-grams by such of their words' numbers. The model has everything the training texts have: no
count is cut off, no n-gram pruned.

Defined results: null and empty texts have one token, the end. A word outside the vocabulary has the share of the
uniform part of the lowest order. A training table without texts gives N = 0, and every token the uniform probability.
Repeated rows count and are scored as often as they stand there. A null doc_id is hashed as an empty text and so held
out. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import os
import shutil
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxtally.llm.arrays import Parts, found, pack_columns, save, save_narrow, save_rows, sizes_of, unpack_columns
from rxtally.llm.storage import mounted_path, shared_folder
from rxtally.llm.text import crc_remainder

TEXT = 1 << 22  # bytes of text worked on together
LONG = 256  # bytes; longer words are hashed one by one
HELD = 1 << 21  # tokens gathered before their n-grams are sent or looked up
PART = 1 << 20  # tokens for each part of an order, where that gives more parts than the session has for shuffles
CELL = 1 << 17  # tokens; n-grams of a more frequent word are spread over parts
ORDER = 3  # words of the longest n-grams, unless a caller says otherwise
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def text_bytes(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


def mixed(numbers: np.ndarray, seed: np.ndarray | int = 0) -> np.ndarray:
    """A 64-bit hash of each number, chained to another."""
    with np.errstate(over="ignore"):
        x = numbers.astype(np.uint64) + (np.asarray(seed).astype(np.uint64, copy=False) * M2 + np.uint64(0x9E3779B97F4A7C15))
        x ^= x >> np.uint64(30)
        x *= M1
        x ^= x >> np.uint64(27)
        x *= M2
        x ^= x >> np.uint64(31)
        return x


def word_hashes(data: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word of the data, by its size and its bytes, eight at a time; the words leave 8 bytes behind them."""
    blocks = np.frombuffer(data, "<u8", len(data) // 8)
    out, left, at, words = mixed(sizes), sizes, starts, np.arange(len(sizes))
    for word in np.flatnonzero(sizes > LONG).tolist():
        own = hashlib.blake2b(data[starts[word] : starts[word] + sizes[word]], digest_size=8).digest()
        out[word] = mixed(np.frombuffer(own, np.uint64), out[word])[0]
    open_ = np.flatnonzero(sizes <= LONG)
    while len(open_):
        at, left, words = at[open_], left[open_], words[open_]
        place, shift = at >> 3, ((at & 7) << 3).astype(np.uint64)
        # Two neighbouring blocks hold the eight bytes; a shift by 64 bits is none, so the second one takes two.
        block = blocks[place] >> shift | blocks[place + 1] << (np.uint64(63) - shift) << np.uint64(1)
        unused = (np.maximum(8 - left, 0) << 3).astype(np.uint64)
        out[words] = mixed(block << unused, out[words])
        at, left = at + 8, left - 8
        open_ = np.flatnonzero(left > 0)
    return out


def token_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each lower-case word of texts, and one for the end of each text; where each text's begin."""
    data = b" ".join([b"", *texts, b" " * 16]).lower()  # of bytes: A-Z alone
    codes = np.frombuffer(data, np.uint8)
    inside = (codes != 0x20) & (codes - np.uint8(9) > 4)
    # The data begin and end outside of words.
    changes = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = changes[::2], changes[1::2]
    text_ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    last = np.searchsorted(starts, text_ends) + np.arange(len(texts))
    hashes = np.empty(len(starts) + len(texts), np.uint64)
    word = np.ones(len(hashes), bool)
    word[last] = False
    hashes[word], hashes[last] = word_hashes(data, starts, ends - starts), mixed(np.zeros(1, np.int64))[0]
    return hashes, np.r_[0, last + 1]


def gram_hash(columns: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(columns[0]) if columns else 0, np.uint64)
    for column in columns:
        out = mixed(column, out)
    return out


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Parts by ranges of the hashes' upper half."""
    return ((hashes >> np.uint64(33)) * np.uint64(parts) >> np.uint64(31)).astype(np.int64)


@dataclass(frozen=True)
class Placement:
    """Which part an n-gram belongs to."""

    parts: int
    frequent: np.ndarray  # numbers of the words that stand more than ``CELL`` times, and of a text's start, sorted
    spread: np.ndarray  # over how many parts the n-grams go that have such a word before their last one

    def of(self, columns: list[np.ndarray]) -> np.ndarray:
        if len(columns) == 1:
            return part_of(mixed(columns[0]), self.parts)
        hit, place = found(self.frequent, columns[-2])
        # One part after the other, so that no two shares of a word meet in one.
        share = np.where(hit, columns[-1] % self.spread[place], 0)
        return (part_of(gram_hash(columns[1:-1] or columns[:1]), self.parts) + share) % self.parts


def sent_order(columns: list[np.ndarray]) -> list[np.ndarray]:
    """The word before the last in front: it differs least within a part, and rows are packed in its order."""
    return [columns[-2], *columns[:-2], columns[-1]] if len(columns) > 2 else columns


def text_order(columns: list[np.ndarray]) -> list[np.ndarray]:
    """What ``sent_order`` was made of."""
    return [*columns[1:-1], columns[0], columns[-1]] if len(columns) > 2 else columns


def sort_order(columns: list[np.ndarray]) -> np.ndarray:
    """The order of rows by columns of numbers from 0, the first column first; equal rows in any order.

    Numbers are packed into one 64-bit key. Bits of the last column that have no room there are compared afterwards,
    among the rows whose keys are equal.
    """
    widths = [max(int(c.max(initial=0)).bit_length(), 1) for c in columns]
    over = max(sum(widths) - 64, 0)
    if over >= widths[-1]:
        return np.lexsort(columns[::-1])
    key = np.zeros(len(columns[0]), np.uint64)
    for column, width in zip(columns[:-1], widths):
        key = key << np.uint64(width) | column.astype(np.uint64)
    key = key << np.uint64(widths[-1] - over) | (columns[-1] >> over).astype(np.uint64)
    order = np.argsort(key)
    if over:
        key, last = key[order], columns[-1][order]
        same = key[1:] == key[:-1]
        run = np.concatenate([[0], np.cumsum(~same)])[: len(key)]
        uneven = np.zeros(run[-1] + 1 if len(run) else 0, bool)
        uneven[run[1:][same & (last[1:] != last[:-1])]] = True
        rows = np.flatnonzero(uneven[run])
        order[rows] = order[rows][np.lexsort((last[rows], key[rows]))]
    return order


def added_up(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of the columns, sorted, with the sums of their counts."""
    order = sort_order(columns)
    columns, counts = [c[order] for c in columns], counts[order]
    head = np.zeros(len(counts), bool)
    head[:1] = True
    for column in columns:
        head[1:] |= column[1:] != column[:-1]
    heads = np.flatnonzero(head)
    return [c[heads] for c in columns], np.add.reduceat(counts, heads) if len(heads) else counts


def by_part(part: np.ndarray) -> np.ndarray:
    """The order of rows by their part; rows of a part stay as they are."""
    return np.argsort(part.astype(np.uint16) if part.max(initial=0) < 1 << 16 else part, kind="stable")


def blobs(kind: str, part: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple]:
    """(part, kind, packed columns) for every part; the first column is kept by its differences."""
    order = by_part(part)
    sorted_part = part[order]
    heads = np.flatnonzero(np.r_[True, sorted_part[1:] != sorted_part[:-1]]).tolist() if len(part) else []
    for a, b in zip(heads, [*heads[1:], len(part)]):
        own = [c[order[a:b]] for c in columns]
        own[0] = np.diff(own[0], prepend=own[0].dtype.type(0))
        yield int(sorted_part[a]), kind, [pack_columns(own)]


def unblobbed(rows: list[list[bytes]]) -> list[np.ndarray]:
    columns = [*zip(*(unpack_columns(blob) for (blob,) in rows))]
    return [np.concatenate([np.cumsum(x) for x in columns[0]]), *(np.concatenate(c) for c in columns[1:])]


SHAPE = "part int, kind string, columns array<binary>"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    part, kind, columns = zip(*rows) if rows else ((), (), ())
    arrays = [pa.array(part, pa.int32()), pa.array(kind, pa.string()), pa.array(columns, pa.list_(pa.binary()))]
    return pa.record_batch(arrays, names=["part", "kind", "columns"])


@dataclass(frozen=True)
class Vocabulary:
    """Sorted arrays of word hashes by part; a word's number is its place in all of them."""

    files: Parts
    tokens: int
    frequent: tuple[tuple[int, int], ...]  # numbers and counts of words that stand more than ``CELL`` times

    def placement(self, parts: int, cell: int) -> Placement:
        spread = [min(n // cell + 1, parts) for _, n in self.frequent]
        # Texts have one end each: their starts are no more than the tokens of the most frequent word.
        numbers, spread = [*(word for word, _ in self.frequent), self.start], [*spread, max(spread, default=1)]
        return Placement(parts, np.array(numbers, np.int64), np.array(spread, np.int64))

    @property
    def parts(self) -> int:
        return len(self.files)

    @property
    def size(self) -> int:
        return sum(self.files.sizes)

    @property
    def unknown(self) -> int:
        return self.size

    @property
    def start(self) -> int:
        return self.size + 1

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and training counts of words; ``unknown`` and 0 for others."""
        distinct, back = np.unique(hashes, return_inverse=True)
        ids, counts = np.full(len(distinct), self.unknown, np.int64), np.zeros(len(distinct), np.int64)
        bounds = np.searchsorted(part_of(distinct, self.parts), np.arange(self.parts + 1))
        for p in np.flatnonzero(np.diff(bounds)):
            own = slice(bounds[p], bounds[p + 1])
            hit, place = found(self.files("words", p), distinct[own])
            if hit.any():
                ids[own][hit] = place[hit] + self.files.offsets[p]
                counts[own][hit] = self.files.narrow("word-counts", p, place[hit])
        return ids[back], counts[back]


def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct hashes of a task's words with counts, for every ``HELD`` tokens or so."""
    held, size = [], 0

    def sent() -> pa.RecordBatch:
        distinct, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.record_batch([pa.array(distinct.view(np.int64)), pa.array(n)], names=["hash", "n"])

    for _, hashes, _ in pieces(batches, 0):
        held.append(hashes)
        size += len(hashes)
        if size >= HELD:
            yield sent()
            held, size = [], 0
    if size:
        yield sent()


def count_words(documents: DataFrame, folder: str, parts: int, cell: int) -> Vocabulary:
    texts = documents.select(text_bytes(F.col("text")).alias("text"))
    upper = F.shiftrightunsigned("hash", 33)
    counts = texts.mapInArrow(word_counts, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n")).select(
        F.shiftright(upper * parts, 31).cast("int").alias("part"), "hash", "n"
    )

    def write(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        hashes, n = table.column("hash").to_numpy().view(np.uint64), table.column("n").to_numpy()
        order = np.argsort(hashes)
        save(f"{folder}/words-{key[0].as_py()}.npy", hashes[order])
        save_narrow(folder, "word-counts", key[0].as_py(), n[order])
        frequent = np.flatnonzero(n[order] > cell)
        lists = [pa.array([x.tolist()], pa.list_(pa.int64())) for x in (frequent, n[order][frequent])]
        columns = [pa.array([key[0].as_py()], pa.int32()), [len(n)], [int(n.sum())], *lists]
        return pa.table(columns, names=["part", "size", "tokens", "places", "counts"])

    shape = "part int, size bigint, tokens bigint, places array<bigint>, counts array<bigint>"
    made = counts.groupBy("part").applyInArrow(write, shape).collect()
    files = Parts(folder, sizes_of([(row["part"], row["size"]) for row in made], parts))
    frequent = [(int(files.offsets[row["part"]]) + at, n) for row in made for at, n in zip(row["places"], row["counts"])]
    return Vocabulary(files, sum(row["tokens"] for row in made), tuple(sorted(frequent)))


def pieces(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of batches of about ``TEXT`` bytes, with the hashes of their tokens and where each row's begin."""
    for batch in batches:
        ends, at = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(), dtype=np.int64), 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TEXT, "right")))
            own = batch.slice(at, end - at)
            yield own, *token_hashes(own.column(column).to_pylist())
            at = end


def histories(ids: np.ndarray, offsets: np.ndarray, order: int, start: int) -> list[np.ndarray]:
    """The columns of every token's n-gram: ``order - 1`` words in front of it, and itself."""
    inside = np.arange(len(ids)) - np.repeat(offsets[:-1], np.diff(offsets))
    columns = []
    for back in range(order - 1, 0, -1):
        before = np.full(len(ids), start, ids.dtype)
        before[back:] = ids[:-back] if back < len(ids) else before[back:]
        columns.append(np.where(inside >= back, before, start))
    return [*columns, ids]


def gather(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, order: int, placement: Placement) -> Iterator[pa.RecordBatch]:
    """Packed distinct n-grams of a task's texts."""
    held, size = [], 0
    kind = np.int32 if vocabulary.start < 1 << 31 else np.int64

    def sent() -> pa.RecordBatch:
        columns, counts = added_up(sent_order([np.concatenate(c) for c in zip(*held)]), np.ones(size, np.int32))
        return _batch(list(blobs("grams", placement.of(text_order(columns)), [*columns, counts])))

    for _, hashes, offsets in pieces(batches, 0):
        ids, _ = vocabulary.look_up(hashes)
        held.append(histories(ids.astype(kind), offsets, order, vocabulary.start))
        size += len(ids)
        if size >= HELD:
            yield sent()
            held, size = [], 0
    if size:
        yield sent()


def write_order(part: int, rows: dict[str, list], folder: str, order: int, placement: Placement) -> Iterator[pa.RecordBatch]:
    """Write one part's n-grams and their totals as contexts; give on what the next lower order needs."""
    nothing = [np.zeros(0, np.int64)] * (order + 1)
    merged = unblobbed(rows["grams"]) if rows.get("grams") else nothing
    packed, counts = added_up(merged[:-1], merged[-1])
    columns = text_order(packed)
    seen = np.bincount(np.minimum(counts, 5), minlength=6)[1:5]
    keys, totals = gram_hash(columns), None
    place = np.argsort(keys)
    every, own = keys[place], counts[place]
    if rows.get("contexts"):
        contexts, sums = total_contexts(rows["contexts"])
        # Only texts' starts are contexts and no n-grams: they get a count of 0.
        starts = contexts[~found(every, contexts)[0]]
        at = np.searchsorted(every, starts)
        every, own = np.insert(every, at, starts), np.insert(own, at, 0)
        totals = np.zeros((len(every), 4), np.int64)
        totals[np.searchsorted(every, contexts)] = sums
    save_order(folder, order, part, every, own, totals)
    out = [(part, "seen", [seen.astype(np.int64).tobytes(), np.int64(len(every)).tobytes(), np.int64(totals is not None).tobytes()])]
    if len(counts):
        # Sorted rows have those of a context together.
        head = np.zeros(len(counts), bool)
        head[0] = True
        for column in packed[:-1]:
            head[1:] |= column[1:] != column[:-1]
        heads = np.flatnonzero(head)
        sums = [np.add.reduceat(g.astype(np.int64), heads) for g in (counts, counts == 1, counts == 2, counts > 2)]
        if order > 1:
            contexts = [c[heads] for c in columns[:-1]]
            by = sort_order(sent_order(contexts))  # differences of sorted numbers are short
            contexts, sums = [c[by] for c in contexts], [x[by] for x in sums]
            out += blobs("contexts", placement.of(contexts), [*sent_order(contexts), *sums])
            lower, different = added_up(sent_order(columns[1:]), np.ones(len(counts), np.int64))
            out += blobs("grams", placement.of(text_order(lower)), [*lower, different])
        else:
            out += blobs("contexts", np.zeros(1, np.int64), [np.zeros(1, np.int64), *sums])
    yield _batch(out)


def total_contexts(rows: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of distinct contexts, sorted, with the sums of their totals."""
    merged = unblobbed(rows)
    hashes = gram_hash(text_order(merged[:-4]))
    order_by = np.argsort(hashes)
    keys = hashes[order_by]
    heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[heads], np.stack([np.add.reduceat(c[order_by], heads) for c in merged[-4:]], axis=1)


def save_order(folder: str, order: int, part: int, keys: np.ndarray, counts: np.ndarray, totals: np.ndarray | None) -> None:
    """Sorted hashes of n-grams, their counts, and their totals as contexts, if the part has such."""
    save(f"{folder}/grams-{order}-{part}.npy", keys)
    save_narrow(folder, f"counts-{order}", part, counts)
    if totals is not None:
        save_rows(folder, f"totals-{order}", part, totals)


def distinct(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct n-gram, by their hashes, and for every row the number of its own."""
    keys = gram_hash(columns)
    order = np.argsort(keys)
    keys = keys[order]
    head = np.ones(len(keys), bool)
    head[1:] = keys[1:] != keys[:-1]
    which = np.empty(len(keys), np.int32)
    which[order] = np.cumsum(head, dtype=np.int32) - 1
    return order[head], which


@dataclass(frozen=True)
class Model:
    vocabulary: Vocabulary
    order: int
    discounts: tuple[tuple[float, float, float, float], ...]  # by order from 1, for counts of 0, 1, 2 and more
    grams: tuple[Parts, ...]  # the files of each order's n-grams, with their counts and their totals as contexts
    totals: tuple[frozenset[int], ...]  # the parts of each order that have contexts
    placement: Placement
    whole: tuple[int, int, int, int]  # totals of the empty context

    def _looked_up(self, columns: list[np.ndarray], as_context: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """The counts of n-grams, and their totals as contexts if asked for; zeros for n-grams that are not there."""
        n = len(columns)
        files = self.grams[n - 1]
        part, keys = self.placement.of(columns), gram_hash(columns)
        # By part and hash; hashes that are sorted already stay as they are.
        order = by_part(part) if (keys[1:] >= keys[:-1]).all() else np.lexsort((keys, part))
        keys, counts, totals = keys[order], np.zeros(len(keys), np.int64), np.zeros((len(keys) * as_context, 4), np.int64)
        bounds = np.searchsorted(part[order], np.arange(len(files) + 1))
        for p in np.flatnonzero(np.diff(bounds)).tolist():
            a, b = bounds[p], bounds[p + 1]
            hit, place = found(files(f"grams-{n}", p), keys[a:b])
            own = np.flatnonzero(hit)
            if len(own):
                place, own = place[own], order[own + a]
                counts[own] = files.narrow(f"counts-{n}", p, place)
                if as_context and p in self.totals[n - 1]:
                    totals[own] = files.rows(f"totals-{n}", p, place)
        return counts, totals

    def _left(self, n: int, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of contexts of order ``n``: their total, 0 if there is none, and the weight that they leave to the lower order."""
        discount, total = self.discounts[n - 1], np.maximum(totals[:, 0], 1)
        return totals[:, 0], (totals[:, 1] * discount[1] + totals[:, 2] * discount[2] + totals[:, 3] * discount[3]) / total

    def _interpolated(self, n: int, counts: np.ndarray, total: np.ndarray, left: np.ndarray, lower: np.ndarray) -> np.ndarray:
        direct = (counts - np.array(self.discounts[n - 1])[np.minimum(counts, 3)]) / np.maximum(total, 1)
        return np.where(total > 0, direct + left * lower, lower)

    def probabilities(self, columns: list[np.ndarray]) -> np.ndarray:
        """The interpolated probability of each row's last word after the words in front."""
        chance = np.full(len(columns[-1]), 1 / (self.vocabulary.size + 1))
        for n in range(1, self.order + 1):
            own = columns[self.order - n :]
            totals = self._looked_up(own[:-1])[1] if n > 1 else np.tile(np.array(self.whole, np.int64), (len(chance), 1))
            chance = self._interpolated(n, self._looked_up(own, False)[0], *self._left(n, totals), chance)
        return chance

    def text_probabilities(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The same for every token of texts, none empty: a token's context is the n-gram that ends in front of it."""
        chance = np.full(len(ids), 1 / (self.vocabulary.size + 1))
        begins = offsets[:-1]
        # Contexts of one order, at first the empty one alone, and which of them stands in front of each token.
        total, left = self._left(1, np.array([self.whole], np.int64))
        before = np.zeros(len(ids), np.int32)
        for n in range(1, self.order + 1):
            columns = histories(ids, offsets, n, self.vocabulary.start)
            first, which = distinct(columns)
            columns = [c[first] for c in columns]
            counts, behind = self._looked_up(columns, n < self.order)
            at = before[first]
            chance = self._interpolated(n, counts, total[at], left[at], chance[first])[which]
            if n < self.order:
                behind = np.append(behind, self._looked_up([np.full(1, self.vocabulary.start)] * n)[1], axis=0)
                total, left = self._left(n + 1, behind)
                before[1:], before[begins] = which[:-1], len(behind) - 1
        return chance


def discounts(seen: np.ndarray) -> tuple[float, float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of n-grams seen once to four times.

    Every discount lies above 0, so that each context leaves some weight to the lower order. Where an estimate does not,
    as in tables of many copies, one absolute discount takes the place of all three.
    """
    n1, n2, n3, n4 = (float(x) for x in seen)
    if not (n1 and n2 and n3):
        return 0.0, 0.5, 0.5, 0.5  # too few n-grams to estimate from
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return (0.0, *(min(d, float(k)) for k, d in enumerate(raw, 1))) if min(raw) > 0 else (0.0, y, y, y)


def _writer(folder: str, order: int, placement: Placement):
    def write(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        own: dict[str, list] = {}
        for kind, columns in zip(table.column("kind").to_pylist(), table.column("columns").to_pylist()):
            own.setdefault(kind, []).append(columns)
        return pa.Table.from_batches(write_order(key[0].as_py(), own, folder, order, placement))

    return write


def train(documents: DataFrame, order: int = ORDER, cell: int = CELL) -> Model:
    """Count the texts of ``documents`` and write the model's arrays."""
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = mounted_path(shared_folder(spark))
    os.makedirs(folder, exist_ok=True)
    with shuffles_removed(spark):
        vocabulary = count_words(documents, folder, parts, cell)
        parts = max(parts, -(-vocabulary.tokens // PART))
        placement = vocabulary.placement(parts, cell)
        texts = documents.select(text_bytes(F.col("text")).alias("text"))
        rows = texts.mapInArrow(lambda b: gather(b, vocabulary, order, placement), SHAPE)
        found_discounts, files, totals, before = [], [], [], None
        for n in range(order, 0, -1):
            path = f"{folder}/made-{n}"
            rows.filter("kind != 'seen'").groupBy("part").applyInArrow(_writer(folder, n, placement), SHAPE).write.parquet(f"file://{path}")
            if before:
                shutil.rmtree(before)
            rows, before = spark.read.schema(SHAPE).parquet(f"file://{path}"), path
            seen = rows.filter("kind = 'seen'").select("part", "columns").collect()  # one short row from each part
            found_discounts.insert(0, discounts(sum((np.frombuffer(r[1][0], np.int64) for r in seen), np.zeros(4, np.int64))))
            files.insert(0, Parts(folder, sizes_of([(r[0], np.frombuffer(r[1][1], np.int64)[0]) for r in seen], parts)))
            totals.insert(0, frozenset(r[0] for r in seen if np.frombuffer(r[1][2], np.int64)[0]))
    # The empty context has one short row from each part of the lowest order.
    last = [r["columns"] for r in rows.filter("kind = 'contexts'").select("columns").collect()]
    whole = tuple(int(x) for x in total_contexts(last)[1][0]) if last else (0, 0, 0, 0)
    return Model(vocabulary, order, tuple(found_discounts), tuple(files), tuple(totals), placement, whole)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Have Spark remove the shuffle files of a step when it has ended: what follows reads what the step wrote."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """The columns of ``scored`` for batches of doc_id and text, for every ``HELD`` tokens or so."""
    words, n_train, held, size = model.vocabulary, model.vocabulary.tokens, [], 0
    kind = np.int32 if words.start < 1 << 31 else np.int64

    def done() -> pa.RecordBatch:
        docs, n_tokens, n_known, base, ids = zip(*held)
        n_tokens = np.concatenate(n_tokens)
        offsets = np.r_[0, np.cumsum(n_tokens)]
        chance = model.text_probabilities(np.concatenate(ids), offsets)
        sums = np.add.reduceat(np.log10(chance), offsets[:-1])
        columns = [n_tokens, np.concatenate(n_known), np.full(len(n_tokens), n_train, np.int64), np.concatenate(base), sums]
        return pa.record_batch([pa.concat_arrays(docs), *map(pa.array, columns)], names=NAMES)

    for part, hashes, offsets in pieces(batches, 1):
        ids, counts = words.look_up(hashes)
        base = np.log10((counts + 0.1) / (n_train + 0.1 * (words.size + 1)))
        n_known, base = (np.add.reduceat(x, offsets[:-1]) for x in ((counts > 0).astype(np.int64), base))
        held.append((part.column(0), np.diff(offsets), n_known, base, ids.astype(kind)))
        size += len(ids)
        if size >= HELD:
            yield done()
            held, size = [], 0
    if held:
        yield done()


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", text_bytes(F.col("text")).alias("text"))

    shape = f"doc_id {kind}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return rows.mapInArrow(lambda batches: score(batches, model), shape)


NAMES = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def held_out_scores(documents: DataFrame, order: int = ORDER, folds: int = 10) -> DataFrame:
    """All documents scored by a model of those that are not held out, with perplexity for each token."""
    held_out = crc_remainder(F.col("doc_id"), folds) == 0
    found_scores = scored(documents, train(documents.filter(~held_out), order))
    perplexity = F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
    return found_scores.select("doc_id", held_out.alias("held_out"), *NAMES[1:], perplexity.alias("perplexity"))

"""Removal of repeated byte strings by the suffixes of many documents (operator 8).

A byte goes if a string of ``WIDTH`` bytes over it also starts in a document with a smaller doc_id. Whole documents
would need as many rounds of the column-wise construction as the longest has bytes, and one place for all suffixes, so
the collection is cut first, by content, into parts that share no string of ``WIDTH`` bytes:

1.  Each window of ``WIDTH`` bytes has an anchor, the substring of ``GRAM`` bytes in it with the least hash, the first
    of equals. Equal windows have equal anchors. Windows in a row with the same anchor make a fragment of at most
    ``2 * WIDTH - GRAM`` bytes. A first pass gathers the hashes of anchors, sorted and packed to about three bytes each,
    and keeps those that come from more than one document.
2.  A second pass sends the distinct fragments at these anchors, each with the least doc_id it has in a task, to the
    part of their anchor. The different fragments of an anchor are a collection: a part builds the transform and common
    prefixes of its collections, one symbol of each string a round (``collection_bwt``), in sets of about ``STRINGS``
    strings. (If all documents have the same fragment at an anchor, its collection is one string and there is nothing
    to sort.) A set of over ``LARGE`` strings is built in sequential files of the shared folder (``external_bwt``), so that
    its rows, about 70 for each string, are never held. Neighbours with a common prefix of ``WIDTH`` or more are the
    same window; the least doc_id of each such run goes into sorted arrays, a fragment's hash with its windows.
3.  A third pass maps these arrays, looks up each document's fragments, and marks the bytes of windows whose least
    doc_id is smaller than its own.

Texts do not move between tasks, only fragments that share an anchor with another document do, once for a task however
often they occur. A passage in a third of all documents is so one row from each task. The arrays are read through
memory-mapped files in the shared folder, which must be mounted; a task that is run again writes the same files again.
Parts follow ``spark.sql.shuffle.partitions``, like those of any shuffle. All fragments of one anchor are in one part
and set; what may make that large is only the number of different texts around one string of ``GRAM`` bytes.

Hashes of anchors only choose what is compared, and a chance agreement costs work, not bytes. Fragments are told apart
by 64-bit hashes within a part when they are looked up.

Defined results: a null text is empty. Documents with a null doc_id neither lose bytes nor take any. Rows with the same
doc_id do not take from each other. Repeated rows lose the same bytes. Texts under ``WIDTH`` bytes stay whole. An empty
table gives an empty table. Only doc_id and text are read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxtally.llm import collection_bwt, external_bwt
from rxtally.llm.arrays import Parts, pack, save, sizes_of, unpack
from rxtally.llm.storage import mounted_path, shared_folder

WIDTH = 50
GRAM = 24
SPAN = WIDTH - GRAM + 1  # places of an anchor in a window
KEY_BITS = 40
CHUNK = 1 << 16  # bytes looked at together: the arrays stay in a core's cache
HELD = 1 << 21  # anchors or fragments gathered before they are sent
STRINGS = 4096
LARGE = 1 << 16  # strings of a set that is built in files
NO_DOC = np.iinfo(np.int64).max
BYTE_HASH = np.random.default_rng(50).integers(0, 2**64, 256, dtype=np.uint64)
ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Runs:
    """Windows in a row with one anchor: the row they are in, first byte in the buffer, number, and anchor's hash."""

    row: np.ndarray
    start: np.ndarray
    count: np.ndarray
    key: np.ndarray


def gram_keys(data: np.ndarray) -> np.ndarray:
    """A ``KEY_BITS`` hash of the ``GRAM`` bytes from every place, by doubling."""
    power, length = ODD, 1
    part, out, done = BYTE_HASH[data], None, 0
    powers = {1: ODD}
    while True:
        if GRAM & length:
            if out is None:
                out, done = part, length
            else:
                n = len(data) - done - length + 1
                out = part[:n] * _power(powers, done) + out[length : length + n]
                done += length
        if 2 * length > GRAM:
            break
        n = len(part) - length
        part = part[:n] * powers[length] + part[length : length + n]
        power = power * power
        length *= 2
        powers[length] = power
    out = out ^ (out >> np.uint64(32))
    out = out * ODD
    return out >> np.uint64(64 - KEY_BITS)


def _power(powers: dict[int, np.uint64], exponent: int) -> np.uint64:
    out = np.uint64(1)
    for length, value in powers.items():
        if exponent & length:
            out = out * value
    return out


def chunk_runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, count, key) of the fragments of a buffer; ``ends``: for every window the end of its document."""
    keys = gram_keys(data)
    packed = keys << np.uint64(24) | np.arange(len(keys), dtype=np.uint64)
    size, least = 1, packed
    while 2 * size <= SPAN:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = SPAN - size
    least = np.minimum(least[: len(least) - rest], least[rest:])
    valid = np.arange(len(least)) + WIDTH <= ends
    head = valid.copy()
    head[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    tail = valid.copy()
    tail[:-1] &= ~valid[1:] | (least[1:] != least[:-1])
    start = np.flatnonzero(head)
    return start, np.flatnonzero(tail) - start + 1, spread_out(least[start] >> np.uint64(24))


def spread_out(keys: np.ndarray) -> np.ndarray:
    """A one-to-one mix of the hashes: as the least of their windows they are all small, and parts are ranges."""
    mask, half = np.uint64((1 << KEY_BITS) - 1), np.uint64(KEY_BITS // 2)
    for _ in range(2):
        keys = keys * ODD & mask
        keys = keys ^ (keys >> half)
    return keys


def runs_of(buffer: np.ndarray, offsets: np.ndarray) -> Iterator[Runs]:
    """Runs of the rows ``buffer[offsets[i]:offsets[i + 1]]``, a bounded number of bytes at a time."""
    begin, last = int(offsets[0]), int(offsets[-1])
    with np.errstate(over="ignore"):
        while begin + WIDTH <= last:
            end = min(begin + CHUNK, last)  # windows that start in here
            stop = min(end + WIDTH - 1, last)
            at = np.arange(begin, stop - WIDTH + 1)
            row = np.searchsorted(offsets, at, "right") - 1
            start, count, key = chunk_runs(buffer[begin:stop], offsets[row + 1] - begin)
            yield Runs(row[start], start + begin, count, key)
            begin = end


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of strings and where each begins, without a copy."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (keys * np.uint64(parts)) >> np.uint64(KEY_BITS)


def anchors(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """part, keys: sorted hashes of anchors, with a last bit for those that are in several documents of this task."""
    keys, docs, held = [], [], 0

    def sent() -> pa.RecordBatch:
        key, doc = np.concatenate(keys), np.concatenate(docs)
        order = np.argsort(key, kind="stable")
        key, doc = key[order], doc[order]
        heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        several = np.minimum.reduceat(doc, heads) != np.maximum.reduceat(doc, heads)
        entries = (key[heads] << np.uint64(1) | several.astype(np.uint64)).astype(np.int64)
        bounds = np.searchsorted(part_of(key[heads], parts), np.arange(parts + 1))
        filled = np.flatnonzero(np.diff(bounds))
        blobs = [pack(np.diff(entries[bounds[p] : bounds[p + 1]], prepend=0)) for p in filled]
        return pa.record_batch([pa.array(filled.astype(np.int32)), pa.array(blobs, pa.binary())], names=["part", "keys"])

    for batch in batches:
        (buffer, offsets), ids = text_buffer(batch.column(1)), batch.column(0)
        known, doc = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
        for runs in runs_of(buffer, offsets):
            mine = known[runs.row]
            keys.append(runs.key[mine])
            docs.append(doc[runs.row[mine]])
            held += int(mine.sum())
            if held >= HELD:
                yield sent()
                keys, docs, held = [], [], 0
    if held:
        yield sent()


def repeated(table: pa.Table) -> np.ndarray:
    """Hashes that several documents have: those marked in one blob, or found in two."""
    entries = np.sort(np.concatenate([np.cumsum(unpack(b)) for b in table.column("keys").to_pylist()]))
    key = entries >> 1
    twice = np.zeros(len(key), bool)
    same = key[1:] == key[:-1]
    twice[1:] |= same
    twice[:-1] |= same
    return np.unique(key[twice | (entries & 1).astype(bool)])


def shared_runs(runs: Runs, shared: Parts) -> np.ndarray:
    """Which runs have an anchor that several documents have."""
    order = np.argsort(runs.key, kind="stable")
    key = runs.key[order].astype(np.int64)
    bounds = np.searchsorted(part_of(runs.key[order], len(shared)), np.arange(len(shared) + 1))
    hit = np.zeros(len(key), bool)
    for p in np.flatnonzero(np.diff(bounds)):
        known, asked = shared("anchors", p), key[bounds[p] : bounds[p + 1]]
        if len(known):
            place = np.minimum(np.searchsorted(known, asked), len(known) - 1)
            hit[bounds[p] : bounds[p + 1]] = known[place] == asked
    return np.sort(order[hit])


def fragments(batches: Iterator[pa.RecordBatch], shared: Parts) -> Iterator[pa.RecordBatch]:
    """part, keys, docs, lengths, bytes: distinct fragments with the least and largest doc_id they have here."""
    held: dict[bytes, list[int]] = {}
    parts = len(shared)

    def sent() -> pa.RecordBatch:
        texts, facts = list(held), np.array(list(held.values()), np.int64)
        order = np.argsort(facts[:, 0], kind="stable")
        bounds = np.searchsorted(part_of(facts[order, 0].astype(np.uint64), parts), np.arange(parts + 1))
        filled, rows = np.flatnonzero(np.diff(bounds)), []
        for p in filled:
            own = order[bounds[p] : bounds[p + 1]]
            mine = [texts[i] for i in own]
            numbers = [np.diff(facts[own, 0], prepend=0), facts[own, 1], facts[own, 2] - facts[own, 1]]
            body = zstandard.ZstdCompressor(level=1).compress(b"".join(mine))
            rows.append([*map(pack, numbers), pack(np.fromiter(map(len, mine), np.int64, len(mine))), body])
        columns = [pa.array(list(c), pa.binary()) for c in zip(*rows)]
        return pa.record_batch([pa.array(filled.astype(np.int32)), *columns], names=["part", *FRAGMENT_COLUMNS])

    for batch in batches:
        (buffer, offsets), ids = text_buffer(batch.column(1)), batch.column(0)
        known, doc = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
        view = memoryview(buffer)
        for runs in runs_of(buffer, offsets):
            use = shared_runs(runs, shared)
            use = use[known[runs.row[use]]]
            ends = runs.start[use] + runs.count[use] + WIDTH - 1
            owners, keys = doc[runs.row[use]].tolist(), runs.key[use].tolist()
            for s, e, d, key in zip(runs.start[use].tolist(), ends.tolist(), owners, keys):
                fact = held.get(text := bytes(view[s:e]))
                if fact is None:
                    held[text] = [key, d, d]
                elif d < fact[1]:
                    fact[1] = d
                elif d > fact[2]:
                    fact[2] = d
            if len(held) >= HELD // 16:
                yield sent()
                held.clear()
    if held:
        yield sent()


FRAGMENT_COLUMNS = ["keys", "least", "spread", "lengths", "bytes"]


def least_documents(table: pa.Table, folder: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """hash, first, offset, doc: for every fragment that may lose bytes, its windows' least doc_ids, in runs.

    The runs of fragment i are ``first[i]`` to ``first[i + 1]``; each holds from its offset on.
    """
    held: dict[bytes, list[int]] = {}
    for row in table.select(FRAGMENT_COLUMNS).to_pylist():
        numbers = [unpack(row[c]) for c in FRAGMENT_COLUMNS[:4]]
        body, at = zstandard.ZstdDecompressor().decompress(row["bytes"]), 0
        for key, low, spread, n in zip(np.cumsum(numbers[0]).tolist(), *(x.tolist() for x in numbers[1:])):
            text = body[at : at + n]
            at += n
            if (fact := held.get(text)) is None:
                held[text] = [key, low, low + spread]
            else:
                fact[1], fact[2] = min(fact[1], low), max(fact[2], low + spread)
    texts, facts = list(held), np.array(list(held.values()), np.int64)
    order = np.argsort(facts[:, 0], kind="stable")
    key = facts[order, 0]
    # Sets end where an anchor does.
    heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    cuts = [0]
    for end in [*heads[1:].tolist(), len(key)]:
        if end - cuts[-1] >= STRINGS:
            cuts.append(end)
    if cuts[-1] != len(key):
        cuts.append(len(key))
    hashes, counts, offsets, docs = [], [], [], []
    for a, b in zip(cuts, cuts[1:]):
        own = order[a:b]
        mine = [texts[i] for i in own]
        lengths = np.fromiter(map(len, mine), np.int64, len(mine))
        # The fragments of one anchor are a collection. One of a single string is sorted as it is: all its windows
        # have the string's own least doc_id. The others are built together.
        lone = np.r_[True, key[a + 1 : b] != key[a : b - 1]] & np.r_[key[a + 1 : b] != key[a : b - 1], True]
        several, single = np.flatnonzero(~lone), np.flatnonzero(lone)
        n = lengths[single] - WIDTH + 1
        string, least = np.repeat(single, n), np.repeat(facts[own, 1][single], n)
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        if len(several):
            text = np.frombuffer(b"".join(mine[i] for i in several.tolist()), np.uint8)
            starts = np.cumsum(lengths[several]) - lengths[several]
            collection = (text, starts, lengths[several], WIDTH, facts[own, 1][several])
            large = len(several) > LARGE
            classes = external_bwt.window_classes(*collection, folder) if large else collection_bwt.window_classes(*collection)
            string = np.concatenate([string, several[classes[0]]])
            offset, least = np.concatenate([offset, classes[1]]), np.concatenate([least, classes[2]])
        by_place = np.lexsort((offset, string))
        string, offset, least = string[by_place], offset[by_place], least[by_place]
        # Only windows with a smaller document than some holder of the fragment take bytes from one.
        taking = np.zeros(len(mine), bool)
        taking[string[least < facts[own, 2][string]]] = True
        head = np.r_[True, (string[1:] != string[:-1]) | (least[1:] != least[:-1])] & taking[string]
        hashes.append(np.array([xxhash.xxh64_intdigest(mine[i]) for i in np.flatnonzero(taking)], np.uint64))
        counts.append(np.bincount(string[head], minlength=len(mine))[taking])
        offsets.append(offset[head])
        docs.append(least[head])
    hashes, counts = np.concatenate(hashes), np.concatenate(counts)
    first = np.cumsum(counts) - counts
    by_hash = np.argsort(hashes)
    counts, first = counts[by_hash], first[by_hash]
    place = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    return hashes[by_hash], np.r_[0, np.cumsum(counts)], np.concatenate(offsets)[place], np.concatenate(docs)[place]


def covered(runs: Runs, use: np.ndarray, buffer, doc: np.ndarray, least_of: Parts):
    """First and end of the byte ranges that windows of the shared runs cover and a smaller document has."""
    view = memoryview(buffer)
    ends = runs.start[use] + runs.count[use] + WIDTH - 1
    hashes = np.array(
        [xxhash.xxh64_intdigest(view[s:e]) for s, e in zip(runs.start[use].tolist(), ends.tolist())], np.uint64
    )
    part = part_of(runs.key[use], len(least_of)).astype(np.int64)
    firsts, lasts = [], []
    for p in np.unique(part):
        known, first, offset, least = (least_of(name, p) for name in ARRAYS)
        mine = np.flatnonzero(part == p)
        if not len(known):
            continue
        place = np.minimum(np.searchsorted(known, hashes[mine]), len(known) - 1)
        hit = known[place] == hashes[mine]
        mine, place = mine[hit], place[hit]
        n = first[place + 1] - first[place]
        at = np.repeat(first[place] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        owner = np.repeat(use[mine], n)
        begin = offset[at]
        final = np.r_[owner[1:] != owner[:-1], True] if len(owner) else np.zeros(0, bool)
        end = np.where(final, runs.count[owner], np.r_[begin[1:], 0]) if len(owner) else begin
        takes = least[at] < doc[runs.row[owner]]
        firsts.append((runs.start[owner] + begin)[takes])
        lasts.append((runs.start[owner] + end + WIDTH - 1)[takes])
    empty = np.zeros(0, np.int64)
    return np.concatenate(firsts or [empty]), np.concatenate(lasts or [empty])


ARRAYS = ("hashes", "first", "offset", "least")


def removed_ranges(batch: pa.RecordBatch, ids: int, text: int, shared: Parts, least_of: Parts):
    """The buffer, where each row begins, and the maximal removed ranges: row, first byte, end."""
    (buffer, offsets), column = text_buffer(batch.column(text)), batch.column(ids)
    known, doc = column.is_valid().to_numpy(zero_copy_only=False), column.fill_null(0).to_numpy()
    change = np.zeros(int(offsets[-1] - offsets[0]) + 1, np.int32)
    for runs in runs_of(buffer, offsets):
        use = shared_runs(runs, shared)
        use = use[known[runs.row[use]]]
        first, last = covered(runs, use, buffer, doc, least_of)
        np.add.at(change, first - offsets[0], 1)
        np.add.at(change, last - offsets[0], -1)
    gone = np.cumsum(change, out=change)[:-1] > 0
    edge = gone.copy()
    edge[1:] &= ~gone[:-1]
    inner = offsets[1:-1] - offsets[0]  # a run ends with its document
    inner = inner[inner < len(gone)]
    edge[inner] = gone[inner]
    start = np.flatnonzero(edge)
    stop = gone.copy()
    stop[:-1] &= ~gone[1:] | edge[1:]
    end = np.flatnonzero(stop) + 1
    return buffer, offsets, np.searchsorted(offsets - offsets[0], start, "right") - 1, start, end


def index(documents: DataFrame) -> tuple[Parts, Parts]:
    """Passes one and two: the arrays of shared anchors and of their fragments' least documents."""
    spark = documents.sparkSession
    folder = mounted_path(shared_folder(spark))
    os.makedirs(folder, exist_ok=True)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def kept(key: tuple[pa.Scalar, ...], rows: np.ndarray) -> pa.Table:
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "kept": [len(rows)]})

    def keep_repeated(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        found = repeated(table)
        if len(found):
            save(f"{folder}/anchors-{key[0].as_py()}.npy", found)
        return kept(key, found)

    def keep_least(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        arrays = least_documents(table, folder)
        for name, array in zip(ARRAYS, arrays):
            save(f"{folder}/{name}-{key[0].as_py()}.npy", array)
        # The files are there even without a fragment that loses bytes.
        return kept(key, arrays[1])

    found = rows.mapInArrow(lambda b: anchors(b, parts), "part int, keys binary")
    written = found.groupBy("part").applyInArrow(keep_repeated, "part int, kept bigint").collect()  # a row for each part
    shared = Parts(folder, sizes_of(written, parts))
    shape = "part int, " + ", ".join(f"{c} binary" for c in FRAGMENT_COLUMNS)
    sent = rows.mapInArrow(lambda b: fragments(b, shared), shape)
    written = sent.groupBy("part").applyInArrow(keep_least, "part int, kept bigint").collect()
    return shared, Parts(folder, sizes_of(written, parts))


def whole_characters(buffer: np.ndarray, base: int, start: np.ndarray, end: np.ndarray):
    """The ranges without the characters that lie in them with only some of their bytes."""
    inner = np.append((buffer & 0xC0) == 0x80, False)
    for _ in range(3):  # a character has at most three bytes after its first
        start = start + inner[base + start]
    for _ in range(3):
        end = end - inner[base + end]
    return start, np.maximum(end, start)


RESULTS = {
    "kept_bytes": T.BinaryType(),
    "kept_text": T.StringType(),
    "spans": T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())])),
}


def deduplicated(documents: DataFrame, *keep: str, result: str = "kept_bytes") -> DataFrame:
    """The kept columns with n_bytes, n_removed, n_spans and one of the ``RESULTS``.

    ``kept_bytes`` has the bytes that stay; ``kept_text`` is made of whole characters, and one that loses only some of
    its bytes stays; ``spans`` has the removed ranges, first and end as byte places in the text.
    """
    shared, least_of = index(documents)
    names = [f"own_{i}" for i in range(len(keep))]
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(F.col("doc_id").alias("id_"), text.alias("text_"), *map(F.col, keep)).toDF("id_", "text_", *names)
    kinds = [T.StructField(n, documents.schema[c].dataType) for c, n in zip(keep, names)]
    results = [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
    results.append(T.StructField(result, RESULTS[result]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            buffer, offsets, row, start, end = removed_ranges(batch, 0, 1, shared, least_of)
            base, sizes = int(offsets[0]), np.diff(offsets)
            n = np.bincount(row, minlength=len(sizes))
            gone = np.bincount(row, end - start, len(sizes)).astype(np.int64)
            if result == "spans":
                own = (offsets[:-1] - base)[row]
                pairs = pa.StructArray.from_arrays([pa.array(start - own), pa.array(end - own)], ["first", "end"])
                last = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pairs)
            else:
                cut_sizes = gone
                if result == "kept_text":
                    start, end = whole_characters(buffer, base, start, end)
                    cut_sizes = np.bincount(row, end - start, len(sizes)).astype(np.int64)
                change = np.zeros(int(offsets[-1]) - base + 1, np.int8)
                np.add.at(change, start, 1)
                np.add.at(change, end, -1)
                kept = buffer[base : offsets[-1]][np.cumsum(change, out=change)[:-1] == 0]
                at = np.r_[0, np.cumsum(sizes - cut_sizes)].astype(np.int64)
                buffers = [None, pa.py_buffer(at.tobytes()), pa.py_buffer(kept.tobytes())]
                last = pa.Array.from_buffers(pa.large_binary(), len(sizes), buffers).cast(pa.binary())
                if result == "kept_text":
                    last = last.cast(pa.string())
            columns = [*batch.columns[2:], pa.array(sizes), pa.array(gone), pa.array(n), last]
            yield pa.record_batch(columns, names=[*names, *(f.name for f in results)])

    found = rows.mapInArrow(cut, T.StructType(kinds + results))
    return found.toDF(*keep, *[f.name for f in results])

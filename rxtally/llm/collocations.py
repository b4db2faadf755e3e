"""Phrase collocations (operator 13): n-grams of frequent words counted in mergeable counting quotient filters.

Words are counted by language; those that stand there ``least`` times or more get numbers, one for each language and
word, so that an n-gram of numbers belongs to one language. Texts are written once more as rows of numbers, with zero
for any other word and for the end of a piece. Then there is a step for each length: tasks count their n-grams in
filters (``quotient_filter``), one for each range of quotients, and ranges are merged across tasks. As a phrase is no
more frequent than a phrase inside it, an n-gram is only counted where both (n-1)-grams in it are frequent; nothing that
reaches ``least`` is lost. Those that reach it are taken back out of the merged filter as words.

Quotients are spread evenly by the permutation, and a frequent n-gram is one entry of a task's filter, so no range is
hot. The number of ranges grows with the number of n-grams (``ENTRIES`` for each range at most), and so bounds what a
task merges. Sorted codes of frequent n-grams and word hashes are mapped from files of the shared folder, which must be
mounted. Scoring is joins of the frequent n-grams. Five-word phrases fit with 25 bits a word, 33 million frequent words;
more raise an error.

Words are told apart by 64-bit hashes where texts are numbered; two frequent words with one hash raise an error.

Defined results: null and empty texts have no words. A null language is ``und`` and counted with it. Repeated rows count
as often as they stand there. Without a frequent phrase the result is empty. Only text and lang are read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rxtally.llm.arrays import Parts, found, pack, save, sizes_of, unpack
from rxtally.llm.quotient_filter import Packing, added_up, decode, encode, merged
from rxtally.llm.storage import mounted_path, shared_folder, stored
from rxtally.llm.text import lowered

LEAST = 100
LONGEST = 5
TOP = 2000
COVERED = 100  # per cent of a phrase's occurrences that a longer phrase must have to drop it
TOKENS = 1 << 20  # tokens numbered together
HELD = 1 << 22  # tokens whose n-grams are counted before filters are sent
ENTRIES = 1 << 22  # n-grams of a range, at most
ENDS = r".,;:!?\x0A-\x0D"
TOKEN = rf"[{ENDS}]|[^\x20\x09{ENDS}]+"
IS_END = rf"^[{ENDS}]"


def tokens(text: Column) -> Column:
    """Lower-case words in order, with a token for every place where a piece ends."""
    return F.regexp_extract_all(lowered(text), F.lit(TOKEN), F.lit(0))


def language() -> Column:
    return F.coalesce("lang", F.lit("und"))


def count_words(documents: DataFrame) -> DataFrame:
    """lang, word, f of all words."""
    each = documents.select(language().alias("lang"), F.explode_outer(tokens(F.col("text"))).alias("word"))
    return each.groupBy("lang", "word").agg(F.count("*").alias("f")).filter(~F.col("word").rlike(IS_END))


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(33)) * np.uint64(parts) >> np.uint64(31)).astype(np.int64)


def vocabulary(counts: DataFrame, folder: str, parts: int) -> tuple[DataFrame, Parts]:
    """id (from 1), lang, word, f of the words in ``counts``, and their sorted hashes in files."""
    mark = F.xxhash64("lang", "word")
    part = F.shiftright(F.shiftrightunsigned(mark, 33) * parts, 31).cast("int")

    def write(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        hashes = table.column("mark").to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        if (hashes[order][1:] == hashes[order][:-1]).any():
            raise ValueError("two frequent words have the same hash")
        save(f"{folder}/words-{key[0].as_py()}.npy", hashes[order])
        out = table.take(pa.array(order)).drop_columns(["mark"])
        return out.append_column("place", pa.array(np.arange(len(order))))

    rows = counts.select(part.alias("part"), "lang", "word", "f", mark.alias("mark"))
    placed = stored(rows.groupBy("part").applyInArrow(write, "part int, lang string, word string, f bigint, place bigint"))
    files = Parts(folder, sizes_of(placed.groupBy("part").count().collect(), parts))
    first = F.get(F.array(*[F.lit(int(x) + 1) for x in files.offsets[:-1]]), F.col("part"))
    return placed.select((first + F.col("place")).cast("int").alias("id"), "lang", "word", "f"), files


def numbered(hashes: np.ndarray, words: Parts) -> np.ndarray:
    """Word numbers, 0 for words that have none."""
    out = np.zeros(len(hashes), np.int64)
    order = np.argsort(hashes)
    asked = hashes[order]
    bounds = np.searchsorted(part_of(asked, len(words)), np.arange(len(words) + 1))
    for p in np.flatnonzero(np.diff(bounds)):
        hit, place = found(words("words", p), asked[bounds[p] : bounds[p + 1]])
        out[order[bounds[p] : bounds[p + 1]][hit]] = place[hit] + words.offsets[p] + 1
    return out


def without_gaps(ids: np.ndarray) -> np.ndarray:
    """The numbers with one zero for each run of zeros, and without words that stand alone."""
    padded = np.r_[0, ids, 0]
    alone = (padded[:-2] == 0) & (padded[2:] == 0)
    padded[1:-1][alone] = 0
    return padded[1:][(padded[1:] != 0) | (padded[:-1] != 0)]


def streams(documents: DataFrame, words: Parts) -> DataFrame:
    """ids (packed numbers of some texts' words, with zeros between pieces and texts)."""

    def batches(found_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found_:
            lists = batch.column(0)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            values = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
            at, rows = 0, []
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + TOKENS, "right")) - 1)
                ids = numbered(values[offsets[at] : offsets[end]], words)
                ends = offsets[at + 1 : end] - offsets[at]
                rows.append(pack(without_gaps(np.insert(ids, ends, 0))))
                at = end
            yield pa.record_batch([pa.array(rows, pa.binary())], names=["ids"])

    marks = F.transform(tokens(F.col("text")), lambda w: F.xxhash64(language(), w))
    return documents.select(marks.alias("marks")).mapInArrow(batches, "ids binary")


def grams_at(ids: np.ndarray, packing: Packing, shorter: tuple[Packing, Parts, int] | None) -> list[np.ndarray]:
    """The columns of all n-grams that may be frequent: no zero in them, both (n-1)-grams known."""
    n = packing.words
    if len(ids) < n:
        return [np.zeros(0, np.int64)] * n
    whole = np.ones(len(ids) - n + 1, bool)
    for k in range(n):
        whole &= ids[k : len(ids) - n + 1 + k] != 0
    if shorter is not None:
        own, files, prefix = shorter
        places = np.flatnonzero(np.r_[whole, False] | np.r_[False, whole])
        left, right = own.permuted([ids[places + k] for k in range(n - 1)])
        known = np.zeros(len(whole) + 1, bool)
        known[places] = is_known(own, files, prefix, left, right)
        whole &= known[:-1] & known[1:]
    at = np.flatnonzero(whole)
    return [ids[at + k] for k in range(n)]


def is_known(packing: Packing, files: Parts, prefix: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    part, codes = (left >> np.uint64(packing.half - prefix)).astype(np.int64), packing.codes(left, right)
    order = np.lexsort((codes, part))
    asked, out = codes[order], np.zeros(len(codes), bool)
    bounds = np.searchsorted(part[order], np.arange(len(files) + 1))
    for p in np.flatnonzero(np.diff(bounds)):
        own = slice(bounds[p], bounds[p + 1])
        out[order[own]] = found(files(f"grams-{packing.words}", p), asked[own])[0]
    return out


def frequent_grams(
    rows: DataFrame, packing: Packing, shorter, folder: str, total: int, least: int
) -> tuple[DataFrame, Parts, int]:
    """words (array), f of the n-grams that reach ``least``, their codes in files, and the bits of a range."""
    spark = rows.sparkSession
    ranges = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // ENTRIES))
    prefix = min((ranges - 1).bit_length(), packing.half)

    def sent(held: list[np.ndarray]) -> pa.RecordBatch:
        found_ = [grams_at(ids, packing, shorter) for ids in held]
        left, right, counts = added_up(packing, *packing.permuted([np.concatenate(c) for c in zip(*found_)]))
        part = (left >> np.uint64(packing.half - prefix)).astype(np.int64)
        heads = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.zeros(0, np.int64)
        blobs = [
            encode(packing, prefix, (left[a:b], right[a:b], counts[a:b])) for a, b in zip(heads, np.r_[heads[1:], len(part)])
        ]
        columns = [pa.array(part[heads].astype(np.int32)), pa.array(blobs, pa.binary())]
        return pa.record_batch(columns, names=["part", "filter"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for blob in batch.column(0):
                held.append(np.r_[unpack(blob.as_py()), 0])
                size += len(held[-1])
                if size >= HELD:
                    yield sent(held)
                    held, size = [], 0
        if held:
            yield sent(held)

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        left, right, counts = merged(packing, [decode(packing, prefix, part, b.as_py()) for b in table.column("filter")])
        often = counts >= least
        left, right, counts = left[often], right[often], counts[often]
        save(f"{folder}/grams-{packing.words}-{part}.npy", np.sort(packing.codes(left, right)))
        columns = np.stack(packing.columns(left, right), axis=1).astype(np.int32)
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(counts) + 1, dtype=np.int32) * packing.words), pa.array(columns.ravel())
        )
        return pa.table({"part": pa.array(np.full(len(counts), part, np.int32)), "words": lists, "f": counts})

    merged_rows = rows.mapInArrow(count, "part int, filter binary").groupBy("part")
    out = stored(merged_rows.applyInArrow(merge, "part int, words array<int>, f bigint"))
    sizes = sizes_of(out.groupBy("part").count().collect(), 1 << prefix)  # one short row for each range
    return out.select("words", "f"), Parts(folder, sizes), prefix


def frequent_phrases(documents: DataFrame, least: int = LEAST, longest: int = LONGEST):
    """``words`` (id, lang, word, f), ``grams`` (words, f; single words too) and ``sizes`` (lang, n)."""
    spark = documents.sparkSession
    folder = mounted_path(shared_folder(spark))
    os.makedirs(folder, exist_ok=True)
    counts = stored(count_words(documents))
    words, files = vocabulary(counts.filter(F.col("f") >= least), folder, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = stored(streams(documents, files))
    bits = max(1, sum(files.sizes).bit_length())
    grams, shorter = [words.select(F.array("id").alias("words"), "f")], None
    total = words.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    for n in range(2, longest + 1):
        if not total:
            break
        packing = Packing(n, bits)
        own, codes, prefix = frequent_grams(rows, packing, shorter, folder, total, least)
        grams.append(own)
        shorter = (packing, codes, prefix)
        total = own.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    sizes = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    return words, reduce(DataFrame.unionByName, grams), sizes


def worst_cuts(grams: DataFrame, words: DataFrame, sizes: DataFrame) -> DataFrame:
    """words, lang, n, a, and l, r, score of the cut with the smallest score, for phrases of two words and more.

    Products are exact: a and l below 10**18, 1000 n below 10**19.
    """
    size = F.size("words")
    cuts = (
        grams.filter(size > 1)
        .withColumnRenamed("f", "a")
        .withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
        .select(
            "words", "a", "k",
            F.slice("words", F.lit(1), F.col("k")).alias("first"),
            F.slice("words", F.col("k") + 1, size - F.col("k")).alias("rest"),
            F.get("words", F.lit(0)).alias("id"),
        )
    )
    left = grams.select(F.col("words").alias("first"), F.col("f").alias("l"))
    right = grams.select(F.col("words").alias("rest"), F.col("f").alias("r"))
    named = words.select("id", "lang").join(sizes, "lang")
    score = F.expr(
        "(cast(a as decimal(18,0)) * cast(1000 * n as decimal(19,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"
    )
    scored = cuts.join(left, "first").join(right, "rest").join(named, "id").withColumn("score", score)
    least = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return scored.groupBy("words", "lang", "n", "a").agg(least).select("words", "lang", "n", "a", "cut.l", "cut.r", "cut.score")


def uncovered(phrases: DataFrame, grams: DataFrame, percent: int = COVERED) -> DataFrame:
    """Phrases that are in no longer one with ``percent`` or more of their occurrences.

    A phrase one word longer that lies between the two has at least the longer one's occurrences, so phrases with one
    more word are enough to look at.
    """
    size = F.size("words")
    inside = (
        grams.filter(size > 2)
        .select("f", F.explode(F.array(F.slice("words", F.lit(1), size - 1), F.slice("words", F.lit(2), size - 1))).alias("words"))
        .groupBy("words")
        .agg(F.max("f").alias("longer"))
    )
    joined = phrases.join(inside, "words", "left")
    return joined.filter(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a"))).drop("longer")


def collocations(
    documents: DataFrame, top: int = TOP, least: int = LEAST, longest: int = LONGEST, percent: int = COVERED
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases by score, a and phrase."""
    words, grams, sizes = frequent_phrases(documents, least, longest)
    grams = stored(grams)
    left = uncovered(worst_cuts(grams, words, sizes), grams, percent)
    order = [F.desc("score"), F.desc("a")]
    # Ties stay until the words are known.
    best = stored(left.withColumn("place", F.rank().over(W.partitionBy("lang").orderBy(*order))).filter(F.col("place") <= top))
    spelled = (
        best.select("words", F.posexplode("words").alias("at", "id"))
        .join(words.select("id", "word"), "id")
        .groupBy("words")
        .agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("found"))
        .select("words", F.array_join(F.col("found.word"), " ").alias("phrase"))
    )
    ranked = best.join(spelled, "words").withColumn(
        "rank", F.row_number().over(W.partitionBy("lang").orderBy(*order, "phrase")).cast("long")
    )
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


# The same result by DuckDB.
ORACLE = r"""
WITH pieces AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') AS w
    FROM (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)
), places AS (
    SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
    FROM pieces, (VALUES (1), (2), (3), (4), (5)) sizes(size)
    WHERE len(w) >= size
), grams AS (
    SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f FROM places GROUP BY ALL
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE size = 1 GROUP BY lang
), candidates AS (
    SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE size > 1 AND f >= 100
), cuts AS (
    SELECT *, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)
), scored AS (
    SELECT c.lang, c.size, c.phrase, c.a, c.k, h.f AS l, t.f AS r, n,
           (1000::HUGEINT * c.a * n) // (h.f::HUGEINT * t.f) AS score
    FROM cuts c
    JOIN grams h ON h.lang = c.lang AND h.phrase = c.head
    JOIN grams t ON t.lang = c.lang AND t.phrase = c.tail
    JOIN totals ON totals.lang = c.lang
), worst AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
    SELECT lang, a, array_to_string(w[s:s + m - 1], ' ') AS phrase
    FROM candidates, (VALUES (2), (3), (4)) lengths(m), (VALUES (1), (2), (3), (4)) starts(s)
    WHERE m < size AND s + m - 1 <= size
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM worst v
    WHERE NOT EXISTS (
        SELECT 1 FROM longer g WHERE g.lang = v.lang AND g.phrase = v.phrase AND 100 * g.a >= 100 * v.a)
)
WHERE rank <= 2000
"""

"""Phrase mining and counting quotient filters against plain Python."""

import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rxtally.llm import collocations as co
from rxtally.llm import quotient_filter as qf

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, top, least, longest=5, percent=100):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    phrases = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    covered = set()
    for (lang, ws), a in phrases.items():
        for m in range(2, len(ws)):
            for s in range(len(ws) - m + 1):
                if 100 * a >= percent * f[lang, ws[s : s + m]]:
                    covered.add((lang, ws[s : s + m]))
    out = []
    for (lang, ws), a in phrases.items():
        if (lang, ws) not in covered:
            cuts = [(f[lang, ws[:k]], f[lang, ws[k:]]) for k in range(1, len(ws))]
            score, _, l, r = min((1000 * a * n[lang] // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
            out.append((lang, " ".join(ws), a, l, r, n[lang], score))
    out.sort(key=lambda x: (x[0].encode(), -x[6], -x[2], x[1].encode()))
    rank = Counter()
    result = []
    for lang, *rest in out:
        rank[lang] += 1
        if rank[lang] <= top:
            result.append((lang, rank[lang], *rest))
    return result


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=lambda r: (r[0].encode(), r[1]))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5), st.integers(1, 25), st.integers(0, 9), st.lists(st.integers(0, 2**62), min_size=1, max_size=80), st.data())
def test_filters_lose_nothing(words, bits, prefix, numbers, data):
    packing = qf.Packing(words, bits)
    prefix = min(prefix, packing.half)
    numbers = np.array(numbers * 2) % (1 << bits)
    columns = [np.roll(numbers, k) for k in range(words)]
    left, right = packing.permuted(columns)
    assert all(np.array_equal(a, b) for a, b in zip(packing.columns(left, right), columns))
    counts = np.array(data.draw(st.lists(st.sampled_from([1, 2, 254, 255, 256, 10**12]), min_size=len(numbers), max_size=len(numbers))))
    shift = np.uint64(packing.half - prefix)
    expected = Counter()
    for row, c in zip(zip(*[c.tolist() for c in columns]), counts.tolist()):
        expected[row] += c
    got = Counter()
    for value in np.unique(left >> shift).tolist():
        own = (left >> shift) == value
        sides = [own & (np.arange(len(own)) % 2 == k) for k in (0, 1)]
        blobs = [qf.encode(packing, prefix, qf.added_up(packing, left[s], right[s], counts[s])) for s in sides]
        l, r, c = qf.merged(packing, [qf.decode(packing, prefix, value, b) for b in blobs])
        assert (np.lexsort((r, l)) == np.arange(len(l))).all()
        for row, n in zip(zip(*[x.tolist() for x in packing.columns(l, r)]), c.tolist()):
            got[row] += n
    assert got == expected


def test_too_many_words():
    with pytest.raises(ValueError):
        qf.Packing(5, 26)


TEXTS = [
    (None, "en"), ("", "en"), (" \t.", "en"), ("Ab cD ab CD\x0bab cd", "en"), ("a b c d e f " * 40, None),
    ("a b c d e f. " * 7, "und"), ("x " * 900, "de"), ("é ü é ü, é ü\xa0é ü!" * 30, "de"), ("x y;x y:x y?x y", ""),
    ("one two three. " * 5 + "two three four " * 3, "fr"), ("one two three. " * 5, "fr"), ("one two three. " * 5, "fr"),
]


@pytest.mark.parametrize(("top", "least", "percent"), [(2000, 2, 100), (3, 3, 100), (5, 1, 60), (10, 10**6, 100)])
def test_small_tables(spark, top, least, percent):
    frame = spark.createDataFrame(TEXTS, "text string, lang string")
    frame = frame.withColumn("word", F.lit("clash")).withColumn("f", F.lit(1)).withColumn("words", F.lit(1))
    found = co.collocations(frame, top, least, percent=percent)
    assert rows_of(found) == brute(TEXTS, top, least, percent=percent)


def test_empty_table(spark):
    frame = spark.createDataFrame(TEXTS, "text string, lang string").limit(0)
    assert co.collocations(frame).collect() == []


def test_large_numbers(spark):
    grams = spark.createDataFrame([([1], 3 * 10**12), ([2], 10**12 + 1), ([1, 2], 10**12)], "words array<int>, f bigint")
    words = spark.createDataFrame([(1, "x"), (2, "x")], "id int, lang string")
    sizes = spark.createDataFrame([("x", 9 * 10**15)], "lang string, n bigint")
    assert co.worst_cuts(grams, words, sizes).first()["score"] == 1000 * 10**12 * 9 * 10**15 // (3 * 10**12 * (10**12 + 1))


def test_small_pieces_change_nothing(spark, monkeypatch):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["text"], r["lang"]) for r in frame.collect()]
    for name, value in (("TOKENS", 50), ("HELD", 2000), ("ENTRIES", 1000)):
        monkeypatch.setattr(co, name, value)
    assert rows_of(co.collocations(frame, 300, 4)) == brute(rows, 300, 4)


def test_query_against_sql(spark):
    from rxtally.llm.queries import ORACLE, op13_collocations

    con = duckdb.connect()
    con.sql("create view documents as select * from '/root/testdata/sf0.01/documents.parquet'")
    expected = [tuple(r) for r in con.sql(ORACLE["op13_collocations"]).fetchall()]
    assert rows_of(op13_collocations(spark, "/root/testdata/sf0.01")) == sorted(expected, key=lambda r: (r[0].encode(), r[1]))

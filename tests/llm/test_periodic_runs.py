"""Periodic runs against plain Python."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rxtally.llm import periodic_runs as pr
from rxtally.llm.common_prefix import Extensions

words_of = re.compile(r"[^\x20\x09-\x0D]+").findall


def brute_runs(words):
    """Runs by looking at every period from every place where its repetition begins."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            end = i
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end + q - i >= max(6, 4 * q):
                found.setdefault((i, end + q - i), q)
            i = end + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def brute(doc_id, text):
    words = words_of(text or "")
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    found = brute_runs(words)
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    left = " ".join(w for k, w in enumerate(words) if k not in gone)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *four, sha(lines), sha(left))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=2, max_size=400), st.integers(1, 40))
def test_extensions(values, period):
    values = np.array((values * 3)[: len(values) + period])
    e = Extensions(values)
    n = len(values)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(n + 1)[:: max(1, n // 40)], np.arange(n + 1)[:: max(1, n // 37)]))
    a, b = a[a != b], b[a != b]
    for x, y, got in zip(a.tolist(), b.tolist(), e(a, b).tolist()):
        k = 0
        while max(x, y) + k < n and values[x + k] == values[y + k]:
            k += 1
        assert got == k


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text("ab c", max_size=60), st.integers(1, 9)), max_size=6))
def test_runs_of_texts(parts):
    texts = [(t + " ") * k for t, k in parts]
    found = pr.runs_of_texts([t.encode().split() for t in texts])
    assert [list(map(tuple, r.tolist())) for r in found] == [brute_runs(words_of(t)) for t in texts]


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_edge_texts(spark):
    texts = [
        None, "", " \t\n", "a", "a a a a a", "a a a a a a", "a b " * 4, "a b c " * 4 + "a b", "x " * 5000,
        "a\x0ba\x0ca\ra a a", "\xa0 \xa0 \xa0 \xa0 \xa0 \xa0", "ab " * 9 + "c " + "ab " * 9, ("a b a b a b a b c " * 5),
        "é ü " * 700 + "end", " ".join(map(str, range(3000))),
    ]
    table = [(i, t) for i, t in enumerate(texts)] + [(None, "a " * 50), (3, "a " * 9), (3, "a " * 9)]
    tails = [(i, " ".join(f"w{k}" for k in range(i % 97))) for i in range(1000, 1200)]
    frame = spark.createDataFrame(table + tails, "doc_id bigint, text string").withColumn("runs", F.lit(1))
    frame = frame.withColumn("key", F.lit(2)).withColumn("keep_0", F.lit(3)).withColumn("best", F.lit(3))
    assert rows(pr.digests(frame)) == sorted([brute(*r) for r in table + tails], key=repr)
    assert pr.digests(frame.limit(0)).collect() == []
    assert pr.collapsed(frame, "key", "keep_0").distinct().columns == ["key", "keep_0", "n_runs", "runs", "collapsed"]


def test_blocks_change_nothing(spark, monkeypatch):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r["text"].encode().split() for r in frame.collect()]
    whole = pr.runs_of_texts(texts)
    monkeypatch.setattr(pr, "WORDS", 300)
    monkeypatch.setattr(pr, "PLACES", 1000)
    cut = [r for held, own in pr.in_blocks(enumerate(texts), lambda row: row[1]) for r in pr.runs_of_texts(own)]
    assert all(np.array_equal(a, b) for a, b in zip(whole, cut)) and len(whole) == len(cut)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_on_whole_tables(spark, folder):
    from rxtally.llm.queries import op11_periodic_runs

    frame = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet").select("doc_id", "text")
    expected = [brute(r["doc_id"], r["text"]) for r in frame.collect() if len(r["text"] or "") < 6000]
    ids = {e[0] for e in expected}
    found = [r for r in rows(op11_periodic_runs(spark, f"/root/testdata/{folder}")) if r[0] in ids]
    assert found == sorted(expected, key=repr)

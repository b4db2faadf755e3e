"""Removed bytes against a comparison of all windows, and the transform against sorted suffixes."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from rxtally.llm import collection_bwt, external_bwt, suffix_dedup
from rxtally.llm.arrays import pack


def brute(rows, width=50):
    first = {}
    for doc, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - width + 1):
            if doc is not None:
                first[data[i : i + width]] = min(doc, first.get(data[i : i + width], doc))
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            if doc is not None and first[data[i : i + width]] < doc:
                gone[i : i + width] = b"\1" * width
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(frame):
    rows = suffix_dedup.deduplicated(frame, "doc_id").withColumn("sha", F.sha2("kept_bytes", 256)).drop("kept_bytes")
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def test_planted_passages(spark, monkeypatch):
    draw = np.random.default_rng(3)
    word = lambda: "".join(draw.choice(list("abcdeé "), draw.integers(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(40) for _ in range(4)] + ["x" * 80, "ab" * 60, "é" * 40, "a" * 49, "b" * 50]
    texts = [None, "", "short", "y" * 49, "z" * 50, "z" * 50, "z" * 51]
    for i in range(60):
        parts = [prose(draw.integers(0, 60)) for _ in range(draw.integers(1, 4))]
        parts.insert(0, passages[draw.integers(len(passages))])
        texts.append("".join(draw.permutation(parts)))
    texts += [texts[20], texts[21], texts[22] + texts[20]]
    rows = list(enumerate(texts)) + [(None, texts[12]), (None, None), (12, texts[12]), (12, texts[13]), (900, texts[13])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n_bytes", F.lit("clash"))
    assert found(frame) == brute(rows)
    # Long texts are looked at in pieces, parts in sets.
    monkeypatch.setattr(suffix_dedup, "CHUNK", 128)
    monkeypatch.setattr(suffix_dedup, "STRINGS", 8)
    folder = {r["doc_id"]: r for r in suffix_dedup.deduplicated(frame.filter("doc_id > 12"), "doc_id", result="spans").collect()}
    assert sum(e - s for r in folder.values() for s, e in r["spans"]) == sum(r[2] for r in brute([x for x in rows if x[0] and x[0] > 12]))
    assert found(frame.limit(0)) == []


def test_small_pieces_and_sets(monkeypatch):
    """The passes without Spark, with pieces and sets far smaller than in use."""
    draw = np.random.default_rng(8)
    text = "".join(draw.choice(list("ab"), 4000))
    buffer = np.frombuffer(text.encode(), np.uint8)
    whole = list(suffix_dedup.runs_of(buffer, np.array([0, 1000, 1000, 4000])))
    monkeypatch.setattr(suffix_dedup, "CHUNK", 64)
    pieces = list(suffix_dedup.runs_of(buffer, np.array([0, 1000, 1000, 4000])))
    cover = lambda runs: sorted((s + i, k) for r in runs for s, n, k in zip(r.start, r.count, r.key) for i in range(n))
    assert cover(whole) == cover(pieces)
    assert [p for p, _ in cover(whole)] == [*range(951), *range(1000, 3951)]


def test_driver_documents(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert found(frame) == brute([tuple(r) for r in frame.collect()])


def test_kept_text_has_whole_characters(spark):
    shared = "é" * 60
    rows = [(1, shared), (2, "a" + shared + "bé"), (3, "ü" + shared[:30]), (4, "x\xc3" + "é" * 24 + "ê"), (5, "日" + shared + "日")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {r["doc_id"]: r["kept_text"] for r in suffix_dedup.deduplicated(frame, "doc_id", result="kept_text").collect()}
    assert kept[1] == shared and kept[2] == "abé" and kept[3] == "ü" and kept[5] == "日日"


@pytest.mark.parametrize("seed", range(8))
def test_transform(seed):
    draw = np.random.default_rng(seed)
    strings = [draw.integers(0, draw.integers(1, 5), draw.integers(1, 20)).astype(np.uint8) for _ in range(draw.integers(1, 40))]
    lengths = np.array([len(s) for s in strings])
    bwt, prefixes = collection_bwt.build(np.concatenate(strings), np.cumsum(lengths) - lengths, lengths)
    suffixes = sorted(([*(s[i:] + 1).tolist(), 0], k, i) for k, s in enumerate(strings) for i in range(len(s) + 1))
    assert bwt.tolist() == [0 if i == 0 else int(strings[k][i - 1]) + 1 for _, k, i in suffixes]
    for row in range(1, len(suffixes)):
        a, b = suffixes[row - 1][0][:-1], suffixes[row][0][:-1]
        shared = next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert prefixes[row] == shared


@pytest.mark.parametrize("block", [3, 17, 1 << 20])
@pytest.mark.parametrize("seed", range(6))
def test_files_hold_the_same_transform(tmp_path, seed, block):
    """Blocks far smaller than the files, repeated strings, few and many symbols."""
    draw = np.random.default_rng(seed)
    strings = [draw.integers(0, draw.integers(1, [3, 255][seed % 2]), draw.integers(1, 20)).astype(np.uint8) for _ in range(draw.integers(1, 40))]
    strings += strings[: draw.integers(0, 3)]
    lengths = np.array([len(s) for s in strings])
    starts, text = np.cumsum(lengths) - lengths, np.concatenate(strings)
    bwt, prefixes = collection_bwt.build(text, starts, lengths)
    total = external_bwt.build(text, starts, lengths, str(tmp_path), block)
    read = {name: np.fromfile(tmp_path / name, kind) for name, kind in external_bwt.COLUMNS.items()}
    assert total == len(bwt) and read["symbols"].tolist() == bwt.tolist() and read["prefixes"].tolist() == prefixes.tolist()
    suffixes = sorted(([*(s[i:] + 1).tolist(), 0], k, len(s) - i) for k, s in enumerate(strings) for i in range(len(s) + 1))
    assert [(k, n) for _, k, n in suffixes] == list(zip(read["strings"].tolist(), read["lengths"].tolist()))
    ranks = draw.integers(0, 50, len(strings))
    expected = sorted(zip(*(x.tolist() for x in collection_bwt.window_classes(text, starts, lengths, 5, ranks))))
    found = external_bwt.window_classes(text, starts, lengths, 5, ranks, str(tmp_path), block)
    assert sorted(zip(*(x.tolist() for x in found))) == expected
    assert not [p for p in tmp_path.iterdir() if p.is_dir()]


def test_a_large_set_is_built_in_files(tmp_path, monkeypatch):
    """Many different texts around one anchor give the same windows in files as in memory."""
    draw = np.random.default_rng(5)
    anchor = b"c" * suffix_dedup.GRAM
    sides = [bytes(draw.integers(97, 99, 26).astype(np.uint8)) for _ in range(6)]
    texts = list({(sides[a] + anchor + sides[b])[draw.integers(0, 20) :][:76] for a in range(6) for b in range(6) for _ in range(4)})
    texts = [t for t in texts if len(t) >= 50]
    least, spread = draw.integers(0, 90, len(texts)), draw.integers(0, 9, len(texts))
    numbers = [np.diff(np.full(len(texts), 7), prepend=0), least, spread, np.array([len(t) for t in texts])]
    blob = zstandard.ZstdCompressor().compress(b"".join(texts))
    table = pa.table([[x] for x in (*map(pack, numbers), blob)], names=suffix_dedup.FRAGMENT_COLUMNS)
    expected = suffix_dedup.least_documents(table, str(tmp_path))
    monkeypatch.setattr(suffix_dedup, "LARGE", 8)
    calls = []
    plain = external_bwt.build
    monkeypatch.setattr(external_bwt, "build", lambda *a: calls.append(len(a[1])) or plain(*a))
    assert [x.tolist() for x in suffix_dedup.least_documents(table, str(tmp_path))] == [x.tolist() for x in expected]
    assert calls == [len(texts)] and len(expected[0]) > 10

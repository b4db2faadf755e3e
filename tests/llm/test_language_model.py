"""Kneser-Ney scores against a plain dictionary model of the same texts."""

import math
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rxtally.llm import language_model as lm
from rxtally.llm.arrays import MAPPED, Parts, mapped, pack_columns, save, save_narrow, save_rows, unpack_columns
from rxtally.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


class Plain:
    def __init__(self, texts, order):
        self.order, lists = order, [tokens(t) for t in texts]
        self.words = Counter(w for ws in lists for w in ws)
        self.n, self.v = sum(self.words.values()), len(self.words)
        grams = Counter()
        for ws in lists:
            padded = ["<s>"] * (order - 1) + ws
            grams.update(tuple(padded[i : i + order]) for i in range(len(ws)))
        self.counts, self.d, self.by_context = {}, {}, {}
        for n in range(order, 0, -1):
            self.counts[n], self.by_context[n] = grams, defaultdict(lambda: [0, 0, 0, 0])
            for g, c in grams.items():
                sums = self.by_context[n][g[:-1]]
                sums[0] += c
                sums[min(c, 3)] += 1  # types seen once, twice and more often
            n1, n2, n3, n4 = (sum(c == k for c in grams.values()) for k in range(1, 5))
            self.d[n] = (0, 0.5, 0.5, 0.5)
            if n1 and n2 and n3:
                y = n1 / (n1 + 2 * n2)
                raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
                # No discount may be 0: a context would leave nothing to words it has not seen.
                self.d[n] = (0, *(min(x, k) for k, x in enumerate(raw, 1))) if min(raw) > 0 else (0, y, y, y)
            grams = Counter(g[1:] for g in grams)

    def p(self, gram):
        if not gram:
            return 1 / (self.v + 1)
        n, seen = len(gram), self.by_context[len(gram)].get(gram[:-1])
        if not seen:
            return self.p(gram[1:])
        c, d = self.counts[n][gram], self.d[n]
        rest = sum(x * y for x, y in zip(d[1:], seen[1:])) / seen[0]
        return (c - d[min(c, 3)]) / seen[0] + rest * self.p(gram[1:])

    def row(self, doc, text):
        ws = tokens(text)
        padded = ["<s>"] * (self.order - 1) + ws
        base = sum(math.log10((self.words[w] + 0.1) / (self.n + 0.1 * (self.v + 1))) for w in ws)
        score = sum(math.log10(self.p(tuple(padded[i : i + self.order]))) for i in range(len(ws)))
        return doc, len(ws), sum(w in self.words for w in ws), self.n, base, score


def compare(frame, order):
    rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
    held = lambda doc: zlib.crc32(("" if doc is None else str(doc)).encode()) % 10 == 0
    plain = Plain([t for d, t in rows if not held(d)], order)
    expected = sorted((plain.row(d, t) for d, t in rows), key=repr)
    found = lm.held_out_scores(frame, order).collect()
    assert all(r["held_out"] == held(r["doc_id"]) for r in found)
    found = sorted((tuple(r[c] for c in lm.NAMES) for r in found), key=repr)
    assert [f[:4] for f in found] == [e[:4] for e in expected]
    for f, e in zip(found, expected):
        assert f[4] == pytest.approx(e[4], rel=1e-9) and f[5] == pytest.approx(e[5], rel=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_driver_documents(spark, order):
    compare(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"), order)


def test_edge_texts(spark, monkeypatch):
    texts = [None, "", " ", "a", "A a", "a b a b", "é É", "one two three", "x " * 3000, "a", "b b b b"]
    rows = list(enumerate(texts)) + [(None, "a"), (3, "a"), (3, "a")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("score", F.lit("clash"))
    compare(frame, 2)
    assert lm.held_out_scores(frame.limit(0)).collect() == []
    one = lm.held_out_scores(frame.filter("doc_id is null")).collect()
    assert one[0]["train_tokens"] == 0 and one[0]["score"] == 0.0


def test_probabilities_add_up():
    plain = Plain(["a b c a b", "b c", "c c d"], 2)
    words = [*plain.words, "never seen"]
    for context in ["<s>", "a", "b", "c", "d", "new"]:
        assert sum(plain.p((context, w)) for w in words) == pytest.approx(1)


def test_model_beats_the_base_on_held_out_documents(spark):
    found = lm.held_out_scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out")
    sums = found.agg(F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > sums[1]


def test_registered_query_is_a_trigram_model(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    held = lambda doc: zlib.crc32(str(doc).encode()) % 10 == 0
    plain = Plain([t for d, t in rows if not held(d)], 3)
    expected = {d: plain.row(d, t)[-1] for d, t in rows if held(d)}
    found = QUERIES["op1_language_model"](spark, "/root/testdata/sf0.001").filter("held_out").collect()
    assert {r["doc_id"]: r["score"] for r in found} == pytest.approx(expected, rel=1e-9)


def test_scores_are_finite_on_copies(spark):
    """Counts of counts of 10, 10, 2, 100: the plain estimate for three and more falls below 0."""
    rows = [(f"a{k} b{k} c{k} d{k}", n) for n, many in ((1, 10), (2, 10), (3, 2), (4, 100)) for k in range(1000 * n, 1000 * n + many)]
    texts = [t for t, n in rows for _ in range(n)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    model = lm.train(frame)
    assert all(0 < d <= k for per in model.discounts for k, d in enumerate(per[1:], 1))
    asked = spark.createDataFrame([(0, "a4001 b4002 c4003"), (1, "never a4001 b4001 never"), (2, texts[0])], "doc_id bigint, text string")
    scores = {r["doc_id"]: r["score"] for r in lm.scored(asked, model).collect()}
    assert all(math.isfinite(x) and x < 0 for x in scores.values())
    every = np.arange(model.vocabulary.size + 1)  # all words and the unknown one
    for context in ([model.vocabulary.start] * 2, [3, 5], [model.vocabulary.unknown, 7]):
        columns = [np.full(len(every), c) for c in context] + [every]
        assert model.probabilities(columns).sum() == pytest.approx(1)


def test_a_missing_file_is_an_error(spark):
    frame = spark.createDataFrame([(k, f"a b c {k % 3}") for k in range(50)], "doc_id bigint, text string")
    model = lm.train(frame)
    part = next(p for p, n in enumerate(model.grams[1].sizes) if n)
    Path(f"{model.grams[1].folder}/grams-2-{part}.npy").unlink()
    with pytest.raises(Exception, match="No such file"):
        lm.scored(frame, model).collect()


@pytest.mark.parametrize("tops", [(5, 9, 3), (1 << 22, 1 << 22, 1 << 22), (1 << 30, 1 << 31, 4), (1 << 30, 1 << 30, 1 << 30), (1 << 40, 1 << 40, 7), (70,)])
def test_sort_order(tops):
    """Keys that fit in 64 bits, that go beyond by some bits of the last column, and by more."""
    draw = np.random.default_rng(3)
    for spread in (1, 40, 3000):
        columns = [(draw.integers(0, min(spread, top), 3000) + (top - min(spread, top)) * draw.integers(0, 2, 3000)).astype(np.int64) for top in tops]
        order = lm.sort_order(columns)
        assert sorted(order) == list(range(3000))
        assert [tuple(c[i] for c in columns) for i in order] == sorted(zip(*columns))
    assert len(lm.sort_order([np.zeros(0, np.int64)] * len(tops))) == 0


def test_intermediate_tables_are_removed(spark):
    model = lm.train(spark.createDataFrame([(k, f"a b c {k % 3}") for k in range(50)], "doc_id bigint, text string"))
    left = {p.name for p in Path(model.grams[0].folder).iterdir() if p.is_dir()}
    assert left == {"made-1"}
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_parts_follow_the_tokens(spark, monkeypatch):
    frame = spark.createDataFrame([(k, f"a b c {k % 7} d") for k in range(90)], "doc_id bigint, text string")
    whole = {r["doc_id"]: r["score"] for r in lm.scored(frame, lm.train(frame)).collect()}
    monkeypatch.setattr(lm, "PART", 10)
    model = lm.train(frame)
    assert {len(files) for files in model.grams} == {54} and model.vocabulary.parts < 54
    assert {r["doc_id"]: r["score"] for r in lm.scored(frame, model).collect()} == pytest.approx(whole)


def test_frequent_words_are_spread_over_parts(spark):
    """One word is a third of all; its n-grams lie in several parts, and scores stay those of the plain model."""
    texts = [f"the {k % 40} the {k % 9} a{k % 5} the {k % 23}" for k in range(150)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    model, plain = lm.train(frame, cell=20), Plain(texts, 3)
    assert len(model.vocabulary.frequent) > 1 and model.placement.spread.max() == len(model.grams[2])
    word = max(model.vocabulary.frequent, key=lambda x: x[1])[0]
    others = np.arange(model.vocabulary.size)
    assert len(set(model.placement.of([others, np.full(len(others), word), others]))) == model.placement.parts > 1
    rare = np.setdiff1d(others, [w for w, _ in model.vocabulary.frequent])[0]
    assert len(set(model.placement.of([others, np.full(len(others), rare), others]))) == 1
    scores = {r["doc_id"]: r["score"] for r in lm.scored(frame, model).collect()}
    assert scores == pytest.approx({k: plain.row(k, t)[-1] for k, t in enumerate(texts)}, rel=1e-9)


def test_texts_and_rows_have_the_same_probabilities(spark):
    frame = spark.createDataFrame([(k, f"a b {k % 3} c a b") for k in range(60)], "doc_id bigint, text string")
    model = lm.train(frame)
    start, unknown = model.vocabulary.start, model.vocabulary.unknown
    ids, offsets = np.array([0, 1, 2, unknown, 1, 2, 0, 3, 3]), np.array([0, 4, 5, 9])
    rows = model.probabilities(lm.histories(ids, offsets, 3, start))
    assert model.text_probabilities(ids, offsets) == pytest.approx(rows, rel=1e-12)


@pytest.mark.parametrize("seed", range(3))
def test_rows_of_counts_are_kept_whole(tmp_path, seed):
    """Frequent rows, more than 255 kinds, and numbers beyond one and two bytes."""
    draw = np.random.default_rng(seed)
    rows = np.concatenate([np.tile([[1, 1, 0, 0]], (500, 1)), draw.integers(0, 9, (3000, 4)), draw.integers(0, 1 << (10 + 12 * seed), (40, 4))])
    rows = rows[draw.permutation(len(rows))]
    save_rows(str(tmp_path), "totals", 0, rows)
    save_narrow(str(tmp_path), "counts", 0, rows[:, 0])
    parts, places = Parts(str(tmp_path), (len(rows),)), draw.integers(0, len(rows), 5000)
    assert (parts.rows("totals", 0, places) == rows[places]).all()
    assert (parts.narrow("counts", 0, places) == rows[places, 0]).all()


def test_words_are_cut_and_hashed_from_bytes():
    """Every separator and its neighbours, words of 1 to 40 bytes and long ones at each place, texts without words."""
    draw, known = np.random.default_rng(8), {}
    some = [0, 8, 9, 10, 11, 12, 13, 14, 32, 65, 97, 91, 195, 137, 255]
    texts = [bytes(draw.choice(some, draw.integers(0, 60)).tolist()) for _ in range(2000)]
    texts += [b"", b" ", b"x", *(b" " * n + b"Ab" * k + b" z" for n in range(9) for k in (*range(1, 21), 127, 128, 129, 700))]
    texts += [b"y" * n for n in range(250, 270)] + [b"\x00" * n for n in range(1, 20)]
    for batch in (texts, texts[-5:], [b""], []):
        hashes, offsets = lm.token_hashes(batch)
        assert len(offsets) == len(batch) + 1 and offsets[-1] == len(hashes)
        for text, a, b in zip(batch, offsets, offsets[1:]):
            own = [*re.findall(rb"[^\x20\x09-\x0D]+", text.lower()), None]
            assert [known.setdefault(w, h) for w, h in zip(own, hashes[a:b].tolist(), strict=True)] == hashes[a:b].tolist()
    assert len(set(known.values())) == len(known) > 1000


def test_words_of_all_kinds_through_slices(spark, monkeypatch):
    texts = [None, "", " \n", "É é A a \u3000 ß SS", "x" * 300, "X" * 300 + " " + "x" * 301, "tab\tend\x0b\x0c\r\n.", "a " * 40]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    monkeypatch.setattr(lm, "TEXT", 64)
    monkeypatch.setattr(lm, "HELD", 8)
    plain = Plain(texts, 3)
    found = {r["doc_id"]: r for r in lm.scored(frame, lm.train(frame)).collect()}
    for k, text in enumerate(texts):
        n_known, base, score = sum(w in plain.words for w in tokens(text)), plain.row(k, text)[-2], plain.row(k, text)[-1]
        assert (found[k]["n_tokens"], found[k]["n_known"], found[k]["train_tokens"]) == (len(tokens(text)), n_known, plain.n)
        assert (found[k]["base_score"], found[k]["score"]) == pytest.approx((base, score), rel=1e-9)


def test_look_ups_go_by_the_tokens_held(spark, monkeypatch):
    """Many slices of texts meet the parts of the model together, as often as ``HELD`` says."""
    texts = [f"a b{k % 7} c a b{k % 3} new{k}" for k in range(120)] + ["", "a"]
    model, plain = lm.train(spark.createDataFrame(list(enumerate(texts[:90])), "doc_id bigint, text string")), Plain(texts[:90], 3)
    calls, look_up = [], lm.Model._looked_up
    monkeypatch.setattr(lm.Model, "_looked_up", lambda self, *a: calls.append(len(a[0][0])) or look_up(self, *a))
    monkeypatch.setattr(lm, "TEXT", 64)
    for held, times in ((1 << 21, 1), (250, 4)):
        monkeypatch.setattr(lm, "HELD", held)
        calls.clear()
        columns = [pa.array(range(len(texts))), pa.array([t.encode() for t in texts])]
        found = pa.Table.from_batches(lm.score(iter([pa.record_batch(columns, names=["doc_id", "text"])]), model)).to_pydict()
        assert len(calls) == 5 * times  # three orders, and the starts of texts as contexts of two
        assert found["doc_id"] == list(range(len(texts)))
        assert found["score"] == pytest.approx([plain.row(k, t)[-1] for k, t in enumerate(texts)], rel=1e-9)
    assert list(lm.score(iter([]), model)) == []


def test_a_process_can_map_the_model_of_a_large_corpus(spark, tmp_path):
    """6 GB of parquet have about 1,600 million tokens; no file may be mapped twice for them, nor be held open."""
    model = lm.train(spark.createDataFrame([(k, f"a b {k % 9} c{k}") for k in range(400)], "doc_id bigint, text string"))
    names = [p.name for p in Path(model.grams[0].folder).glob("*.npy")]
    most = max(sum(n.endswith(f"-{part}.npy") for n in names) for part in range(model.placement.parts))
    assert most * 1_600_000_000 / lm.PART < MAPPED == mapped.cache_info().maxsize < 65_000
    held = []
    for k in range(20):
        save(f"{tmp_path}/{k}.npy", np.arange(k))
        held.append(mapped(f"{tmp_path}/{k}.npy"))
    assert [x.tolist() for x in held] == [list(range(k)) for k in range(20)]
    assert not [p for p in Path("/proc/self/fd").iterdir() if str(tmp_path) in str(p.readlink() if p.is_symlink() else "")]


def test_columns_are_packed_together():
    draw = np.random.default_rng(5)
    for tops in ((1,), (200, 1 << 16, 255), (256, (1 << 62) + 3, 1 << 31, 1 << 32)):
        for n in (0, 1, 1000):
            columns = [draw.integers(0, top, n, np.int64) for top in tops] + [np.full(n, -7)]
            assert [c.tolist() for c in unpack_columns(pack_columns(columns))] == [c.tolist() for c in columns]

"""Sampled segmentations: round trips, distinctness, exact chances on small texts, and independence from slices."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rxtally.llm import segmentation as sg
from rxtally.llm.queries import QUERIES, tokenizer
from rxtally.llm.token_counts import processor, split

PATH = tokenizer()


def every_segmentation(text):
    """ids and weight of all segmentations, by brute force."""
    vocabulary, model = sg.pieces(PATH), processor(PATH)
    joined = (" " + text).replace(" ", sg.SPACE)

    def rest(at):
        if at == len(joined):
            yield (), 0.0
            return
        options, single = [], False
        for end in range(at + 1, len(joined) + 1):
            i = model.piece_to_id(joined[at:end])
            if model.id_to_piece(i) == joined[at:end] and np.isfinite(vocabulary.weight[i]):
                options.append((end, (i,), vocabulary.weight[i]))
                single |= end == at + 1
        if not single:
            own = joined[at].encode()
            options.append((at + 1, tuple(vocabulary.byte_ids[list(own)]), vocabulary.byte_weight * len(own)))
        for end, ids, weight in options:
            for more, w in rest(end):
                yield ids + more, weight + w

    found = dict(rest(0))
    total = math.log(sum(math.exp(w) for w in found.values()))
    return {tuple(map(int, ids)): math.exp(w - total) for ids, w in found.items()}


@pytest.mark.parametrize("text", ["ab", "the c", "é\nx", "  a"])
def test_all_segmentations_with_their_chances(text):
    expected = every_segmentation(text)
    ((found),) = sg.segment([text], np.array([5]), PATH, 10_000)
    got = {tuple(ids.tolist()): p for ids, p, _ in found}
    assert len(found) == len(got) and set(got) == set(expected)
    assert all(math.exp(p) == pytest.approx(expected[ids]) for ids, p in got.items())
    assert all(share == pytest.approx(0.0) for _, _, share in found)


def test_first_samples_follow_the_chances():
    text, n, k = "the", 20_000, 3
    expected = every_segmentation(text)
    runs = sg.segment([text] * n, np.arange(n), PATH, k)
    first = Counter(tuple(r[0][0].tolist()) for r in runs)
    second = Counter(tuple(r[1][0].tolist()) for r in runs)
    for ids, p in expected.items():
        assert first[ids] / n == pytest.approx(p, abs=4 * math.sqrt(p * (1 - p) / n) + 1e-3)
        q = sum(o * p / (1 - o) for other, o in expected.items() if other != ids)
        assert second[ids] / n == pytest.approx(q, abs=4 * math.sqrt(q * (1 - q) / n) + 1e-3)
    # One over the inclusion score is an unbiased weight: indicator sums give the chances.
    for ids, p in expected.items():
        weighed = sum(math.exp(lp - s) for r in runs for i, lp, s in r if tuple(i.tolist()) == ids) / n
        assert weighed == pytest.approx(p, abs=0.03)


TEXTS = [None, "", " ", "a", "a\n", "▁x ▁", "ﬁ é \t　日本語🙂🙂", "    four", "long" * 5000, "word " * 4000, "<s> </s>", "x\x00y"]


def test_edge_texts(spark):
    rows = list(enumerate(TEXTS)) + [(None, "a b"), (3, "a"), (3, "a")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("own_0", F.lit("clash"))
    found = sg.sampled(frame, PATH, "doc_id", "own_0", k=3).collect()
    assert all(r["round_trip"] for r in found) and {r["doc_id"] for r in found} == {d for d, _ in rows}
    model, texts = processor(PATH), dict(rows)
    for r in found:
        assert model.decode(list(r["ids"])) == (texts[r["doc_id"]] or "").replace("▁", " ") or r["doc_id"] == 3
        assert r["log_prob"] <= 1e-9 and r["log_inclusion"] <= 1e-9
    for doc in (7, 8, 9):
        assert len({tuple(r["ids"]) for r in found if r["doc_id"] == doc}) == 3
    assert [list(r["ids"]) for r in found if r["doc_id"] == 1] == [[]]
    assert sg.sampled(frame.limit(0), PATH, "doc_id").collect() == []
    texts = sg.decoded(sg.sampled(frame.filter("doc_id = 6"), PATH, "doc_id"), PATH, "doc_id").collect()
    assert {r["text"] for r in texts} == {TEXTS[6]}


def test_pre_tokens_are_built_once_for_many_slices(monkeypatch):
    words = [f"w{n:04d}x" for n in range(300)]
    slices = [[" ".join(words[n : n + 60] + words[:40])] * 3 for n in range(0, 240, 20)]
    seeds, built, build = np.array([4, 5, 6]), [], sg.build
    monkeypatch.setattr(sg, "build", lambda tokens, vocabulary: built.extend(tokens) or build(tokens, vocabulary))
    alone = [sg.segment(texts, seeds, PATH, 2) for texts in slices]
    once = len({w for (text, *_) in slices for w in sg.pre_tokens(text)})
    for held, most in ((sg.HELD, once), (1 << 10, len(built) - 300), (0, len(built))):
        monkeypatch.setattr(sg, "HELD", held)
        built.clear()
        known = sg.Known(sg.pieces(PATH))
        for texts, expected in zip(slices, alone):
            for a, b in zip(sg.segment(texts, seeds, PATH, 2, known), expected):
                assert [(ids.tolist(), p) for ids, p, _ in a] == [(ids.tolist(), p) for ids, p, _ in b]
                assert [s for _, _, s in a] == pytest.approx([s for _, _, s in b])
        assert once <= len(built) <= most


def test_draws_do_not_depend_on_other_pre_tokens():
    tokens = [f" {n}word{n % 7}" for n in range(3000)]
    vocabulary = sg.pieces(PATH)
    together, alone = sg.build(tokens, vocabulary), sg.build(tokens[-1:], vocabulary)
    assert together.reach[-len(alone.reach) :].tolist() == alone.reach.tolist()


@pytest.mark.parametrize("text", ["a b", " a", "a  b", "a \n\n b\n", "\n", " ", "a▁ b", "x\x00 y", "\ta\u3000b "])
def test_pre_tokens_cut_without_an_expression(text):
    assert sg.pre_tokens(text) == split(" " + text)


def test_slices_do_not_matter(spark, monkeypatch):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
    seeds = np.array([d * 7 for d, _ in rows])
    together = sg.segment([t for _, t in rows], seeds, PATH, 2)
    for n, (_, text) in enumerate(rows):
        (alone,) = sg.segment([text], seeds[n : n + 1], PATH, 2)
        assert [a[0].tolist() for a in alone] == [t[0].tolist() for t in together[n]]
        assert len({tuple(a[0].tolist()) for a in alone}) == 2


def test_registered_query_decodes_every_sample(spark, tmp_path):
    rows = [*enumerate(TEXTS), (None, "a b"), (3, "a"), (20, "one two  three\n" * 300)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op4_segmentation"](spark, str(tmp_path)).collect()
    samples = sg.sampled(frame, PATH, "doc_id", k=2).collect()
    texts = {d: (t or "").replace("▁", " ") for d, t in rows}
    assert len(found) == len(samples) and {r["doc_id"] for r in found} == set(texts)
    assert all(r["text_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest() for r in found)
    assert sorted(r["n_pieces"] for r in found) == sorted(len(r["ids"]) for r in samples)


def test_decoding_of_null_and_empty_ids(spark):
    frame = spark.createDataFrame([(0, None), (1, []), (2, processor(PATH).encode("a b")), (3, None), (4, processor(PATH).encode("é"))], "doc_id bigint, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in sg.decoded(frame, PATH, "doc_id").collect()} == {0: None, 1: "", 2: "a b", 3: None, 4: "é"}
    assert sg.decoded(frame.limit(0), PATH, "doc_id").collect() == []

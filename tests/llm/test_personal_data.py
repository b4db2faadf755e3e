"""Personal data against plain Python, and the learnt kinds against planted spans."""

import hashlib
import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rxtally.llm import boosted_trees as bt
from rxtally.llm import personal_data as pd

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for k, c in enumerate(reversed(number)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def passes(kind, match):
    number = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 13 <= len(number) <= 19 and luhn(number)
    return kind == "email" or 9 <= len(number) <= 15


def brute(text):
    return {
        kind: [(m.start(), m.end()) for m in re.finditer(p, text or "") if passes(kind, m.group())] for kind, p in PLAIN.items()
    }


def base_row(doc_id, text):
    found = brute(text)
    lines = ",".join(f"{k}:{s}:{e}" for k in PLAIN for s, e in found[k])
    return (doc_id, *[len(found[k]) for k in PLAIN], hashlib.sha256(lines.encode()).hexdigest())


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


TEXTS = [
    None, "", " ", "a@b.c", "a@b", "a@b.c%d@e.f.", "x@y.z@w.v", "é🙂 a.b+c@d-e.fr é", "a@b." + "c." * 3000 + "c",
    "1.2.3.4", "1.2.3.4.5.6.7.8.9", "256.1.1.1 0255.1.1.001 00000000000001.1.1.1", "1.2.3", "999999999999999999999.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1111, 4111111111111112", "0" * 13, "0" * 20, "1" * 40_000, "4111 1111 1111 1111 0",
    "+1 (692) 555-7565 und +49-30-1234567", "+1+1+1+12345678901", "+123", "+1 (((((", "+1 2 3 4 5 6 7 8 9 10 11 12 13 14",
    "é" * 500 + " a@b.cd 10.0.0.1 " * 700, "a" * 100_000, "a" * 50_000 + "@", "🙂 +4412345678901 🙂 1.1.1.1 🙂",
]


def test_base_kinds(spark):
    table = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a@b.c"), (3, "a@b.c"), (3, "a@b.c")]
    frame = spark.createDataFrame(table, "doc_id bigint, text string").withColumn("own_text", F.lit("clash"))
    frame = frame.withColumn("own_0", F.lit(1)).withColumn("spans", F.lit(1)).withColumn("base_ip", F.lit(1))
    found = pd.digests(frame)
    assert rows(found.drop("spans")) == sorted([base_row(*r) for r in table], key=repr)
    assert found.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    assert pd.digests(frame.limit(0)).collect() == []


def test_patterns_match_as_the_plain_ones(spark):
    draw = random.Random(5)
    table = [(k, "".join(draw.choice("a.@1+- 9%(é") for _ in range(draw.randrange(60)))) for k in range(1500)]
    table += [(-k, "".join(draw.choice("123456789. 0") for _ in range(40))) for k in range(1, 500)]
    frame = spark.createDataFrame(table, "doc_id bigint, text string").repartition(2)
    found = pd.detected(frame, pd.Model(), "doc_id").select("doc_id", "base").collect()
    own = dict(table)
    for r in found:
        assert {k: [tuple(s) for s in v] for k, v in r["base"].items()} == brute(own[r["doc_id"]])


def test_many_spans_in_a_text(spark, monkeypatch):
    monkeypatch.setattr(pd, "BLOCK", 3)
    table = [(n, "é 1.1.1.1 " * n) for n in range(12)]
    frame = spark.createDataFrame(table, "doc_id bigint, text string")
    for r in pd.detected(frame, pd.Model(), "doc_id").collect():
        assert [tuple(s) for s in r["base"]["ip"]] == brute("é 1.1.1.1 " * r["doc_id"])["ip"]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.tuples(st.integers(0, 3), st.integers(0, 3)), st.integers(0, 9), st.integers(0, 9)), max_size=20))
def test_trees(cells):
    model = bt.fit(cells)
    merged = Counter()
    for f, yes, no in cells:
        merged[f, 1] += yes
        merged[f, 0] += no
    loss = lambda odds: sum(
        yes * bt.math.log1p(bt.math.exp(-odds(f))) + no * bt.math.log1p(bt.math.exp(odds(f))) for f, yes, no in cells
    )
    assert loss(model.log_odds) <= loss(lambda f: model.start) + 1e-9


def test_threshold():
    model = bt.fit([((0,), 90.0, 0.0), ((1,), 50.0, 50.0)])
    assert bt.threshold(model, [((0,), 90.0, 0.0), ((1,), 50.0, 50.0)], 0.9, 20) == model.log_odds((0,))
    assert bt.threshold(model, [((0,), 9.0, 0.0)], 0.9, 20) is None


@pytest.fixture(scope="module")
def learnt(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return frame, pd.learn(frame)


def test_learnt_kinds(spark, learnt):
    """Every planted secret of all documents is found, those without a cue too, and plain words are not."""
    frame, model = learnt
    assert model.thresholds["secret"] is not None
    found = pd.detected(frame, model, "doc_id", "text").select("text", F.col("spans.secret").alias("s")).collect()
    planted = missed = wrong = 0
    for r in found:
        own = {r["text"][s["start"] : s["end"]] for s in r["s"]}
        there = set(re.findall(r'(?i)token = "([0-9a-f]{40})"', r["text"] or ""))
        planted, missed, wrong = planted + len(there), missed + len(there - own), wrong + len(own - there)
    assert planted > 100 and missed == 0 and wrong == 0
    texts = [(1, "see 6664da3940a773de99f953f036f20cef21cf920c there"), (2, "Einungtzheitgeungverlich")]
    cues = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert [(r[0], [tuple(s) for s in r[1]]) for r in pd.detected(cues, model, "doc_id").select("doc_id", "spans.secret").collect()] == [
        (1, [(4, 44)]), (2, []),
    ]


def test_learns_from_all_documents(spark):
    """One secret in 500 documents: only all of them together hold enough to set a threshold."""
    secret = F.concat(F.lit('token = "'), F.sha1(F.col("id").cast("string")), F.lit('"'))
    text = F.when(F.col("id") % 500 == 0, secret).otherwise(F.lit("an Unfreundlichkeitsbescheinigung here"))
    frame = spark.range(0, 100_000, 1, 4).select(F.col("id").alias("doc_id"), text.alias("text"))
    model = pd.learn(frame)
    assert model.thresholds["secret"] is not None
    found = pd.detected(frame, model, "doc_id").filter(F.size("spans.secret") > 0)
    assert found.count() == 200


def test_python_and_columns_agree(spark, learnt):
    _, model = learnt
    import itertools

    cells = list(itertools.product([0, 1], [0, 2, 5], [0, 2, 4], [0, 3], [0, 4], [0, 4], [0, 6], [0, 3], [2]))
    frame = spark.createDataFrame(cells, [f"f{k}" for k in range(9)])
    odds = model.trees.column([F.col(f"f{k}") for k in range(9)])
    assert [r[-1] for r in frame.withColumn("o", odds).collect()] == [model.trees.log_odds(c) for c in cells]


def test_redaction(spark, learnt):
    _, model = learnt
    text = 'é a@b.c, 10.0.0.1 and token = "6664da3940a773de99f953f036f20cef21cf920c" +1 (692) 555-7565!'
    frame = spark.createDataFrame([(1, text), (2, None), (3, "a@b.c")], "doc_id bigint, text string")
    assert [tuple(r) for r in pd.redacted(frame, model, "doc_id").orderBy("doc_id").collect()] == [
        (1, 'é [email], [ip] and token = "[secret]" [phone]!'), (2, ""), (3, "[email]"),
    ]


def test_query(spark):
    from rxtally.llm.queries import op12_personal_data

    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    found = op12_personal_data(spark, "/root/testdata/sf0.01")
    assert rows(found.drop("spans")) == sorted([base_row(*map(r.__getitem__, (0, 1))) for r in frame.collect()], key=repr)
    for r in found.collect():
        spans = [s for s in r["spans"].split(",") if s]
        base = [s for s in spans if s.split(":")[0] in PLAIN]
        assert spans == sorted(spans, key=lambda s: (pd.KINDS.index(s.split(":")[0]), int(s.split(":")[1])))
        assert len(base) >= r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"]

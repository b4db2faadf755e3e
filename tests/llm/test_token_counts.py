"""Token counts against the library on whole texts."""

import pytest
from pyspark.sql import functions as F

from rxtally.llm import token_counts
from rxtally.llm.queries import tokenizer

TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "a\n", "\na", "\n", "▁", "▁x ▁", "a▁b", "<s> </s> <unk> <0x0A>", "x\x00y",
    "ﬁ é \t　 é", "日本語 text 🙂🙂", "    four   spaces", "long" * 30_000, "word " * 20_000, "the", "the",
]


def expected(rows, path):
    model = token_counts.processor(path)
    out = []
    for doc, text in rows:
        n = len(model.encode(text or ""))
        out.append((doc, len((text or "").encode()), n, n > 4096))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("head", [0, 3, 1000])
def test_edge_texts(spark, head):
    rows = list(enumerate(TEXTS)) + [(None, "the"), (None, None), (20, "the"), (20, "the")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    frame = frame.withColumn("token", F.lit("x")).withColumn("pieces", F.lit(7)).withColumn("n_bytes", F.lit(7))
    assert found(token_counts.counted(frame, tokenizer(), head=head)) == expected(rows, tokenizer())
    assert token_counts.counted(frame.limit(0), tokenizer(), head=head).collect() == []


def test_driver_documents(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in frame.collect()]
    assert found(token_counts.counted(frame, tokenizer(), head=500)) == expected(rows, tokenizer())

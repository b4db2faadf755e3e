"""Token counts of a SentencePiece model (operator 10), with no list of ids for any text.

No piece of the vocabulary has a space after another character, and none holds a line end, so no merge crosses the
place before a run of spaces or around a line end: a text's tokens are the tokens of its pre-tokens
(``check_vocabulary`` makes sure of that for the model at hand). Pre-tokens are counted over all documents, with sums
on the map side; each distinct one is encoded once, by the library; documents then add up count times pieces.

The frequencies of a document are joined to the pieces in two ways. The ``head``, the most frequent pre-tokens, goes
to every task as a broadcast of at most ``HEAD`` rows and ``HEAD * HEAD_CHARS`` characters, whatever the input. What is
left of a document is joined by a shuffle. Both give the same sums, so the head decides nothing but the way. A
frequent pre-token is in the head, so that no short key of the shuffle is hot.

Defined results: null and empty texts have no bytes and no tokens. Repeated rows come out as often as they stand in
the input. A null doc_id is a doc_id like any other. An empty table gives an empty table. Only doc_id and text are
read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxtally.llm.storage import stored

SPACE = "▁"
HEAD = 200_000
HEAD_CHARS = 40
PRE_TOKEN = rf"\n|[ {SPACE}]+[^ {SPACE}\n]*|[^ {SPACE}\n]+"
CUT = "\x00"
split = re.compile(PRE_TOKEN).findall


@lru_cache(maxsize=4)
def processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def pre_tokens(text: str) -> list[str]:
    """The text's pre-tokens; the first one takes the space that the model puts before a text."""
    if not text:
        return []
    if "  " in text or SPACE in text or CUT in text or text[0] == " ":
        return split(" " + text)
    # Each space begins a pre-token, and each line end is one: they are cut apart without an expression.
    return list(filter(None, f" {text}".replace(" ", f"{CUT} ").replace("\n", f"{CUT}\n{CUT}").split(CUT)))


def count_pieces(path: str, tokens: list[str]) -> list[int]:
    """How many pieces each pre-token has. It is encoded after a line end, which keeps the model's own space away."""
    model = processor(path)
    before = len(model.encode("\n"))
    return [len(ids) - before for ids in model.encode(["\n" + t for t in tokens], num_threads=1)]


def check_vocabulary(path: str) -> None:
    """Raise unless pre-tokens of this model can be encoded one by one."""
    model = processor(path)
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
    if any(SPACE in piece.lstrip(SPACE) or "\n" in piece for piece in pieces):
        raise ValueError("pieces cross the ends of pre-tokens")
    for text in ("", " ", "a", "  a ▁ b ", "\n\n a\n", "ﬁ é \t　x "):
        if len(model.encode(text)) != sum(count_pieces(path, pre_tokens(text))):
            raise ValueError("the model's normalisation is not the identity with one leading space")


def distinct_pre_tokens(documents: DataFrame) -> DataFrame:
    """token, occurrences: every pre-token of the table's texts."""
    tokens = F.regexp_extract_all(F.concat(F.lit(" "), F.col("text")), F.lit(PRE_TOKEN), F.lit(0))
    exploded = documents.filter("length(text) > 0").select(F.explode_outer(tokens).alias("token"))
    return exploded.groupBy("token").agg(F.count("*").alias("occurrences"))


def most_frequent(known: DataFrame, head: int) -> DataFrame:
    """token, pieces of at most ``head`` short pre-tokens, by a floor for their occurrences.

    The floor comes from a histogram of a few hundred steps, so that nothing is sorted and no task sends more than its
    share of the head.
    """
    step = F.floor(F.log2("occurrences") * 8)
    short = known.filter(F.length("token") <= HEAD_CHARS).select("token", "pieces", step.alias("step"))
    floor, size = None, 0
    for row in sorted(short.groupBy("step").count().collect(), reverse=True):
        size += row["count"]
        if size > head:
            break
        floor = row["step"]
    return short.filter(F.lit(False) if floor is None else F.col("step") >= floor).select("token", "pieces")


def counted(documents: DataFrame, path: str, limit: int = 4096, head: int = HEAD) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``documents``."""
    check_vocabulary(path)

    @F.pandas_udf("bigint")
    def pieces(tokens: pd.Series) -> pd.Series:
        return pd.Series(count_pieces(path, tokens.tolist()), dtype="int64")

    known = stored(distinct_pre_tokens(documents).withColumn("pieces", pieces("token")))
    frequent = most_frequent(known, head).toPandas()
    table = documents.sparkSession.sparkContext.broadcast(dict(zip(frequent["token"], frequent["pieces"].tolist())))

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums, rest, counts = [], [], []
            for text in batch["text"]:
                found = Counter(pre_tokens(text or ""))
                left = [token for token in found if token not in table.value]
                counts.append([found.pop(token) for token in left])
                rest.append(left)
                sums.append(sum(n * table.value[token] for token, n in found.items()))
            yield batch.drop(columns="text").assign(known=sums, rest=rest, counts=counts)

    kind = documents.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit(""))
    key = ["doc_id", "n_bytes", "mark"]  # rows equal in all three are repeats with the same tokens
    rows = documents.select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.xxhash64(text).alias("mark"), "text"
    )
    shape = f"doc_id {kind}, n_bytes bigint, mark bigint, known bigint, rest array<string>, counts array<bigint>"
    by_row = stored(rows.mapInPandas(frequencies, shape))
    tail = by_row.select(*key, F.explode(F.arrays_zip("rest", "counts")).alias("left")).select(
        *key, F.col("left.rest").alias("token"), F.col("left.counts").alias("n")
    )
    joined = tail.join(known.select("token", "pieces"), "token").select(
        *key, (F.col("n") * F.col("pieces")).alias("tokens"), F.lit(0).alias("rows")
    )
    sums = (
        by_row.select(*key, F.col("known").alias("tokens"), F.lit(1).alias("rows"))
        .unionByName(joined)
        .groupBy(*key)
        .agg(F.sum("tokens").alias("tokens"), F.sum("rows").cast("int").alias("rows"))
        .withColumn("n_tokens", F.expr("tokens div rows"))
    )
    each = sums.select("doc_id", "n_bytes", "n_tokens", F.explode(F.array_repeat(F.lit(1), F.col("rows"))))
    return each.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

"""Personal data (operator 12): proposed spans, boosted trees over their form and surroundings, calibrated thresholds.

Generators propose spans of a kind, more than are right, and spans of different kinds may overlap. The four base kinds
have a check each (parts of an address, digits and Luhn sum of a card, digits of a phone); what passes stays, what fails
is dropped. Two further generators propose secrets (long runs of letters and digits) and phone numbers without a country
code. Boosted trees score these by length, characters and the characters around them; a kind's threshold is the least
score at which spans of other documents were right as often as ``PRECISION``.

Trees learn from the corpus. Where the surroundings decide, a span has a label: a secret after ``token =`` and the like
is one, a run without digits or of digits alone is none; a number after a country code is a phone number, one that
goes on in more digits is none. The trees do not see what gave the label, and so judge the spans that have none. They
are fitted on counts of feature cells, at most ``product of the bins`` rows, over all documents: a hash of the doc_id puts
three quarters of them under the trees and the rest under the thresholds. A kind with too few labelled spans gets no
threshold and adds nothing.

Everything runs as column expressions in two scans, one to learn and one to find; there is no shuffle but that of the
cells. Patterns are possessive and begin where a run does, so that long runs cost no more than their length; their
matches are those of the plain patterns.

Defined results: null and empty texts have no spans. Rows without a doc_id are found like others and never taken for
learning. Repeated rows come out as often as they stand in the input. An empty table gives an empty table. Only named
columns are read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxtally.llm import boosted_trees
from rxtally.llm.boosted_trees import Boosted
from rxtally.llm.text import let

PRECISION = 0.95
SUPPORT = 20
AROUND = 40  # characters kept before and after a span
BLOCK = 256  # lengths added up together

PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{16,}+",
    "local": r"(?<![0-9+])\(?[0-9]{2,4}+\)?[\x20.-][0-9]{3,4}+[\x20.-][0-9]{3,4}+(?![0-9])",
}
BASE = ("email", "ip", "card", "phone")
ADDED = {"secret": "secret", "local": "phone"}  # generator: kind of its spans
KINDS = (*BASE, "secret")
PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
# Words in front of a secret.
CUE = r"(?i)(?:token|secret|password|passwd|api[_-]?key)[\x22']?\s*[:=]\s*[\x22']?$"
COUNTRY = r"\+[0-9]{1,3}[\x20.(-]*$"
SPAN = "struct<start: bigint, end: bigint>"


def digits(text: Column) -> Column:
    return F.translate(text, "+ ().-", "")


# What a base span must pass.
CHECKS: dict[str, Callable[[Column], Column]] = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(rf"^{PART}(?:\.{PART}){{3}}$"),
    "card": lambda m: F.length(digits(m)).between(13, 19) & F.call_function("luhn_check", digits(m)),
    "phone": lambda m: F.length(digits(m)).between(9, 15),
}
# Characters without which a pattern cannot match.
NEEDS = {"email": "@", "phone": "+"}


def running(lengths: Column) -> Column:
    """Sums of the lengths up to each place, itself included.

    Sums grow an array step by step, which copies it; so they are made for blocks, and for the blocks' totals.
    """
    empty = F.array().cast("array<bigint>")
    sums = lambda xs: F.aggregate(
        xs, empty, lambda done, x: F.concat(done, F.array(F.coalesce(F.get(done, F.size(done) - 1), F.lit(0)) + x))
    )
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda t, x: t + x)

    def by_block(xs: Column) -> Column:
        at = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / BLOCK).cast("int"))
        blocks = F.transform(at, lambda b: F.slice(xs, b * BLOCK + 1, F.lit(BLOCK)))
        return let(blocks, lambda bs: let(sums(F.transform(bs, total)), lambda ends: joined(bs, ends)))

    def joined(bs: Column, ends: Column) -> Column:
        before = lambda b: F.when(b == 0, F.lit(0)).otherwise(F.get(ends, b - 1))
        return F.flatten(F.transform(bs, lambda xs, b: F.transform(sums(xs), lambda s: s + before(b))))

    long = F.transform(lengths, lambda x: x.cast("long"))
    return let(long, lambda xs: F.when(F.size(xs) <= BLOCK, sums(xs)).otherwise(by_block(xs)))


def proposed(text: Column, generator: str) -> Column:
    """start, end (code points), match, before, after of a generator's spans; neighbours end what is before and after.

    A text is cut at the matches; what lies between gives their places.
    """
    pattern = F.lit(PATTERNS[generator])
    kind = "array<struct<start: bigint, end: bigint, match: string, before: string, after: string>>"

    def placed(matches: Column) -> Column:
        return let(F.split(text, PATTERNS[generator], -1), lambda gaps: let(starts(matches, gaps), lambda s: spans(matches, gaps, s)))

    def starts(matches: Column, gaps: Column) -> Column:
        before = lambda k: F.when(k == 0, F.lit(0)).otherwise(F.length(F.get(matches, k - 1)))
        return running(F.transform(matches, lambda m, k: F.length(F.get(gaps, k)) + before(k)))

    def spans(matches: Column, gaps: Column, places: Column) -> Column:
        return F.transform(
            matches,
            lambda m, k: F.struct(
                F.get(places, k).alias("start"),
                (F.get(places, k) + F.length(m)).alias("end"),
                m.alias("match"),
                F.right(F.get(gaps, k), F.lit(AROUND)).alias("before"),
                F.left(F.get(gaps, k + 1), F.lit(AROUND)).alias("after"),
            ),
        )

    found = let(
        F.regexp_extract_all(text, pattern, F.lit(0)),
        lambda ms: F.when(F.size(ms) == 0, F.array().cast(kind)).otherwise(placed(ms)),
    )
    if generator in NEEDS:
        return F.when(F.contains(text, F.lit(NEEDS[generator])), found).otherwise(F.array().cast(kind))
    return found


def _class(character: Column) -> Column:
    """What stands beside a span. Quotes count as space: they come with the words that give a secret its label."""
    return (
        F.when(character.rlike(r"^[0-9]"), 2)
        .when(character.rlike(r"^[A-Za-z]"), 3)
        .when(character.rlike(r"^[\s\x22'`]|^$"), 0)
        .otherwise(1)
    )


def features(span: Column, generator: str) -> list[Column]:
    """Small whole numbers: the generator, length, characters inside and around."""
    m, size = span["match"], F.length(span["match"])
    without = lambda signs: size - F.length(F.regexp_replace(m, signs, ""))
    share = lambda signs: F.floor(without(signs) * 4 / size).cast("int")
    length = sum(((size >= edge).cast("int") for edge in (12, 16, 20, 32, 48)), F.lit(0))
    distinct = F.size(F.array_distinct(F.split(m, "")))
    return [
        F.lit(list(ADDED).index(generator)),
        length,
        share("[0-9]"),
        share("[A-Z]"),
        share("[a-z]"),
        F.least(without("[^A-Za-z0-9]"), F.lit(4)).cast("int"),
        F.least(F.floor(distinct / 4), F.lit(6)).cast("int"),
        _class(F.right(span["before"], F.lit(1))),
        _class(F.left(span["after"], F.lit(1))),
    ]


def label(span: Column, generator: str) -> Column:
    """1 or 0 where the surroundings, or the lack of any digit or letter, decide; else null."""
    m, before, after = span["match"], span["before"], span["after"]
    if generator == "secret":
        plain = ~m.rlike("[0-9]") | ~m.rlike("[A-Za-z]")
        return F.when(plain, 0).when(before.rlike(CUE), 1)
    goes_on = before.rlike(r"[0-9][\x20.-]?$") | after.rlike(r"^[\x20.-]?[0-9]")
    return F.when(goes_on & ~before.rlike(COUNTRY), 0).when(before.rlike(COUNTRY), 1)


@dataclass(frozen=True)
class Model:
    """Trees, and by generator the log odds from which on a span is redacted; None: never."""

    trees: Boosted = field(default_factory=Boosted)
    thresholds: dict[str, float | None] = field(default_factory=dict)


def learn(documents: DataFrame, precision: float = PRECISION, support: int = SUPPORT) -> Model:
    """Trees fitted on the labelled spans of three quarters of all documents with a doc_id, thresholds on the rest."""
    named = documents.filter(F.col("doc_id").isNotNull())
    text = F.coalesce(F.col("text"), F.lit(""))
    names = [f"f{k}" for k in range(9)]

    def cells(generator: str) -> Column:
        row = lambda s: F.struct(
            *[f.alias(n) for f, n in zip(features(s, generator), names)], label(s, generator).alias("label")
        )
        return F.filter(F.transform(proposed(text, generator), row), lambda c: c["label"].isNotNull())

    rows = named.select(
        (F.pmod(F.xxhash64(F.lit(13), "doc_id"), F.lit(4)) == 0).alias("tested"),
        F.explode(F.concat(*[cells(g) for g in ADDED])).alias("c"),
    )
    counted = (
        rows.groupBy("tested", *[F.col(f"c.{n}").alias(n) for n in names])
        .agg(F.sum(F.col("c.label")).alias("yes"), F.count("*").alias("every"))
        .collect()
    )
    both: dict[bool, list[boosted_trees.Cell]] = {True: [], False: []}
    for r in counted:
        both[r["tested"]].append((tuple(r[n] for n in names), float(r["yes"]), float(r["every"] - r["yes"])))
    trees = boosted_trees.fit(both[False])
    if not trees.trees:
        return Model()
    own = lambda k: [c for c in both[True] if c[0][0] == k]
    return Model(trees, {g: boosted_trees.threshold(trees, own(k), precision, support) for k, g in enumerate(ADDED)})


def base_spans(text: Column, kind: str) -> Column:
    passing = F.filter(proposed(text, kind), lambda s: CHECKS[kind](s["match"]))
    return F.transform(passing, lambda s: F.struct(s["start"], s["end"])).cast(f"array<{SPAN}>")


def added_spans(text: Column, generator: str, model: Model) -> Column:
    """Spans of a further generator at or above its threshold."""
    least = model.thresholds.get(generator)
    if least is None:
        return F.array().cast(f"array<{SPAN}>")
    chosen = F.filter(
        proposed(text, generator),
        # The trees only judge what could be personal data at all.
        lambda s: F.coalesce(label(s, generator) != 0, F.lit(True)) & (model.trees.column(features(s, generator)) >= least),
    )
    return F.transform(chosen, lambda s: F.struct(s["start"], s["end"])).cast(f"array<{SPAN}>")


def detected(documents: DataFrame, model: Model, *keep: str) -> DataFrame:
    """The kept columns with base and spans: maps of kinds to spans, in order. Base spans are always among the spans.

    An added span inside a base span is left out; one that reaches beyond stays beside it.
    """
    names = [f"own_{k}" for k in range(len(keep))]
    rows = documents.select(*map(F.col, keep), F.coalesce("text", F.lit("")).alias("own_text")).toDF(*names, "own_text")
    text = F.col("own_text")
    made = rows.select(
        *names,
        *[base_spans(text, kind).alias(f"base_{kind}") for kind in BASE],
        *[added_spans(text, g, model).alias(f"added_{g}") for g in ADDED],
    )
    whole = F.concat(*[F.col(f"base_{kind}") for kind in BASE])
    outside = lambda s: ~F.exists(whole, lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"]))

    def spans(kind: str) -> Column:
        own = [F.filter(f"added_{g}", outside) for g, k in ADDED.items() if k == kind]
        base = [F.col(f"base_{kind}")] if kind in BASE else []
        return F.array_sort(F.concat(*base, *own)) if own else base[0]

    as_map = lambda kinds, of: F.create_map(*[x for k in kinds for x in (F.lit(k), of(k))])
    return made.select(
        *names, as_map(BASE, lambda k: F.col(f"base_{k}")).alias("base"), as_map(KINDS, spans).alias("spans")
    ).toDF(*keep, "base", "spans")


def listed(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of all spans by kind and start, joined by commas."""

    def lines(kind: str) -> Column:
        return F.transform(spans[kind], lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))

    return F.array_join(F.concat(*map(lines, kinds)), ",")


def redacted(documents: DataFrame, model: Model, *keep: str) -> DataFrame:
    """The kept columns with redacted: the text with ``[kind]`` in place of each span; of overlapping ones the first."""
    rows = documents.withColumn("own_kept", F.struct(*keep, F.coalesce("text", F.lit("")).alias("own_text")))
    found = detected(rows, model, "own_kept")

    def marked(kind: str) -> Column:
        return F.transform(F.col("spans")[kind], lambda s: F.struct(s["start"], s["end"], F.lit(kind).alias("kind")))

    every = F.concat(*map(marked, KINDS))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("done"))
    text = F.col("own_kept.own_text")

    def put(state: Column, s: Column) -> Column:
        size = F.greatest(s["start"] - state["at"], F.lit(0)).cast("int")
        kept = F.substr(text, (state["at"] + 1).cast("int"), size)
        mark = F.when(s["start"] >= state["at"], F.concat(kept, F.lit("["), s["kind"], F.lit("]"))).otherwise("")
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.concat(state["done"], mark).alias("done"))

    rest = lambda state: F.concat(state["done"], F.substr(text, (state["at"] + 1).cast("int")))
    return found.select("own_kept.*", F.aggregate(F.array_sort(every), start, put, rest).alias("own_redacted")).select(
        *keep, F.col("own_redacted").alias("redacted")
    )


def digests(documents: DataFrame) -> DataFrame:
    """doc_id, numbers of base spans by kind, the base spans' digest, and all spans."""
    found = detected(documents, learn(documents), "doc_id")
    return found.select(
        "doc_id",
        *[F.size(F.col("base")[k]).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(listed(F.col("base"), BASE), 256).alias("base_sha256"),
        listed(F.col("spans"), KINDS).alias("spans"),
    )

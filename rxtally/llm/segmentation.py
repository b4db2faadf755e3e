"""Sampled SentencePiece segmentations without replacement, and decoding (operator 4).

The lattice of a text has its characters' boundaries as states and the vocabulary's pieces as edges; a character that
no piece holds is an edge of its bytes. The weight of a piece falls with its place in the vocabulary, which is that of
its merge: ``1 / (place + OFFSET)`` to the power ``SHARPNESS``. Sums of weights from each state to the end make every
edge a probability, so that walks from the start draw segmentations of the whole text in proportion to their weight.

No piece crosses the place before a run of spaces or around a line end (see ``token_counts``), so that the lattice of a
text is the chain of its pre-tokens' lattices. Each distinct pre-token of a slice of rows is built once, and kept for
the task's later slices (``Known``).

The ``k`` samples are the Gumbel top k, found by perturbed A* search. A region is a prefix with the edges that may not
come next. Its bound is the largest of its segmentations' perturbed log probabilities, drawn as one Gumbel variable
under the bound it was split from. The search takes the region with the largest bound, draws its best segmentation
edge by edge, emits it, and splits the rest of the region along it, into one region for each step. So the samples are
distinct and come in the order of their perturbed values. The bound that would come next, kappa, gives each one's
inclusion score, ``1 - exp(-exp(log_prob - kappa))``, here as its logarithm: one divided by it weighs the sample.

Every random number is a hash of the row's key, the sample, and the place, so that neither slices nor tasks matter.

Defined results: null and empty texts have one segmentation, the empty one. A text with fewer than k segmentations
gives all of them, each with inclusion one. Repeated rows give the same samples. ``▁`` in a text is decoded as a space,
as the library does. An empty table gives an empty table. The kept columns may have any name but those of the result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, fields
from functools import lru_cache
from itertools import compress, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxtally.llm.token_counts import SPACE, check_vocabulary, pre_tokens, processor

OFFSET = 10.0
SHARPNESS = 1.0
SLICE = 1 << 19  # characters of text, or pieces, worked on together
HELD = 1 << 21  # states of lattices kept for later slices
SLOTS = 1 << 18  # of the trie's hash table: small enough for a core's cache
NEAR = 1024  # steps of a path looked at for where its regions may end, after that of the region taken
LIFT, SPARE = 37.5, 8.0  # a draw of at most 1 - 2^-54 gives a Gumbel variable under 37.5
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(*numbers: np.ndarray | int, after: np.ndarray | int = 0) -> np.ndarray:
    """A 64-bit hash of each row of whole numbers, going on from another hash."""
    x = np.asarray(after).astype(np.uint64)
    with np.errstate(over="ignore"):
        for number in numbers:
            x = np.asarray(number).astype(np.int64).view(np.uint64) + (x + np.uint64(1)) * GOLDEN
            x ^= x >> np.uint64(30)
            x *= M1
            x ^= x >> np.uint64(27)
            x *= M2
            x ^= x >> np.uint64(31)
    return x


def uniform(*numbers: np.ndarray | int, after: np.ndarray | int = 0) -> np.ndarray:
    """A number between 0 and 1, both excluded, for each row of whole numbers."""
    return ((mixed(*numbers, after=after) >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


@dataclass(frozen=True)
class Pieces:
    """The vocabulary as a trie of characters in a hash table, with log weights."""

    keys: np.ndarray
    nexts: np.ndarray
    piece: np.ndarray  # of a trie node, or -1
    weight: np.ndarray  # log weight of a piece
    byte_ids: np.ndarray
    byte_weight: float
    spelled: pa.LargeBinaryArray  # the bytes of each piece

    def step(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The trie node after one more character; -1 if there is none."""
        wanted = nodes.astype(np.int64) << 21 | codes
        slot = _slot(wanted)
        key = self.keys[slot]
        out = np.where(key == wanted, self.nexts[slot], -1)
        open_ = np.flatnonzero((key != wanted) & (key >= 0))
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) % SLOTS
            key = self.keys[slot]
            hit = key == wanted[open_]
            out[open_[hit]] = self.nexts[slot[hit]]
            more = ~hit & (key >= 0)
            open_, slot = open_[more], slot[more]
        return out


def _slot(keys: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((keys.astype(np.uint64) * GOLDEN) >> np.uint64(46)).astype(np.int64)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    model = processor(path)
    children: dict[tuple[int, int], int] = {}
    at_node, weight, spelled, byte_ids = {}, np.full(model.vocab_size(), -np.inf), [], np.zeros(256, np.int64)
    for i in range(model.vocab_size()):
        text = model.id_to_piece(i)
        spelled.append(text.replace(SPACE, " ").encode())
        if model.is_byte(i):
            byte_ids[int(text[3:5], 16)] = i
            spelled[i] = bytes([int(text[3:5], 16)])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            weight[i] = -SHARPNESS * np.log(len(at_node) + 1 + OFFSET)
            node = 0
            for c in text:
                node = children.setdefault((node, ord(c)), len(children) + 1)
            at_node[node] = i
    keys, nexts = np.full(SLOTS, -1, np.int64), np.zeros(SLOTS, np.int64)
    wanted = np.array([n << 21 | c for n, c in children], np.int64)
    for key, slot, node in zip(wanted.tolist(), _slot(wanted).tolist(), children.values()):
        while keys[slot] >= 0:
            slot = (slot + 1) % SLOTS
        keys[slot], nexts[slot] = key, node
    piece = np.full(len(children) + 1, -1, np.int64)
    piece[list(at_node)] = list(at_node.values())
    least = -SHARPNESS * np.log(model.vocab_size() + OFFSET)
    return Pieces(keys, nexts, piece, weight, byte_ids, float(least), pa.array(spelled, pa.large_binary()))


@dataclass(frozen=True)
class Lattice:
    """Lattices of many pre-tokens: states are places in their joined characters, edges lie by state."""

    begin: np.ndarray  # first state of a pre-token
    final: np.ndarray  # whether a state is the end of a pre-token
    first: np.ndarray  # first edge of a state; the end of a pre-token has none
    target: np.ndarray
    label: np.ndarray  # piece, or -1 - character for its bytes
    log_chance: np.ndarray
    reach: np.ndarray  # chances up to and with the edge, in its state


def build(tokens: list[str], vocabulary: Pieces) -> Lattice:
    """The lattices of distinct pre-tokens."""
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    joined = "".join(tokens).replace(" ", SPACE)
    codes = np.zeros(len(joined) + len(tokens), np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    last = np.zeros(len(codes), bool)
    last[begin + sizes] = True
    codes[~last] = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    # All places walk the trie together, one character a step; where a piece ends there is an edge.
    start = np.flatnonzero(~last)
    node, length, found = np.zeros(len(start), np.int64), 0, []
    whole = start
    while len(start):
        inside = ~last[start + length]
        start, node = start[inside], node[inside]
        node = vocabulary.step(node, codes[start + length])
        length += 1
        start, node = start[node >= 0], node[node >= 0]
        ends = vocabulary.piece[node]
        found.append((start[ends >= 0], np.full(int((ends >= 0).sum()), length), ends[ends >= 0]))
    single = np.zeros(len(codes), bool)
    if found:
        single[found[0][0]] = True
    lone = whole[~single[whole]]
    found.append((lone, np.ones(len(lone), np.int64), -1 - codes[lone]))
    # Edges by state: each round of the walk has one edge of a state at most, so that no sort is needed.
    degree = np.bincount(np.concatenate([source for source, _, _ in found]), minlength=len(codes))
    first = np.r_[0, np.cumsum(degree)]
    free, n_edges = first[:-1].copy(), int(first[-1])
    source, target, label = np.repeat(np.arange(len(codes)), degree), np.empty(n_edges, np.int32), np.empty(n_edges, np.int32)
    for states, steps, ends in found:
        place = free[states]
        free[states] += 1
        target[place], label[place] = states + steps, ends
    code = np.maximum(-1 - label, 0)
    n_bytes = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
    weight = np.where(label >= 0, vocabulary.weight[np.maximum(label, 0)], n_bytes * vocabulary.byte_weight)
    # Sums to the end, from the last states back: all states as far from the end of their pre-token together.
    to_end = np.repeat(begin + sizes, sizes + 1) - np.arange(len(codes))
    ahead, value = np.zeros(len(codes)), np.zeros(len(source))
    furthest = int(sizes.max(initial=0))
    by_distance = np.argsort(to_end.astype(np.uint16) if furthest < 1 << 16 else to_end, kind="stable")
    bounds = np.cumsum(np.bincount(to_end, minlength=furthest + 1))
    for a, b in zip(bounds, bounds[1:]):
        states = by_distance[a:b]
        n = first[states + 1] - first[states]
        heads = np.cumsum(n) - n
        edges = np.repeat(first[states] - heads, n) + np.arange(n.sum())
        own = weight[edges] + ahead[target[edges]]
        top = np.maximum.reduceat(own, heads)
        value[edges] = own
        ahead[states] = top + np.log(np.add.reduceat(np.exp(own - np.repeat(top, n)), heads))
    log_chance = np.minimum(value - ahead[source], 0.0)
    # Added up within each state alone, so that it does not matter which other pre-tokens the lattice has.
    reach, last_edge = np.exp(log_chance), first[1:] - 1
    more = first[:-1][degree > 1] + 1
    ends = last_edge[degree > 1]
    while len(more):
        reach[more] += reach[more - 1]
        going = more < ends
        more, ends = more[going] + 1, ends[going]
    reach[last_edge[degree > 0]] = 2.0  # the last edge of a state, whatever was lost by rounding
    return Lattice(begin, last, first, target, label, log_chance, reach)


class Grown:
    """An array that others are put behind, in place while there is room."""

    def __init__(self, kind: type):
        self.room, self.size = np.empty(1 << 10, kind), 0

    def add(self, values: np.ndarray) -> np.ndarray:
        """All values so far, the new ones last."""
        end = self.size + len(values)
        if end > len(self.room):
            room = np.empty(max(end, 2 * len(self.room)), self.room.dtype)
            room[: self.size] = self.room[: self.size]
            self.room = room
        self.room[self.size : end] = values
        self.size = end
        return self.room[:end]


class Known:
    """Pre-tokens with their lattices, kept from slice to slice.

    Once they have over ``HELD`` states, only those are kept that came in more than one slice since the last time.
    """

    def __init__(self, vocabulary: Pieces):
        self.vocabulary = vocabulary
        self._clear()

    def _clear(self) -> None:
        self.numbers: defaultdict[str, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.again = np.zeros(0, bool)
        self.states, self.edges = 0, 0
        kinds = {"final": bool, "begin": np.int64, "first": np.int64, "target": np.int32, "label": np.int32}
        self.arrays = {f.name: Grown(kinds.get(f.name, np.float64)) for f in fields(Lattice)}

    def _thin_out(self) -> None:
        kept = list(compress(self.numbers, self.again.tolist()))
        self._clear()
        if sum(map(len, kept)) + len(kept) <= HELD // 2:
            for token in kept:
                self.numbers[token]

    def lattice(self, texts: list[str]) -> tuple[Lattice, list[np.ndarray]]:
        """A lattice that has all pre-tokens of the texts, and for every text the numbers of its own."""
        if self.states > HELD:
            self._thin_out()
        built, number = len(self.again), self.numbers.__getitem__
        tokens = [np.fromiter(map(number, pre_tokens(text)), np.int64) for text in texts]
        self.again = np.r_[self.again, np.zeros(len(self.numbers) - built, bool)]
        for own in tokens:
            self.again[own[own < built]] = True
        new = list(islice(reversed(self.numbers), len(self.numbers) - built))[::-1]
        own = build(new, self.vocabulary)
        # The end of the edges stands behind the last state, where the next lattice begins.
        self.arrays["first"].size = self.states
        moved = {"begin": self.states, "first": self.edges, "target": self.states}
        values = {name: getattr(own, name) + moved[name] if name in moved else getattr(own, name) for name in self.arrays}
        every = Lattice(**{name: array.add(values[name]) for name, array in self.arrays.items()})
        self.states, self.edges = len(every.final), len(every.target)
        return every, tokens


def walk(lattice: Lattice, state: np.ndarray, hashes: np.ndarray):
    """Edges from each state to the end of its pre-token, drawn by their chances: (edges, how many of each walk)."""
    counts, steps = np.zeros(len(state), np.int64), []
    active = np.flatnonzero(~lattice.final[state])
    state, hashes = state[active], hashes[active]
    while len(active):
        draw, edge = uniform(len(steps), after=hashes), lattice.first[state]
        late = np.flatnonzero(lattice.reach[edge] < draw)
        while len(late):
            edge[late] += 1
            late = late[lattice.reach[edge[late]] < draw[late]]
        steps.append((active, edge))
        counts[active] += 1
        state = lattice.target[edge]
        going = np.flatnonzero(~lattice.final[state])
        active, state, hashes = active[going], state[going], hashes[going]
    offsets = np.cumsum(counts) - counts
    edges = np.zeros(int(counts.sum()), np.int64)
    for n, (walks, edge) in enumerate(steps):
        edges[offsets[walks] + n] = edge
    return edges, counts


def gumbel_under(mass: np.ndarray, bound: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """A Gumbel variable of this log mass, given that it is under the bound."""
    with np.errstate(divide="ignore", over="ignore"):
        return mass - np.log(np.exp(mass - bound) - np.log(draw))


@dataclass
class Region:
    bound: float
    path: int  # the sample along which it was split off
    step: int
    prefix: float  # log probability of the steps before
    excluded: list[int]


def top_k(lattice: Lattice, tokens: list[np.ndarray], seeds: np.ndarray, k: int):
    """For every row its samples: (edges, log probability, log inclusion), best first."""
    rows = len(tokens)
    pools: list[list[Region]] = [[] for _ in range(rows)]
    samples: list[list[tuple[np.ndarray, float]]] = [[] for _ in range(rows)]
    kappa = np.full(rows, -np.inf)
    # The region taken next: the whole lattice first.
    taken = [Region(float(-np.log(-np.log(u))), -1, 0, 0.0, []) for u in uniform(seeds, -1)]
    owners = np.arange(rows)
    for sample in range(k):
        kept_edges, states, place, parts = [], [], [], []
        picks, own = uniform(seeds, sample, -2), mixed(seeds, sample)
        for row in owners.tolist():
            region, words = taken[row], tokens[row]
            if region.path < 0:
                prefix, rest = np.zeros(0, np.int64), lattice.begin[words]
                where = np.arange(len(words))
            else:
                # The other edges of the state where the region was split off, by their chances.
                edges = samples[row][region.path][0]
                at = _source(lattice, edges[region.step])
                choice = np.arange(lattice.first[at], lattice.first[at + 1])
                choice = np.delete(choice, np.array(region.excluded) - choice[0])
                reach = np.cumsum(np.exp(lattice.log_chance[choice]))
                pick = choice[np.searchsorted(reach[:-1], reach[-1] * picks[row])]
                prefix = np.append(edges[: region.step], pick)
                done = int(lattice.final[lattice.target[edges[: region.step]]].sum())
                rest = np.append(lattice.target[pick], lattice.begin[words[done + 1 :]])
                where = np.arange(done, len(words))
            kept_edges.append(prefix)
            states.append(rest)
            place.append(where)
            parts.append(len(rest))
        hashes = mixed(np.concatenate(place), after=np.repeat(own[owners], parts))
        drawn, counts = walk(lattice, np.concatenate(states), hashes)
        ends = np.r_[0, np.cumsum(counts)][np.cumsum(parts)]
        paths = [np.concatenate([p, d]) for p, d in zip(kept_edges, np.split(drawn, ends[:-1]))]
        _split(lattice, owners, paths, taken, pools, samples, seeds, sample, k)
        left = []
        for row in owners.tolist():
            pools[row].sort(key=lambda r: -r.bound)
            if pools[row]:
                kappa[row] = pools[row][0].bound
                taken[row] = pools[row].pop(0)
                left.append(row)
            else:
                kappa[row] = -np.inf
        owners = np.array(left, np.int64)
        if not len(left):
            break
    out = []
    for row in range(rows):
        with np.errstate(over="ignore", divide="ignore"):
            shares = [np.log(-np.expm1(-np.exp(min(p - kappa[row], 700.0)))) if p - kappa[row] > -30 else p - kappa[row] for _, p in samples[row]]
        out.append([(edges, p, float(s)) for (edges, p), s in zip(samples[row], shares)])
    return out


def _source(lattice: Lattice, edge: int) -> int:
    return int(np.searchsorted(lattice.first, edge, "right")) - 1


def _split(lattice, owners, paths, taken, pools, samples, seeds, sample, k) -> None:
    """Note the drawn paths as samples, and put what is left of their regions into the pools.

    Of each path only as many regions as may still be taken are kept, and one more for kappa. The mass of a region
    falls from step to step, and no draw lifts a bound by more than ``LIFT`` over its mass. So the steps up to a mass
    ``LIFT + SPARE`` under the bound of the region taken have nearly always all of them; if a later step could still be
    among them, all steps are looked at.
    """
    wanted, near = k - sample, []
    for n, row in enumerate(owners.tolist()):
        logs, region = lattice.log_chance[paths[n]], taken[row]
        samples[row].append((paths[n], float(logs.sum())))
        begin = max(region.step, 0) + NEAR
        far = np.searchsorted(-np.cumsum(logs[:begin]), LIFT + SPARE - region.bound)
        near.append(min(len(logs), max(int(far) + 1, region.step + 1)))
    found = _regions(lattice, owners, paths, np.array(near), taken, seeds, sample)
    largest, again = [_largest(bounds, wanted) for bounds, *_ in found], []
    for n, (bounds, _, _, last) in enumerate(found):
        if near[n] < len(paths[n]) and (len(bounds) < wanted or bounds[largest[n][-1]] <= last + LIFT):
            again.append(n)
    if again:
        whole = [paths[n] for n in again]
        sizes = np.array([len(p) for p in whole])
        for n, region in zip(again, _regions(lattice, owners[again], whole, sizes, taken, seeds, sample)):
            found[n], largest[n] = region, _largest(region[0], wanted)
    for n, row in enumerate(owners.tolist()):
        bounds, prefixes, steps, _ = found[n]
        for i in largest[n].tolist():
            step, edge = int(steps[i]), int(paths[n][steps[i]])
            others = [*taken[row].excluded, edge] if taken[row].path >= 0 and step == taken[row].step else [edge]
            pools[row].append(Region(float(bounds[i]), len(samples[row]) - 1, step, float(prefixes[i]), others))


def _largest(bounds: np.ndarray, wanted: int) -> np.ndarray:
    """Where the largest bounds are, the largest first."""
    among = np.arange(len(bounds))
    if len(bounds) > 2 * wanted:
        among = np.flatnonzero(bounds >= np.partition(bounds, len(bounds) - wanted)[len(bounds) - wanted])
    return among[np.argsort(-bounds[among], kind="stable")[:wanted]]


def _regions(lattice, owners, paths, sizes, taken, seeds, sample):
    """For every path the bounds, prefixes and steps of its regions, and the log probability of the steps looked at."""
    edges = np.concatenate([p[:n] for p, n in zip(paths, sizes)])
    begins = np.cumsum(sizes) - sizes
    logs = lattice.log_chance[edges]
    total = np.cumsum(logs)
    owner = np.repeat(np.arange(len(paths)), sizes)
    before = total - logs - np.r_[0.0, total][begins][owner]
    step = np.arange(len(edges)) - begins[owner]
    regions = [taken[row] for row in owners.tolist()]
    at = np.array([r.step if r.path >= 0 else -1 for r in regions])[owner]
    bound = np.array([r.bound for r in regions])[owner]
    excluded = np.array([np.exp(lattice.log_chance[r.excluded]).sum() if r.excluded else 0.0 for r in regions])
    gone = np.exp(logs) + np.where(step == at, excluded[owner], 0.0)
    live = np.flatnonzero((step >= at) & (gone < 1 - 1e-12))
    own, prefix = owner[live], before[live]
    draw = uniform(step[live], after=mixed(seeds[owners], sample, -3)[own])
    keys = gumbel_under(prefix + np.log1p(-gone[live]), bound[live], draw)
    cuts = np.searchsorted(own, np.arange(len(paths) + 1))
    ends = np.r_[total, 0.0][np.maximum(begins + sizes - 1, 0)] - np.r_[0.0, total][begins]
    return [(keys[a:b], prefix[a:b], step[live[a:b]], e) for a, b, e in zip(cuts, cuts[1:], ends)]


def ids_of(edges: np.ndarray, lattice: Lattice, vocabulary: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of edges, and how many each has: a character without a piece gives one for each of its bytes."""
    labels = lattice.label[edges]
    counts, spelled = np.ones(len(labels), np.int64), np.flatnonzero(labels < 0)
    own = [chr(c).encode("utf-8", "surrogatepass") for c in (-1 - labels[spelled]).tolist()]
    counts[spelled] = list(map(len, own))
    ids = np.repeat(labels, counts)
    ids[ids < 0] = vocabulary.byte_ids[np.frombuffer(b"".join(own), np.uint8)]
    return ids, counts


def decode(sequences: list[np.ndarray], vocabulary: Pieces) -> list[str]:
    """The texts of sequences of pieces, without the space that the model puts in front."""
    ids = np.concatenate([np.zeros(0, np.int64), *sequences])
    joined = vocabulary.spelled.take(pa.array(ids))
    at = np.frombuffer(joined.buffers()[1], np.int64)[np.cumsum([0, *map(len, sequences)])].tolist()
    data = memoryview(joined.buffers()[2] or b"")
    texts = [bytes(data[a:b]) for a, b in zip(at, at[1:])]
    return [(t[1:] if t[:1] == b" " else t).decode("utf-8", "replace") for t in texts]


def segment(texts: list[str], seeds: np.ndarray, path: str, k: int, known: Known | None = None):
    """For every text its samples: (ids, log probability, log inclusion)."""
    vocabulary = pieces(path)
    lattice, tokens = (known or Known(vocabulary)).lattice(texts)
    found = top_k(lattice, tokens, seeds, k)
    paths = [edges for samples in found for edges, _, _ in samples]
    ids, counts = ids_of(np.concatenate([np.zeros(0, np.int64), *paths]), lattice, vocabulary)
    ends = np.r_[0, np.cumsum(counts)][np.cumsum([0, *map(len, paths)])].tolist()
    own = (ids[a:b] for a, b in zip(ends, ends[1:]))
    return [[(next(own), p, s) for _, p, s in samples] for samples in found]


SAMPLE = [
    T.StructField("rank", T.IntegerType()),
    T.StructField("ids", T.ArrayType(T.IntegerType())),
    T.StructField("log_prob", T.DoubleType()),
    T.StructField("log_inclusion", T.DoubleType()),
    T.StructField("round_trip", T.BooleanType()),
]


def sampled(documents: DataFrame, path: str, *keep: str, k: int = 2, seed: int = 0) -> DataFrame:
    """The kept columns with rank, ids, log_prob, log_inclusion and round_trip, k rows at most for every document."""
    check_vocabulary(path)
    names = [f"own_{i}" for i in range(len(keep))]
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(F.xxhash64(F.lit(seed), "doc_id"), text, *map(F.col, keep)).toDF("seed_", "text_", *names)
    kinds = [T.StructField(n, documents.schema[c].dataType) for c, n in zip(keep, names)]

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(pieces(path))
        for batch in batches:
            sizes, at = np.cumsum([len(t) for t in batch.column(1).to_pylist()]), 0
            while at < batch.num_rows:
                base = sizes[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(sizes, base + SLICE, "right")))
                yield _rows(batch.slice(at, end - at), known)
                at = end

    def _rows(batch: pa.RecordBatch, known: Known) -> pa.RecordBatch:
        texts, vocabulary = batch.column(1).to_pylist(), pieces(path)
        found = segment(texts, batch.column(0).to_numpy(), path, k, known)
        owner = np.repeat(np.arange(len(texts)), [len(s) for s in found])
        flat = [s for samples in found for s in samples]
        back = decode([ids for ids, _, _ in flat], vocabulary)
        back = [text == texts[o].replace(SPACE, " ") for o, text in zip(owner.tolist(), back)]
        offsets = np.cumsum([0, *(len(ids) for ids, _, _ in flat)]).astype(np.int32)
        values = np.concatenate([np.zeros(0, np.int64), *(ids for ids, _, _ in flat)]).astype(np.int32)
        columns = [
            pa.array([r for samples in found for r in range(1, len(samples) + 1)], pa.int32()),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
            pa.array([p for _, p, _ in flat], pa.float64()),
            pa.array([s for _, _, s in flat], pa.float64()),
            pa.array(back, pa.bool_()),
        ]
        return pa.record_batch([*batch.take(pa.array(owner)).columns[2:], *columns], names=[*names, *(f.name for f in SAMPLE)])

    return rows.mapInArrow(drawn, T.StructType(kinds + SAMPLE)).toDF(*keep, *[f.name for f in SAMPLE])


def decoded(encoded: DataFrame, path: str, *keep: str) -> DataFrame:
    """The kept columns with the text of each row's ids; null ids give a null text."""
    names = [f"own_{i}" for i in range(len(keep))]
    kinds = [T.StructField(n, encoded.schema[c].dataType) for c, n in zip(keep, names)]

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, at = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(0)), 0).to_numpy(), dtype=np.int64), 0
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, "right")))
                own = batch.slice(at, end - at)
                cuts = ends[at:end] - (ends[at - 1] if at else 0)
                found = decode(np.split(own.column(0).flatten().to_numpy(), cuts[:-1]), pieces(path))
                gone = own.column(0).is_null().to_numpy(zero_copy_only=False)
                yield pa.record_batch([*own.columns[1:], pa.array(found, pa.string(), mask=gone)], names=[*names, "text"])
                at = end

    rows = encoded.select("ids", *map(F.col, keep)).toDF("ids_", *names)
    return rows.mapInArrow(texts, T.StructType([*kinds, T.StructField("text", T.StringType())])).toDF(*keep, "text")

"""SentencePiece encoding by sampled segmentations, and decoding.

A text's segmentations are the paths of a lattice: an arc for each vocabulary piece at each position, and
byte pieces for characters that no piece has.  A path's probability is proportional to the product of its
pieces' weights, 1 / (rank + SHIFT) to the power of ALPHA.  `sample` emits k distinct segmentations of each
text without replacement, the k largest of all paths' Gumbel-perturbed log-probabilities, found by A* search
from the top down: the largest perturbed value below a node is a Gumbel variable of the node's mass, cut
off at its parent's, so a node's bound is exact and the best node's bound is the next sample's value.  A
popped node is completed by drawing each arc in turn; what it leaves is split where later paths can branch
off, and nodes are made only when they are reached.

log_inclusion is the logarithm of the probability that the segmentation is among the k, given the (k + 1)-th
largest value; sums weighted by log_prob - log_inclusion are unbiased.  All chances are hashes of the row's
key (doc_id, or the text where there is none), the sample and the position, so reruns agree.

No piece crosses from a word into the space before the next one, so the lattice falls into units.  The
lattices of the distinct units of a quarter of a million characters are built at once as arrays, and all units of all
texts are drawn from them at once; only the first few dozen arcs, where a second path can branch off with
any probability that a double can hold, are handled text by text.

The vocabulary (pieces and ranks) is read on the driver from the model file, whose path is a parameter, and
travels in the tasks' closure.

Defined results: a null or empty text has one segmentation, without pieces, of log_prob 0.  Texts with
fewer than k segmentations give all of them with log_inclusion 0.  A literal U+2581 is decoded as a space, as
SentencePiece does; round_trip is false for such texts, and true where the decoded bytes are those of the text.  Repeated rows give equal samples; further columns don't matter.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import math
from collections.abc import Generator, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordspark.llm.common import slices, table
from recordspark.llm.words import buffers, mix

K, ALPHA, SHIFT = 2, 1.0, 10.0
#: A branch is looked for while the path's probability is above this logarithm.
NEGLIGIBLE = -40.0
PIECE_CHARS = 1 << 18
SPACE, NEWLINE = 0x2581, 10
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS, _BUCKET_BITS = 20, 16
ENDS, GOES_ON = 1, 2


@dataclass
class Vocabulary:
    """Pieces as text, and the logarithms of their weights; the ids of the 256 byte pieces."""

    pieces: list[str]
    weights: np.ndarray
    byte_ids: np.ndarray
    tables: dict = field(default_factory=dict, repr=False)

    @staticmethod
    def load(path: str | None = None, alpha: float = ALPHA) -> Vocabulary:
        import sentencepiece

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("piece_bpe_32k.model")
        sp = sentencepiece.SentencePieceProcessor(model_file=str(path))
        n = sp.get_piece_size()
        special = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
        pieces = ["" if s else sp.id_to_piece(i) for i, s in enumerate(special)]
        scores = np.array([-math.inf if s else sp.get_score(i) for i, s in enumerate(special)])
        rank = np.empty(n)
        rank[np.argsort(-scores, kind="stable")] = np.arange(n)
        byte_ids = np.full(256, -1, dtype=np.int32)
        for i in range(n):
            if sp.is_byte(i):
                byte_ids[int(sp.id_to_piece(i)[1:-1], 16)] = i
        return Vocabulary(pieces, -alpha * np.log(rank + SHIFT), byte_ids)

    def prepare(self) -> None:
        """Tables by length (in characters): sorted hashes, ids and where hashes of each beginning are; what hashes' last bits can be."""
        if self.tables:
            return
        #: By length and the hashes' last bits: ENDS where a piece may end, GOES_ON where a longer one may start so.
        self.flags = np.zeros((max(map(len, self.pieces), default=0) + 1, 1 << _FILTER_BITS), dtype=np.uint8)
        own = np.array([i for i, p in enumerate(self.pieces) if p], dtype=np.int64)
        size = np.array([len(self.pieces[i]) for i in own], dtype=np.int64)
        code = np.array([ord(c) for i in own for c in self.pieces[i]], dtype=np.uint64)
        begin, h = np.cumsum(size) - size, np.zeros(len(own), dtype=np.uint64)
        for k in range(1, len(self.flags)):
            on = size >= k
            own, size, begin, h = own[on], size[on], begin[on], h[on]
            h = _roll(h, code[begin + k - 1])
            self.flags[k, h[size > k] >> np.uint64(64 - _FILTER_BITS)] |= GOES_ON
            if (size == k).any():
                hashes, ids = h[size == k], own[size == k]
                self.flags[k, hashes >> np.uint64(64 - _FILTER_BITS)] |= ENDS
                order = np.lexsort((ids, hashes))
                hashes, ids = hashes[order], ids[order].astype(np.int32)
                edges = np.searchsorted(hashes, np.arange(1 << _BUCKET_BITS, dtype=np.uint64) << np.uint64(64 - _BUCKET_BITS))
                most = int(np.diff(np.append(edges, len(hashes))).max())
                # the last is repeated, so a look at `most` hashes never leads past the end
                self.tables[k] = (np.pad(hashes, (0, most), "edge"), np.pad(ids, (0, most), "edge"), edges, most)
        data = [bytes([b]) for b in range(256)]
        out = [p.encode() for p in self.pieces]
        for b, i in enumerate(self.byte_ids):
            if i >= 0:
                out[i] = data[b]
        self.byte_length = np.array([len(x) for x in out])
        self.byte_start = np.concatenate(([0], np.cumsum(self.byte_length)))[:-1]
        self.bytes = np.frombuffer(b"".join(out), dtype=np.uint8)
        self.byte_weight = float(self.weights[np.isfinite(self.weights)].min())

    def decode_bytes(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of all pieces, one after the other, and where each piece's start."""
        starts = np.append(self.byte_start, len(self.bytes))
        pieces = pa.Array.from_buffers(pa.large_binary(), len(self.byte_start), [None, pa.py_buffer(starts), pa.py_buffer(self.bytes)])
        data, offsets = buffers(pieces.take(pa.array(ids)))
        return data.tobytes(), offsets

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of pieces."""
        self.prepare()
        text = self.decode_bytes(np.asarray(ids, dtype=np.int64))[0].decode("utf-8", "replace").replace(chr(SPACE), " ")
        return text[1:] if text.startswith(" ") else text


def _roll(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    """A hash of strings and one more character each, from the strings' own."""
    h = (h ^ (c + np.uint64(1))) * _MULTIPLIER
    h ^= h >> np.uint64(32)
    return h


def _seeded(*parts, seed: np.ndarray | None = None) -> np.ndarray:
    """A hash of the parts (64-bit values, broadcast), behind those that `seed` is of."""
    h = np.full(1, 0x243F6A8885A308D3, dtype=np.uint64) if seed is None else seed
    for p in parts:
        h = mix((np.asarray(p).astype(np.uint64) + np.uint64(0x9E3779B9)) ^ (h * _MULTIPLIER))
    return h


def uniform(*parts, seed: np.ndarray | None = None) -> np.ndarray:
    """Numbers in (0, 1) that depend only on the parts and those that `seed` is of."""
    return ((_seeded(*parts, seed=seed) >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


@dataclass
class Lattice:
    """Arcs of the lattices of distinct units, in runs by their start: arcs first[p] to first[p + 1] - 1 leave position p."""

    first: np.ndarray
    end: np.ndarray  # the position behind the arc; -1 where a unit ends
    piece: np.ndarray  # its id; -1 - character for byte pieces
    log_p: np.ndarray  # the logarithm of its probability among those that leave the position
    upto: np.ndarray  # sums of the probabilities
    start: np.ndarray  # the first position of each unit
    position: np.ndarray  # the position that each arc leaves


def lookup(h: np.ndarray, hashes: np.ndarray, ids: np.ndarray, edges: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of h are among the sorted hashes, and their ids; edges: where hashes of each beginning start, `most` of them at most."""
    where = edges[h >> np.uint64(64 - _BUCKET_BITS)]
    wrong = np.flatnonzero(hashes[where] != h)
    for _ in range(most - 1):
        if not len(wrong):
            break
        where[wrong] += 1
        wrong = wrong[hashes[where[wrong]] != h[wrong]]
    which = np.delete(np.arange(len(h)), wrong) if len(wrong) else np.arange(len(h))
    return which, ids[where[which]]


def build(code: np.ndarray, start: np.ndarray, length: np.ndarray, v: Vocabulary) -> Lattice:
    """The lattice of units given as runs of `code`.

    Positions are in levels by the characters left to the unit's end, first the ends themselves; within a level by
    unit, the longest first, so a unit has the same place in all its levels.
    """
    units, order = len(length), np.argsort(-length, kind="stable")
    start, length = start[order], length[order]
    tall = np.cumsum(np.bincount(length, minlength=1)[::-1])[::-1]  # units of so many characters at least
    base = np.concatenate(([0], np.cumsum(tall)))
    n = int(base[-1])
    level = np.repeat(np.arange(len(tall)), tall)
    unit = np.arange(n) - np.repeat(base[:-1], tall)
    rows = np.arange(units, n)
    at = (start + length)[unit[units:]] - level[units:]
    h = np.zeros(len(rows), dtype=np.uint64)
    single = -1 - code[at].astype(np.int64)  # each position has an arc of one character
    found: list[tuple[int, np.ndarray, np.ndarray]] = [(1, rows, single)]
    for k in range(1, min(max(v.tables, default=0) + 1, len(tall))):
        h = _roll(h, code[at + (k - 1)].astype(np.uint64))
        flags = v.flags[k][h >> np.uint64(64 - _FILTER_BITS)]
        if k in v.tables:
            maybe = np.flatnonzero(flags & ENDS)
            which, ids = lookup(h[maybe], *v.tables[k])
            if k == 1:
                single[maybe[which]] = ids
            else:
                found.append((k, rows[maybe[which]], ids))
        inside = int(np.searchsorted(rows, base[k + 1]))  # from there on, more than k characters are left
        more = inside + np.flatnonzero(flags[inside:] & GOES_ON)
        if not len(more):
            break
        rows, at, h = rows[more], at[more], h[more]
    # arcs in order of start and size: each goes behind those that its start has already
    counts = np.zeros(n, dtype=np.int64)
    for _, from_, _ in found:
        counts[from_] += 1
    first = np.concatenate(([0], np.cumsum(counts)))
    target, piece, free = np.empty(first[-1], dtype=np.int64), np.empty(first[-1], dtype=np.int64), first[:-1].copy()
    for k, from_, ids in found:
        slot = free[from_]
        target[slot], piece[slot], free[from_] = base[level[from_] - k] + unit[from_], ids, slot + 1
    log_p = v.weights[np.maximum(piece, 0)]
    bare = np.flatnonzero(piece < 0)
    character = -1 - piece[bare]
    log_p[bare] = v.byte_weight * (1 + (character > 0x7F) + (character > 0x7FF) + (character > 0xFFFF))
    # level by level: the mass behind each position
    behind = np.zeros(n)
    for a, z in itertools.pairwise(base[1:].tolist()):
        lo, hi = first[a], first[z]
        log_p[lo:hi] += behind[target[lo:hi]]
        behind[a:z] = np.logaddexp.reduceat(log_p[lo:hi], first[a:z] - lo)
    log_p -= np.repeat(behind, counts)
    total = np.concatenate(([0.0], np.cumsum(np.exp(log_p))))
    upto = total[1:] - np.repeat(total[first[:-1]], counts)
    upto[first[units + 1 :] - 1] = 2.0  # rounding never leads past the last arc
    own = np.empty(units, dtype=np.int64)
    own[order] = base[length] + np.arange(units)
    return Lattice(first, np.where(target < units, -1, target), piece, log_p, upto, own, np.repeat(np.arange(n), counts))


def draw(x: Lattice, position: np.ndarray, chance) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Complete units from given positions: (which, arc) step by step.  chance(which, step): uniform numbers."""
    which = np.flatnonzero(position >= 0)
    position = position[which]
    step = 0
    while len(which):
        u = chance(which, step)
        arc = x.first[position]
        more = np.flatnonzero(u > x.upto[arc])
        u, next_ = u[more], arc[more] + 1
        while len(more):
            arc[more] = next_
            on = np.flatnonzero(u > x.upto[next_])
            more, u, next_ = more[on], u[on], next_[on] + 1
        yield which, arc
        position = x.end[arc]
        on = np.flatnonzero(position >= 0)
        which, position = which[on], position[on]
        step += 1


@dataclass
class Texts:
    """Texts as units: the distinct ones' lattice, and for each text its units, first[t] to first[t + 1] - 1."""

    lattice: Lattice
    unit: np.ndarray
    first: np.ndarray
    marked: list[bytes]  # the texts as UTF-8 with a space mark before each


def read(texts: list[str], v: Vocabulary) -> Texts:
    marked = [chr(SPACE) + t.replace(" ", chr(SPACE)) if t else "" for t in texts]
    joined = "".join(marked)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum([len(m) for m in marked])
    begins = np.zeros(len(code), dtype=bool)
    space, line = code == SPACE, code == NEWLINE
    begins[1:] = (space[1:] & ~space[:-1]) | line[1:] | line[:-1]
    edges = np.concatenate(([0], ends[:-1]))
    begins[edges[edges < len(code)]] = True
    start = np.flatnonzero(begins)
    length = np.diff(np.append(start, len(code)))
    # a hash of each unit from prefix sums
    power = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(len(code), _MULTIPLIER))), dtype=np.uint64)
    inverse = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))
    back = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(len(code), inverse))), dtype=np.uint64)
    total = np.concatenate(([np.uint64(0)], np.add.accumulate(mix(code.astype(np.uint64) + np.uint64(7)) * power[: len(code)], dtype=np.uint64)))
    h = mix((total[start + length] - total[start]) * back[start] + length.astype(np.uint64)) if len(start) else np.zeros(0, dtype=np.uint64)
    _, own, unit = np.unique(h, return_index=True, return_inverse=True)
    lattice = build(code, start[own], length[own], v)
    return Texts(lattice, unit.astype(np.int64), np.searchsorted(start, np.concatenate((edges, [len(code)]))), [m.encode("utf-8", "surrogatepass") for m in marked])


class Paths:
    """One drawn path for each text: arcs in order; unit u of the texts has arcs first[u] to first[u + 1] - 1."""

    def __init__(self, texts: Texts, keys: np.ndarray, sample: int):
        x, n = texts.lattice, len(texts.unit)
        owner = np.repeat(np.arange(len(texts.first) - 1), np.diff(texts.first))
        place = np.arange(n) - texts.first[owner] if n else np.zeros(0, dtype=np.int64)
        seed = _seeded(place, seed=_seeded(keys, sample)[owner])
        steps = list(draw(x, x.start[texts.unit] if n else np.zeros(0, dtype=np.int64), lambda which, step: uniform(step, seed=seed[which])))
        length = np.zeros(n, dtype=np.int64)
        for which, _ in steps:
            length[which] += 1
        self.first = np.concatenate(([0], np.cumsum(length)))
        self.arcs = np.empty(self.first[-1], dtype=np.int64)
        for step, (which, arc) in enumerate(steps):
            self.arcs[self.first[which] + step] = arc


def _chances(key: int) -> Iterator[float]:
    """As many uniform numbers as a text needs."""
    for block in itertools.count():
        yield from uniform(np.uint64(key), 0x5EA7C4, block, np.arange(64)).tolist()


def _gumbel(u: float) -> float:
    return -math.log(-math.log(u))


def _below(log_mass: float, top: float, u: float) -> float:
    """A Gumbel variable of a mass, cut off at `top`."""
    return -float(np.logaddexp(-top, -(log_mass + _gumbel(u))))


@dataclass
class Head:
    """The start of a path, as far as branches off it matter: its arcs, and all arcs by which others branch off.

    branch[i] leaves the path at step[i] and leads to paths of log probability mass[i].
    """

    arcs: np.ndarray
    step: np.ndarray
    branch: np.ndarray
    mass: np.ndarray


def heads(texts: Texts, wanted: list[tuple[int, np.ndarray, int]], p: Paths) -> list[Head]:
    """For each (text, arcs, units): the head of the path that has these arcs in its first units and goes on as in p."""
    x, starts = texts.lattice, [arcs for _, arcs, _ in wanted]
    t, units = np.array([t for t, _, _ in wanted], dtype=np.int64), np.array([u for _, _, u in wanted], dtype=np.int64)
    at, stop, size = p.first[texts.first[t] + units], p.first[texts.first[t + 1]], np.full(len(wanted), 64)
    # until a path is too improbable for branches
    log_p = np.array([x.log_p[arcs].sum() for arcs in starts])
    on = np.flatnonzero(at + size < stop)
    while len(on):
        begin = np.cumsum(size[on]) - size[on]
        arcs = p.arcs[np.repeat(at[on] - begin, size[on]) + np.arange(begin[-1] + size[on[-1]])]
        on = on[log_p[on] + np.add.reduceat(x.log_p[arcs], begin) > NEGLIGIBLE]
        size[on] *= 2
        on = on[at[on] + size[on] < stop[on]]
    paths = [np.concatenate([arcs, p.arcs[a:z]]) for arcs, a, z in zip(starts, at.tolist(), np.minimum(stop, at + size).tolist(), strict=True)]
    arcs = np.concatenate(paths)
    first = np.concatenate(([0], np.cumsum([len(path) for path in paths])))
    before, own = np.zeros(len(arcs)), x.log_p[arcs]
    for a, z in itertools.pairwise(first.tolist()):
        np.cumsum(own[a : z - 1], out=before[a + 1 : z])
    position = x.position[arcs]
    n = x.first[position + 1] - x.first[position]
    step = np.repeat(np.arange(len(arcs)), n)
    branch = np.arange(len(step)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(x.first[position], n)
    other = np.flatnonzero(branch != arcs[step])
    step, branch = step[other], branch[other]
    mass = before[step] + x.log_p[branch]
    cuts = itertools.pairwise(np.searchsorted(step, first).tolist())
    return [Head(path, step[i:j] - a, branch[i:j], mass[i:j]) for path, a, (i, j) in zip(paths, first.tolist(), cuts, strict=False)]


def _total(masses: np.ndarray) -> float:
    if not len(masses):
        return -math.inf
    top = float(masses.max())
    return top + math.log(float(np.exp(masses - top).sum())) if top > -math.inf else top


@dataclass
class Sample:
    """A segmentation: the units up to `units` have the arcs `head`; the rest are those of drawn path `rest`."""

    head: np.ndarray
    units: int
    rest: int
    value: float


def search(x: Lattice, key: int, k: int) -> Generator[tuple[np.ndarray, int], Head, tuple[list[Sample], float]]:
    """Up to k samples of a text, and the next largest perturbed value.

    Asks for heads by (arcs, units); that of the j-th time goes on as in the j-th drawn path.
    """
    chances = _chances(key)
    none = np.zeros(0, dtype=np.int64)
    out = [Sample(none, 0, 0, _gumbel(next(chances)))]
    heap: list[tuple[float, int, Head, np.ndarray]] = []

    def push(head: Head, alive: np.ndarray, top: float) -> None:
        """A node: all paths that leave the head by one of its branches `alive`."""
        mass = _total(head.mass[alive])
        if mass > -math.inf:
            heapq.heappush(heap, (-_below(mass, top, next(chances)), len(heap) + 1000 * len(out), head, alive))

    first = yield none, 0
    push(first, np.arange(len(first.branch)), out[0].value)
    while heap and len(out) < k:
        value, _, head, alive = heapq.heappop(heap)
        value = -value
        # which branch: by its share of the mass
        share_ = np.cumsum(np.exp(head.mass[alive] - head.mass[alive].max()))
        chosen = int(alive[min(int(np.searchsorted(share_, next(chances) * share_[-1])), len(alive) - 1)])
        step, arc = int(head.step[chosen]), int(head.branch[chosen])
        start = [*head.arcs[:step].tolist(), arc]
        units = int((x.end[start] < 0).sum())
        position = int(x.end[arc])
        if position >= 0:  # complete the unit that the arc is in
            while position >= 0:
                u, arc = next(chances), int(x.first[position])
                while u > x.upto[arc]:
                    arc += 1
                start.append(arc)
                position = int(x.end[arc])
            units += 1
        own = np.array(start, dtype=np.int64)
        out.append(Sample(own, units, len(out), value))
        # what the node leaves: paths that share the branch and leave the new path later, and the other branches
        new = yield own, units
        push(new, np.flatnonzero(new.step > step), value)
        push(head, alive[alive != chosen], value)
    return out, -heap[0][0] if heap else -math.inf


def searches(texts: Texts, keys: np.ndarray, drawn: list[Paths], k: int) -> list[tuple[list[Sample], float]]:
    """The searches of all texts that have units, a round of heads at a time."""
    running = {t: search(texts.lattice, int(keys[t]), k) for t in np.flatnonzero(np.diff(texts.first)).tolist()}
    wanted = [(t, *next(one)) for t, one in running.items()]
    out: list = [None] * len(keys)
    for p in drawn:
        if not wanted:
            break
        given, wanted = zip(wanted, heads(texts, wanted, p), strict=True), []
        for (t, *_), head in given:
            try:
                wanted.append((t, *running[t].send(head)))
            except StopIteration as end:
                out[t] = end.value
    return out


def arcs_of(texts: Texts, t: int, sample: Sample, drawn: list[Paths]) -> np.ndarray:
    p = drawn[sample.rest]
    u0, u1 = int(texts.first[t]) + sample.units, int(texts.first[t + 1])
    return np.concatenate([sample.head, p.arcs[p.first[u0] : p.first[u1]]])


def ids_of(pieces: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of arcs' pieces, and how many each arc has: characters without a piece become byte pieces."""
    n = np.ones(len(pieces), dtype=np.int64)
    bare = np.flatnonzero(pieces < 0)
    if not len(bare):
        return pieces.astype(np.int32), n
    encoded = [chr(-1 - p).encode("utf-8", "surrogatepass") for p in pieces[bare].tolist()]
    n[bare] = [len(e) for e in encoded]
    out = np.repeat(pieces, n)
    out[np.repeat(pieces < 0, n)] = v.byte_ids[np.frombuffer(b"".join(encoded), dtype=np.uint8)]
    return out.astype(np.int32), n


@dataclass
class Segmented:
    """Samples of some texts: sample i is of text[i] and has the ids first[i] to first[i + 1] - 1."""

    text: np.ndarray
    number: np.ndarray
    ids: np.ndarray
    first: np.ndarray
    log_prob: np.ndarray
    log_inclusion: np.ndarray
    round_trip: np.ndarray  # whether decoding gives the text back


def segment(texts: list[str], keys: np.ndarray, v: Vocabulary, k: int) -> Segmented:
    x = read(texts, v)
    drawn = [Paths(x, keys, j) for j in range(k)]
    text, number, arcs, after = [], [], [], []
    for t, one in enumerate(searches(x, keys, drawn, k)):
        found, rest = one or ([None], math.inf)
        for j, one in enumerate(found):
            text.append(t)
            number.append(j + 1)
            arcs.append(arcs_of(x, t, one, drawn) if one else np.zeros(0, dtype=np.int64))
            after.append(rest if one else -math.inf)
    arc = np.concatenate(arcs) if arcs else np.zeros(0, dtype=np.int64)
    text = np.array(text, dtype=np.int64)
    sample_first = np.concatenate(([0], np.cumsum([len(a) for a in arcs]))).astype(np.int64)
    ids, n = ids_of(x.lattice.piece[arc], v)
    first = np.concatenate(([0], np.cumsum(n)))[sample_first]
    total = np.concatenate(([0.0], np.cumsum(x.lattice.log_p[arc])))
    log_p = np.array([x.lattice.log_p[a].sum() for a in arcs]) if len(arcs) < 64 else total[sample_first[1:]] - total[sample_first[:-1]]
    log_p = np.minimum(log_p, 0.0)
    gap = log_p - np.array(after)
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        inclusion = np.where(gap > 30, 0.0, np.where(gap < -30, gap, np.log(-np.expm1(-np.exp(np.clip(gap, -40, 40))))))
    # decoded by the ids alone, and compared with the texts
    data, offsets = v.decode_bytes(ids)
    size = offsets[first].tolist()
    own = [chr(SPACE) in t for t in texts]  # these become spaces, in the marked text too
    same = [not own[t] and data[i:j] == x.marked[t] for t, (i, j) in zip(text.tolist(), itertools.pairwise(size), strict=True)]
    return Segmented(text, np.array(number), ids, first, log_p, inclusion, np.array(same, dtype=bool))


SCHEMA = "doc_id long, sample int, ids array<int>, log_prob double, log_inclusion double, round_trip boolean"
DIGEST = "doc_id long, sample int, n_pieces long, log_prob double, log_inclusion double, round_trip boolean, ids_sha256 string"


def sample(docs: DataFrame, v: Vocabulary, k: int = K, digest: bool = False, ids: bool = False) -> DataFrame:
    """k segmentations of every row of `docs` (doc_id, text); digest: with the count and the digest of the ids instead of them, or with `ids` besides them."""
    form = f"{DIGEST}, ids array<int>" if digest and ids else DIGEST if digest else SCHEMA
    keyed = docs.select("doc_id", F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id")).alias("key"), "text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v.prepare()
        for b in slices(batches):
            texts = [t or "" for t in b.column(2).to_pylist()]
            ids_, keys = b.column(0).to_pylist(), b.column(1).to_numpy().view(np.uint64)
            a = 0
            while a < len(texts):
                z, size = a, 0
                while z < len(texts) and (z == a or size + len(texts[z]) <= PIECE_CHARS):
                    size += len(texts[z])
                    z += 1
                x = segment(texts[a:z], keys[a:z], v, k)
                columns = [pa.array(ids_, pa.int64()).take(pa.array(a + x.text)), pa.array(x.number, pa.int32())]
                scores = [pa.array(x.log_prob), pa.array(x.log_inclusion), pa.array(x.round_trip)]
                if digest:
                    data = x.ids.astype("<i4")
                    columns += [pa.array(np.diff(x.first)), *scores, pa.array([hashlib.sha256(data[i:j]).hexdigest() for i, j in itertools.pairwise(x.first.tolist())], pa.string())]
                pieces = pa.ListArray.from_arrays(pa.array(x.first.astype(np.int32)), pa.array(x.ids)) if ids or not digest else None
                columns += ([] if pieces is None else [pieces]) if digest else [pieces, *scores]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in form.split(", ")])
                a = z

    return keyed.mapInArrow(rows, form)


def decode(encoded: DataFrame, v: Vocabulary) -> DataFrame:
    """doc_id, sample and the text of the rows' ids."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v.prepare()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([v.decode(np.array(x, dtype=np.int64)) if x else "" for x in b.column(2).to_pylist()], pa.string())], ["doc_id", "sample", "text"])

    return encoded.select("doc_id", "sample", "ids").mapInArrow(rows, "doc_id long, sample int, text string")


def op8_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every segmentation itself, with its count of pieces and digest."""
    return sample(table(spark, sf_dir, "documents"), Vocabulary.load(), digest=True, ids=True)

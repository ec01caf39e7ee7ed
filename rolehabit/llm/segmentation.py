"""SentencePiece encoding by sampling, and decoding.

Method: Gumbel top-k without replacement.  A text's segmentations are the paths through
its lattice of pieces.  Each has a log probability, and a Gumbel variable with that
location; the k largest of these are k distinct segmentations drawn without replacement.
They are found by a perturbed A* search: an entry of its queue stands for all paths that
share a beginning and then leave it, its bound is the largest perturbed value among
them (drawn from their total probability, below the bound of the entry it was split
from), and the best entry is completed and split at each later place.  Every bound is
attained, so the first path completed is the next in order.

No piece crosses from a word's end into white space, so a lattice is a chain of words.
The lattices of a group's words that are new to the task are made together, completion samples all
words of the group at once, and an entry that leaves a path at a word stands for all other segmentations of
that word.

The model file holds a merge order instead of probabilities; a piece of rank r gets the
probability of Zipf's law, 1 / (r + 2.7), scaled to sum to 1.  Characters that are no
piece become their bytes, with ten nats less than the least likely piece.

All random numbers are hashes of the row's key, so a row's samples depend on nothing else.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from itertools import chain, compress

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolehabit.llm.common import map_batches, query, table

SAMPLES = 2
MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Characters of texts worked on together.
GROUP_CHARS = 100_000
#: Nodes of lattices kept for later groups, some 150 bytes each, by each of an executor's workers.
KEPT_NODES = 1 << 20
_WORD = re.compile("▁+[^▁\n]*|\n|[^▁\n]+")
_SPACED = re.compile(_WORD.pattern.replace(SPACE, " "))


class Pieces:
    """The vocabulary: pieces with log probabilities, and the bytes each stands for."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes: list[bytes] = [b""] * size
        self.byte_ids = [0] * 256
        ranks = {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes[i] = bytes([int(piece[3:5], 16)])
            elif not model.is_control(i) and not model.is_unknown(i):
                self.bytes[i] = piece.replace(SPACE, " ").encode()
                # pieces without a merge of their own rank last
                ranks[piece] = (i, min(-model.get_score(i), size))
        scale = sum(1 / (r + 2.7) for _, r in ranks.values())
        #: beginnings of pieces; (id, probability) for whole ones, else None
        self.known: dict[str, tuple[int, float] | None] = {}
        for piece in ranks:
            for k in range(1, len(piece)):
                self.known.setdefault(piece[:k])
        self.known |= {piece: (i, 1 / (r + 2.7) / scale) for piece, (i, r) in ranks.items()}
        self.unknown = min(v[1] for v in self.known.values() if v) * math.exp(-10)
        # the same by hash: a table, and a larger one for what collides there
        hashed = sorted((_hash(k), *(v or (-1, 1.0))) for k, v in self.known.items())
        self.hashes = np.array([h for h, _, _ in hashed], np.uint64)
        self.ids = np.array([i for _, i, _ in hashed], np.int64)
        self.logs = np.log([p for _, _, p in hashed])
        self.table = np.zeros(1 << 20, np.int32)
        upper = self._upper(self.hashes)
        self.table[upper] = np.arange(len(hashed))
        rest = np.flatnonzero(self.table[upper] != np.arange(len(hashed)))
        self.second = np.zeros(1 << 22, np.int32)
        for self.factor in np.random.default_rng(1).integers(1, 1 << 62, 10_000).astype(np.uint64) * np.uint64(2) + np.uint64(1):
            lower = self._lower(self.hashes[rest])
            if len(np.unique(lower)) == len(rest):
                break
        else:
            raise ValueError("no table without collisions for this vocabulary")
        self.second[lower] = rest
        self.contents = pa.array(self.bytes, pa.binary())

    @staticmethod
    def _upper(hashes: np.ndarray) -> np.ndarray:
        return (hashes * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(44)

    def _lower(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes * self.factor) >> np.uint64(42)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each hash is among ``hashes``, and whether it is."""
        place = self.table[self._upper(hashes)]
        known = self.hashes[place] == hashes
        other = np.flatnonzero(~known)
        place[other] = self.second[self._lower(hashes[other])]
        known[other] = self.hashes[place[other]] == hashes[other]
        return place, known


_BASE = 0x9E3779B97F4A7C15


def _hash(beginning: str) -> int:
    value = 0
    for c in beginning:
        value = (value * _BASE + ord(c) + 1) & (1 << 64) - 1
    return value


@cache
def pieces(model: str = MODEL) -> Pieces:
    return Pieces(public_tokenizers.path(model))


def words_of(text: str) -> list[str]:
    """The chain a text's lattice factors into; joined they are the text as the model sees it."""
    return _WORD.findall(SPACE + text.replace(" ", SPACE)) if text else []


def _spaced(text: str) -> list[str]:
    """The same with plain spaces, which most texts can hold in a byte a character."""
    return _SPACED.findall(" " + text.replace(SPACE, " ")) if text else []


def decode(ids, vocabulary: Pieces | None = None) -> str:
    """The text of a segmentation."""
    held = (vocabulary or pieces()).bytes
    return b"".join([held[i] for i in ids]).decode("utf-8", "replace")[1:]


def decode_all(column: pa.Array) -> pa.Array:
    """The texts of a column of segmentations; nulls stay."""
    held = pieces()
    lists = pa.ListArray.from_arrays(_offsets(column), held.contents.take(column.flatten()))
    joined = pc.binary_join(lists, b"")
    try:
        texts = pc.utf8_slice_codeunits(joined.cast(pa.string()), 1)
    except pa.ArrowInvalid:  # ids that are no text in UTF-8
        texts = pa.array([b.decode("utf-8", "replace")[1:] for b in joined.to_pylist()], pa.string())
    return pc.if_else(column.is_valid(), texts, None) if column.null_count else texts


def _offsets(column: pa.Array) -> pa.Array:
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))


class _Index(dict[str, int]):
    """The first node of each word; a word not seen before is noted and gets the next ones."""

    def __init__(self, held=()) -> None:
        super().__init__(held)
        self.fresh: list[str] = []
        self.nodes = 0

    def __missing__(self, word: str) -> int:
        self.fresh.append(word)
        self[word] = node = self.nodes
        self.nodes += len(word)
        return node


class Lattices:
    """The lattices of words (spaces plain), in flat arrays that grow as words come.

    A node is a place in a word: ``first`` names its first edge, ``paths`` the number of
    ways to the word's end.  An edge has a piece (or -1 - a character to write in bytes),
    the node it leads to (-1 at the end), its log share of its node's paths, and the sum
    of shares up to it.  Frequent words come in most texts, so what is made stays for later
    groups; beyond ``kept`` nodes, words that came in one group alone since the last time are
    let go before the next group, and all words if the others have more than half of that.
    """

    def __init__(self, vocabulary: Pieces, kept: int = KEPT_NODES):
        self.vocabulary, self.kept = vocabulary, kept
        self.index = _Index()
        self.nodes = self.edges = 0
        self.first, self.paths, self.again = np.empty(0, np.int64), np.empty(0), np.empty(0, bool)
        self.piece, self.to, self.log, self.upto = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0), np.empty(0)

    def _let_go(self) -> None:
        words = list(self.index)  # as their nodes stand
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        stay = self.again[np.cumsum(sizes) - sizes]
        if sizes[stay].sum() > self.kept // 2:
            stay[:] = False
        nodes = np.repeat(stay, sizes)
        counts = np.diff(np.append(self.first[: self.nodes], self.edges))
        edges = np.flatnonzero(np.repeat(nodes, counts))
        place, counts, sizes = np.cumsum(nodes) - 1, counts[nodes], sizes[stay]
        to = self.to[edges]
        self.to[: len(edges)] = np.where(to < 0, -1, place[to])
        for column in (self.piece, self.log, self.upto):
            column[: len(edges)] = column[edges]
        nodes = np.flatnonzero(nodes)
        self.first[: len(nodes)] = np.cumsum(counts) - counts
        self.paths[: len(nodes)] = self.paths[nodes]
        self.again[: len(nodes)] = False
        self.nodes, self.edges = len(nodes), len(edges)
        self.index = _Index(zip(compress(words, stay.tolist()), (np.cumsum(sizes) - sizes).tolist(), strict=True))
        self.index.nodes = self.nodes

    def starts(self, words: list[str]) -> np.ndarray:
        """The first node of each word; nodes given before may be gone."""
        if self.nodes > self.kept:
            self._let_go()
        before = self.nodes
        found = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        self.again[found[found < before]] = True
        if self.index.fresh:
            self._add(self.index.fresh)
            self.index.fresh = []
        return found

    def _add(self, words: list[str]) -> None:
        text = np.frombuffer("".join(words).replace(" ", SPACE).encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(sizes) - sizes
        end = np.repeat(starts + sizes, sizes)
        (source, length, piece, log), first = self._edges(text, end)
        target = source + length
        ends = target == end[source]
        paths, log = self._shares(source, target, ends, log, end - np.arange(len(text)))
        share = np.exp(log)
        total = np.cumsum(share)
        upto = total - (total - share)[first[source]]
        # whatever rounding does, a node's last edge takes the rest
        upto[np.append(first, len(source))[1:] - 1] = 2.0
        self.first = _put(self.first, self.nodes, first + self.edges)
        self.paths = _put(self.paths, self.nodes, paths)
        self.again = _put(self.again, self.nodes, np.zeros(len(text), bool))
        self.piece, self.log = _put(self.piece, self.edges, piece), _put(self.log, self.edges, log)
        self.to = _put(self.to, self.edges, np.where(ends, -1, target + self.nodes))
        self.upto = _put(self.upto, self.edges, upto)
        self.nodes, self.edges = self.nodes + len(text), self.edges + len(source)

    def _edges(self, text: np.ndarray, end: np.ndarray):
        """All pieces at all places, by place and length, and each place's first; a character that is none becomes bytes."""
        held = self.vocabulary
        at, value, length = np.arange(len(text)), np.zeros(len(text), np.uint64), 0
        single = np.zeros(len(text), bool)
        found = []
        while len(at):
            value = value * np.uint64(_BASE) + (text[at + length] + 1).astype(np.uint64)
            length += 1
            k, known = held.find(value)
            at, value, k = at[known], value[known], k[known]
            whole = held.ids[k] >= 0
            found.append((at[whole], np.full(whole.sum(), length), held.ids[k[whole]], held.logs[k[whole]]))
            if length == 1:
                single[at[whole]] = True
            on = at + length < end[at]
            at, value = at[on], value[on]
        other = np.flatnonzero(~single)
        codes = text[other]
        bytes_ = np.where(codes < 128, np.array(held.byte_ids)[np.minimum(codes, 127)], -1 - codes)
        found.insert(0, (other, np.ones(len(other), np.int64), bytes_, np.full(len(other), math.log(held.unknown))))
        # a place's edges stand together, shorter ones first; each length has a place once
        used = np.zeros(len(text), np.int64)
        slots = []
        for at, *_ in found:
            slots.append(used[at])
            used[at] += 1
        begin = np.cumsum(used) - used
        total = int(used.sum())
        out = [np.empty(total, np.int64), np.empty(total, np.int64), np.empty(total, np.int64), np.empty(total)]
        for columns, slot in zip(found, slots, strict=True):
            slot += begin[columns[0]]
            for column, values in zip(out, columns, strict=True):
                column[slot] = values
        return out, begin

    @staticmethod
    def _shares(source, target, ends, log, left):
        """Sums over all ways to the ends of words, all places at one distance from them at once."""
        ahead, paths = np.zeros(len(left)), np.ones(len(left))
        distance = left[source]
        order = _in_order(distance)
        bounds = np.searchsorted(distance[order], np.arange(1, distance.max(initial=0) + 2))
        share = np.empty(len(source))
        for low, high in zip(bounds, bounds[1:], strict=False):
            edges = order[low:high]
            nodes, to, last = source[edges], target[edges], ends[edges]
            heads = np.flatnonzero(np.concatenate(([True], nodes[1:] != nodes[:-1])))
            to = np.where(last, 0, to)
            value = log[edges] + np.where(last, 0.0, ahead[to])
            most = np.maximum.reduceat(value, heads)
            counts = np.diff(np.append(heads, len(nodes)))
            total = most + np.log(np.add.reduceat(np.exp(value - np.repeat(most, counts)), heads))
            ahead[nodes[heads]] = total
            paths[nodes[heads]] = np.minimum(np.add.reduceat(np.where(last, 1.0, paths[to]), heads), 1e300)
            share[edges] = value - np.repeat(total, counts)
        return paths, share


@cache
def lattices() -> Lattices:
    """Those that a worker keeps from task to task."""
    return Lattices(pieces())


def _put(held: np.ndarray, size: int, values: np.ndarray) -> np.ndarray:
    """``held`` with ``values`` behind its first ``size``; room doubles, so that growing costs little."""
    if size + len(values) > len(held):
        held = np.concatenate((held[:size], np.empty(max(size, len(values)), held.dtype)))
    held[size : size + len(values)] = values
    return held


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length, one range behind another."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())


def _in_order(values: np.ndarray) -> np.ndarray:
    """A stable order; numbers of 16 bits are sorted by radix."""
    small = not len(values) or values.max() < 1 << 16
    return np.argsort(values.astype(np.uint16) if small else values, kind="stable")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(seeds: np.ndarray, which: int) -> np.ndarray:
    """Numbers strictly between 0 and 1."""
    drawn = _mixed(seeds + np.uint64((which + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    return ((drawn >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


def _one(seed: int, which: int) -> float:
    """What ``_uniform`` draws from one seed."""
    x = seed + (which + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1
    x = (x ^ x >> 27) * 0x94D049BB133111EB & (1 << 64) - 1
    return (((x ^ x >> 31) >> 12) + 0.5) * 2.0**-52


def _completed(lattices: Lattices, nodes: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random path from each node: all edges in turn, their number and log probability by node."""
    active, at, step = np.arange(len(nodes)), nodes, 0
    steps, sizes, log = [], np.zeros(len(nodes), np.int64), np.zeros(len(nodes))
    while len(active):
        u = _uniform(seeds[active], step)
        edge = lattices.first[at]
        later = np.flatnonzero(u > lattices.upto[edge])
        while len(later):
            edge[later] += 1
            later = later[u[later] > lattices.upto[edge[later]]]
        steps.append((active, edge))
        sizes[active] += 1
        log[active] += lattices.log[edge]
        to = lattices.to[edge]
        on = to >= 0
        active, at, step = active[on], to[on], step + 1
    place = np.cumsum(sizes) - sizes
    chosen = np.empty(sizes.sum(), np.int64)
    for step, (active, edge) in enumerate(steps):
        chosen[place[active] + step] = edge
    return chosen, sizes, log


def _other_path(lattices: Lattices, node: int, taken: list[tuple[tuple[int, ...], float]], seed: int) -> tuple[tuple[int, ...], float]:
    """A random path from the node that is none of the taken ones."""
    path, log, step = (), 0.0, 0
    u = None
    while node >= 0:
        low = lattices.first[node]
        high = low + 1
        while lattices.upto[high - 1] < 1.5:
            high += 1
        weights = []
        for edge in range(low, high):
            to = lattices.to[edge]
            under = [p for t, p in taken if t[step] == edge]
            ways = 1 if to < 0 else lattices.paths[to]
            mass = math.exp(log + lattices.log[edge]) - sum(map(math.exp, under))
            weights.append(0.0 if len(under) >= ways else max(mass, 1e-300))
        u = _one(seed, 1000 + step) * sum(weights)
        edge = low
        for k, w in enumerate(weights):
            if w > 0:
                edge = low + k
                if u <= w:
                    break
            u -= w
        path += (edge,)
        log += float(lattices.log[edge])
        taken = [(t, p) for t, p in taken if t[step] == edge]
        node = int(lattices.to[edge])
        step += 1
    return path, log


@dataclass
class Path:
    """A sampled segmentation, and the bounds of what leaves it at each word."""

    value: float  # perturbed log probability
    edges: np.ndarray
    offsets: np.ndarray  # of words among the edges
    logs: np.ndarray  # by word
    bounds: np.ndarray
    best: float = -math.inf
    taken: dict[int, list] = field(default_factory=dict)  # paths of a word already split off, where there are several

    def word(self, k: int) -> tuple[int, ...]:
        return tuple(self.edges[self.offsets[k] : self.offsets[k + 1]].tolist())


def sample(texts: list[tuple[int, str]], lattices: Lattices, samples: int = SAMPLES) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each (seed, text) its samples in order: ids, log probability, perturbed value, inclusion score.

    The inclusion score is the chance of a segmentation to be among the samples given the
    first perturbed value that is not; all of them are there, and score 1, if a text has
    no more than ``samples`` segmentations.
    """
    words = [_spaced(text) for _, text in texts]
    every = list(chain.from_iterable(words))
    nodes, sizes = lattices.starts(every), np.array([len(w) for w in words], np.int64)
    begins = np.cumsum(sizes) - sizes
    places = (np.arange(len(nodes)) - np.repeat(begins, sizes)).astype(np.uint64)
    spot = _mixed(places * np.uint64(0xD6E8FEB86659FD93) + np.repeat(np.array([seed & (1 << 64) - 1 for seed, _ in texts], np.uint64), sizes))
    ways = lattices.paths[nodes]
    paths: list[list[Path]] = [[] for _ in texts]
    nothing = np.empty(0, np.int32)
    for turn in range(samples):
        # (text, path to leave, word to leave it at, bound); the first paths leave nothing
        leaving = []
        for d, begin in enumerate(begins.tolist()):
            if not len(words[d]):
                continue
            if not turn:
                leaving.append((d, None, -1, -math.log(-math.log(_one(int(spot[begin]), 1 << 20)))))
                continue
            best = max(paths[d], key=lambda p: p.best)
            if best.best > -math.inf:
                leaving.append((d, best, int(best.bounds.argmax()), best.best))
        if not leaving:
            break
        texts_left, after = np.array([d for d, *_ in leaving]), np.array([k + 1 for _, _, k, _ in leaving])
        lengths = sizes[texts_left]
        # all words of these texts, and those behind the places left
        whole, rest = _ranges(begins[texts_left], lengths), _ranges(begins[texts_left] + after, lengths - after)
        edges, counts, ends_logs = _completed(lattices, nodes[rest], _mixed(spot[rest] + np.uint64(turn << 40)))
        ends = np.concatenate(([0], np.cumsum(counts)))
        # what of each word's probability its path leaves, and the draws behind new bounds
        with np.errstate(divide="ignore"):
            others = np.log(-np.expm1(np.minimum(ends_logs, 0.0)))
        others[ways[rest] <= 1] = -math.inf
        draws = np.log(-np.log(_uniform(spot[whole], (1 << 21) + turn)))
        logs, behind, left = np.empty(len(whole)), np.empty(len(whole)), np.full(len(whole), -math.inf)
        made, at, start = [], 0, 0
        for (d, old, k, top), length in zip(leaving, lengths.tolist(), strict=True):
            stop, size = start + length, length - k - 1
            logs[stop - size : stop] = ends_logs[at : at + size]
            left[stop - size : stop] = others[at : at + size]
            fresh, offsets = edges[ends[at] : ends[at + size]], ends[at : at + size + 1] - ends[at]
            taken = {}
            if old is not None:
                node, seed = int(nodes[begins[d] + k]), int(spot[begins[d] + k]) + (turn << 40)
                gone = old.taken.get(k) or [(old.word(k), float(old.logs[k]))]
                one, log = _other_path(lattices, node, gone, seed)
                fresh = np.concatenate((old.edges[: old.offsets[k]], one, fresh))
                offsets = np.concatenate((old.offsets[: k + 1], offsets + (old.offsets[k] + len(one))))
                logs[start : start + k], logs[start + k] = old.logs[:k], log
                taken = {k: [*gone, (one, log)]}
                if ways[begins[d] + k] > len(taken[k]):
                    left[start + k] = math.log(max(1 - sum(math.exp(p) for _, p in taken[k]), 1e-300))
                old.bounds[k] = -math.inf
                old.best = float(old.bounds.max())
            np.cumsum(logs[start:stop], out=behind[start:stop])
            made.append(Path(top, fresh, offsets, logs[start:stop], nothing, taken=taken))
            at, start = at + size, stop
        behind -= logs
        # Gumbel variables with these locations, given that they are below ``top``
        with np.errstate(over="ignore"):
            bounds = -np.logaddexp(np.repeat([-top for *_, top in leaving], lengths), draws - (behind + left))
        bounds[left == -math.inf] = -math.inf
        starts = np.cumsum(lengths) - lengths
        for d, path, start, stop, best in zip(texts_left.tolist(), made, starts.tolist(), (starts + lengths).tolist(), np.maximum.reduceat(bounds, starts).tolist(), strict=True):
            path.bounds, path.best = bounds[start:stop], best
            paths[d].append(path)
    out = []
    for d in range(len(texts)):
        if not paths[d]:
            out.append([(nothing, 0.0, 0.0, 1.0)])
            continue
        limit = max(p.best for p in paths[d])
        found = []
        for p in paths[d]:
            log = float(p.logs.sum())
            score = 1.0 if limit == -math.inf else -math.expm1(-math.exp(min(log - limit, 50.0)))
            found.append((_ids(lattices.piece[p.edges], lattices.vocabulary), log, p.value, score))
        out.append(found)
    return out


def _ids(chosen: np.ndarray, vocabulary: Pieces) -> np.ndarray:
    if not (chosen < 0).any():
        return chosen
    return np.array([x for i in chosen.tolist() for x in ([i] if i >= 0 else [vocabulary.byte_ids[b] for b in chr(-1 - i).encode()])], np.int32)


def _seed(key) -> int:
    return xxhash.xxh3_64_intdigest(repr(key))


def segmentations(docs: DataFrame, key: str = "doc_id", text: str = "text", samples: int = SAMPLES, decoding: str | None = None) -> DataFrame:
    """Up to ``samples`` rows per row of ``docs``: key, rank, ids, log_prob, perturbed, inclusion.

    With ``decoding``, a last column of that name has the text of the ids, decoded in the
    same pass (``decoded`` does it to any table of ids).

    Rank 1 has the largest perturbed value.  Fewer rows only if a text has fewer
    segmentations; null and empty texts have the empty one.  Rows with equal keys and
    texts get equal samples; null keys share a seed.  Other columns are left behind; an
    empty table gives an empty one.  One pass without a shuffle.
    """
    kind = docs.schema[key].dataType.simpleString()

    def grouped(keys: list, texts: list[str]) -> Iterator[slice]:
        start, held = 0, 0
        for k, text in enumerate(texts):
            if held and held + len(text) > GROUP_CHARS:
                yield slice(start, k)
                start, held = k, 0
            held += len(text)
        yield slice(start, len(texts))

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for part in grouped(keys, texts):
                found = sample([(_seed(k), t) for k, t in zip(keys[part], texts[part], strict=True)], lattices(), samples)
                counts = [len(f) for f in found]
                flat = [s for f in found for s in f]
                if not flat:
                    continue
                offsets = np.concatenate(([0], np.cumsum([len(s[0]) for s in flat]))).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([s[0] for s in flat]), pa.int32()))
                rank = [r for c in counts for r in range(1, c + 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, c in zip(keys[part], counts, strict=True) for _ in range(c)], batch.column(0).type), pa.array(rank, pa.int32()), ids,
                     *(pa.array([s[i] for s in flat], pa.float64()) for i in (1, 2, 3)), *([decode_all(ids)] if decoding else [])],
                    names,
                )

    names = [key, "rank", "ids", "log_prob", "perturbed", "inclusion", *([decoding] if decoding else [])]
    schema = f"`{key}` {kind}, rank int, ids array<int>, log_prob double, perturbed double, inclusion double" + (f", `{decoding}` string" if decoding else "")
    return map_batches(docs.select(key, text), batches, schema)


def decoded(samples: DataFrame, ids: str = "ids", name: str = "text") -> DataFrame:
    """``samples`` with a column for the text of its ids; null ids give null."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            yield pa.RecordBatch.from_arrays([*batch.columns, decode_all(batch.column(at))], names)

    at, names = samples.columns.index(ids), [*samples.columns, name]
    return map_batches(samples, batches, samples.select("*", F.lit("").alias(name)).schema)


@query()
def op1_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = segmentations(table(spark, sf_dir, "documents"), decoding="text")
    return found.select(
        "doc_id", "rank", F.size("ids").alias("n_pieces"), F.xxhash64("ids").alias("ids_digest"), F.xxhash64("text").alias("text_digest"),
        "log_prob", "perturbed", "inclusion",
    )

"""SentencePiece encoding by sampling distinct segmentations, and decoding.

A text's segmentations are the paths of a lattice whose edges are the vocabulary's
pieces. A segmentation's probability is in proportion to the product of its pieces'
weights: a unigram model's scores as they are, a merge model's ranks as
``-power * log(2 + rank)``. Sums over all paths to the end, taken backwards, turn
the lattice into exact step probabilities.

Samples are the top ``k`` of all segmentations by log-probability plus Gumbel
noise, that is, a draw without replacement. They are found best first (perturbed
A-star): the search holds groups of paths, each with the exact maximum of its
noise. Following the best group down to a leaf is a plain draw step by step; at
every step the siblings that were passed by stay behind as a group, whose maximum is
drawn below the one it comes from. The next sample leaves the best group that is
left, at its step, and goes on from there. The maximum of the best group after
``k`` samples gives the inclusion probability of each (Kool et al., 2019).

Noise comes from a counter-based generator seeded by the row's key, so a row has the same
samples wherever and however often it is computed. No piece holds a word mark after
another character, so words are independent: their lattices are built once per
group of texts, all words of one length side by side, in numpy.

Defined results: a null or empty text has one sample without pieces. A text with
fewer than ``k`` segmentations has them all, each with inclusion probability 1.
Rows with equal keys and texts have equal samples; a null key is a key like any other. Characters that are no
piece become byte pieces. Decoding skips null, control and unknown ids; bytes that are no UTF-8 become
replacement characters. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.common import col, fresh

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
POWER = 1.0
MARK = "▁"
#: Characters whose lattices are held at a time; a longer text is a group of its own.
GROUP_CHARS = 400_000
#: Ids that are decoded at a time.
DECODE_IDS = 1 << 18
#: Words above this length are also cut between characters that no piece joins.
LONG_WORD = 64

#: Before a part of a word that has no mark; no text holds it, since it is no character.
_INNER = "\udfff"
_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")

# --- vocabulary -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Vocabulary:
    """What the tasks need of a model: pieces (None for control and byte pieces), weights, ids of bytes."""

    pieces: tuple[str | None, ...]
    weights: tuple[float, ...]
    bytes_: tuple[int, ...]
    byte_weight: float


def read_vocabulary(path: str = MODEL, power: float = POWER) -> Vocabulary:
    """Read a model on the driver; its size is fixed, well under a megabyte."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.vocab_size())
    names, scores = [model.id_to_piece(i) for i in ids], [model.get_score(i) for i in ids]
    ordinary = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in ids]
    # Merge models number their merges; those of a unigram model are log-probabilities.
    ranks = all(s == int(s) for s, o in zip(scores, ordinary) if o)
    weights = [-power * float(np.log(2 + abs(s))) if ranks else power * s for s in scores]
    of_byte = {int(_BYTE.fullmatch(names[i])[1], 16): i for i in ids if model.is_byte(i)}
    lowest = -power * float(np.log(2 + len(names))) if ranks else power * min(s for s, o in zip(scores, ordinary) if o)
    unknown = model.unk_id()
    return Vocabulary(
        tuple(n if o else None for n, o in zip(names, ordinary)), tuple(weights),
        tuple(of_byte.get(b, unknown) for b in range(256)), lowest,
    )


class Trie:
    """The pieces as a double array: state ``s`` goes on with character class ``c`` to
    ``base[s] + c`` if ``owner`` there is ``s``."""

    def __init__(self, vocabulary: Vocabulary):
        pieces = [(p, i) for i, p in enumerate(vocabulary.pieces) if p]
        self.longest = max((len(p) for p, _ in pieces), default=1)
        alphabet = sorted({c for p, _ in pieces for c in p})
        self.class_of = np.zeros(0x110000, np.int32)
        self.class_of[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        self.pairs = {p[i : i + 2] for p, _ in pieces for i in range(len(p) - 1)}
        root: dict = {}
        for piece, i in pieces:
            node = root
            for c in piece:
                node = node.setdefault(int(self.class_of[ord(c)]), {})
            node[0] = i
        room = 4 * (sum(len(p) for p, _ in pieces) + len(alphabet) + 2)
        owner, base = np.full(room, -1, np.int32), np.zeros(room, np.int32)
        piece_at, weight_at = np.full(room, -1, np.int64), np.zeros(room)
        queue, free, ahead = [(root, 0)], 1, 1
        for node, state in queue:
            if 0 in node:
                piece_at[state], weight_at[state] = node[0], vocabulary.weights[node[0]]
            classes = np.array(sorted(c for c in node if c), np.int64)
            if not len(classes):
                continue
            # Single children fill the gaps that larger families, placed one after the other, leave.
            at = free if len(classes) == 1 and free > classes[0] else max(ahead, int(classes[0]) + 1)
            offset = at - int(classes[0])
            while (owner[offset + classes] != -1).any():
                offset += 1
            base[state] = offset
            owner[offset + classes] = state
            if len(classes) > 1:
                ahead = offset + int(classes[0]) + 1
            while owner[free] != -1:
                free += 1
            queue += [(node[int(c)], offset + int(c)) for c in classes]
        used = int(np.flatnonzero(owner >= 0).max(initial=0)) + len(alphabet) + 2
        self.base, self.owner = base[:used], owner[:used]
        self.piece_at, self.weight_at = piece_at[:used], weight_at[:used]

    def step(self, states: np.ndarray, classes: np.ndarray) -> np.ndarray:
        to = self.base[states] + classes
        return np.where((classes > 0) & (self.owner[to] == states), to, -1)


@lru_cache(maxsize=2)
def _trie(vocabulary: Vocabulary) -> Trie:
    return Trie(vocabulary)


# --- lattices of many words ---------------------------------------------------------------------------


class Lattices:
    """The lattices of different words, longest first, laid out by distance from the word's end.

    Node ``first[t] + r`` is word ``r`` with ``t`` characters to go. Its edges are
    ``edges[node] : edges[node + 1]``, shortest first, each with a piece (-2: byte pieces), a length, its
    log-probability and the cumulative probability ``upto``.
    """

    def __init__(self, words: list[str], vocabulary: Vocabulary):
        trie = _trie(vocabulary)
        raw = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        order = np.argsort(-sizes, kind="stable")
        self.rank = np.empty(len(words), np.int64)
        self.rank[order] = np.arange(len(words))
        self.sizes, ends = sizes[order], ends[order]
        longest = int(self.sizes[0]) if len(words) else 0
        # How many words have at least t characters, t = 0 .. longest.
        many = np.searchsorted(-self.sizes, -np.arange(longest + 1), side="right")
        self.first = np.concatenate(([0], np.cumsum(many))).astype(np.int64)
        total = int(self.first[-1])
        self.width = min(trie.longest, max(longest, 1))
        self.beta, self.char = np.zeros(total), np.zeros(total, np.uint32)
        piece_weights = np.array(vocabulary.weights)
        counts = np.zeros(total, np.int64)
        pieces, lengths, uptos, logs = [], [], [], []
        classes = [np.empty(0, np.int32)]
        for t in range(1, longest + 1):
            n, at = int(many[t]), int(self.first[t])
            chars = raw[ends[:n] - t]
            self.char[at : at + n] = chars
            classes.append(trie.class_of[chars])
            alive, states = np.arange(n), trie.step(np.zeros(n, np.int64), classes[t])
            bare, found = np.ones(n, bool), []
            for length in range(1, min(t, self.width) + 1):
                keep = states >= 0
                if not keep.all():
                    alive, states = alive[keep], states[keep]
                if not len(alive):
                    break
                piece = trie.piece_at[states]
                here = piece >= 0
                rows, ids = alive[here], piece[here]
                if len(rows):
                    found.append((length, rows, ids, piece_weights[ids] + self.beta[self.first[t - length] + rows]))
                    if length == 1:
                        bare[rows] = False
                if length < t and length < self.width:
                    states = trie.step(states, classes[t - length][alive])
            lone = np.flatnonzero(bare)
            if len(lone):
                spent = _utf8_size(chars[lone]) * vocabulary.byte_weight + self.beta[self.first[t - 1] + lone]
                found.insert(0, (1, lone, np.full(len(lone), -2), spent))
            # Every node has an edge of one character; sums are taken relative to it.
            base = np.empty(n)
            for length, rows, _, score in found:
                if length == 1:
                    base[rows] = score
            whole, count = np.zeros(n), np.zeros(n, np.int64)
            shares = []
            for _, rows, _, score in found:
                share = np.exp(score - base[rows])
                shares.append(share)
                whole[rows] += share
                count[rows] += 1
            self.beta[at : at + n] = base + np.log(whole)
            counts[at : at + n] = count
            begin = np.cumsum(count) - count
            size = int(count.sum())
            piece_out, length_out, upto_out, log_out = np.empty(size, np.int32), np.empty(size, np.uint8), np.empty(size), np.empty(size)
            filled, run, here_sum = begin.copy(), np.zeros(n), self.beta[at : at + n]
            for (length, rows, ids, score), share in zip(found, shares):
                place = filled[rows]
                filled[rows] += 1
                run[rows] += share
                piece_out[place], length_out[place], upto_out[place] = ids, length, run[rows] / whole[rows]
                log_out[place] = np.minimum(score - here_sum[rows], 0.0)
            # The last edge takes whatever rounding leaves.
            upto_out[begin + count - 1] = 2.0
            pieces.append(piece_out)
            lengths.append(length_out)
            uptos.append(upto_out)
            logs.append(log_out)
        self.edges = np.concatenate(([0], np.cumsum(counts)))
        joined = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
        self.piece, self.length = joined(pieces, np.int32), joined(lengths, np.uint8)
        self.upto, self.log_p = joined(uptos, float), joined(logs, float)

    def choose(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The edge that a number in (0, 1) picks at a node."""
        edge = self.edges[node]
        open_ = np.flatnonzero(self.upto[edge] <= u)
        while len(open_):
            edge[open_] += 1
            open_ = open_[self.upto[edge[open_]] <= u[open_]]
        return edge

    def node_of(self, edge: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, edge, side="right") - 1

    def to_go(self, node: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, node, side="right") - 1


def _utf8_size(chars: np.ndarray) -> np.ndarray:
    return 1 + (chars >= 0x80).astype(np.int64) + (chars >= 0x800) + (chars >= 0x10000)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of a counter-based generator (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _state(seeds: np.ndarray, counter: np.ndarray, stream: int) -> np.ndarray:
    """Where a generator stands; each further number adds ``_GOLDEN``."""
    return seeds + np.uint64((stream * 0xD1342543DE82EF95) & 0xFFFF_FFFF_FFFF_FFFF) + counter.astype(np.uint64) * _GOLDEN


def _number(state: np.ndarray) -> np.ndarray:
    """A number in (0, 1)."""
    return ((_mix(state) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _uniform(seeds: np.ndarray, counter: np.ndarray | int, stream: int) -> np.ndarray:
    return _number(_state(seeds, np.asarray(counter), stream))


# --- paths -----------------------------------------------------------------------------------------------


@dataclass
class Paths:
    """One path for every text, end to end: lattice edges, their words and log-probabilities; text ``d``
    has ``stops[d] : stops[d + 1]``. ``branch`` is the step where it left another path (-1: none), ``gone`` the
    lengths that were passed by or taken there before, as bits."""

    edge: np.ndarray
    word: np.ndarray
    log_p: np.ndarray
    stops: np.ndarray
    branch: np.ndarray
    gone: np.ndarray


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers ``starts[i] .. starts[i] + counts[i] - 1``, one range after the other."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(int(counts.sum()))


def _draw(lat: Lattices, to_go: np.ndarray, row: np.ndarray, word: np.ndarray, states: np.ndarray):
    """Draw paths from nodes to their words' ends: edges and words in the given order, and steps per path."""
    n = len(row)
    alive, steps, kept = np.flatnonzero(to_go > 0), np.zeros(n, np.int64), []
    left, at, states = to_go[alive], row[alive], states[alive]
    while len(alive):
        edge = lat.choose(lat.first[left] + at, _number(states))
        left = left - lat.length[edge]
        kept.append((alive, edge))
        steps[alive] += 1
        on = np.flatnonzero(left)
        alive, left, at, states = alive[on], left[on], at[on], states[on] + _GOLDEN
    starts = np.cumsum(steps) - steps
    edges = np.empty(int(steps.sum()), np.int64)
    for k, (who, edge) in enumerate(kept):
        edges[starts[who] + k] = edge
    return edges, np.repeat(word, steps), steps


#: -log of a number that ``_uniform`` can give lies within e**-38 .. e**38.
_REACH = 76.0


@dataclass
class Groups:
    """Siblings that were passed by: steps of a path, in order, and the log of each group's arrival time."""

    step: np.ndarray
    time: np.ndarray
    stops: np.ndarray


def _groups(paths: Paths, below: np.ndarray, exists: np.ndarray, seeds: np.ndarray, stream: int, k: int) -> Groups:
    """The groups that a path leaves behind after its branch, none before ``below``'s time.

    A group that is lighter than ``k + 1`` others by more than the noise can make up
    for is never among the first ``k + 1``, so it needs no noise.
    """
    counts = np.diff(paths.stops)
    full = counts > 0
    run = np.cumsum(paths.log_p) - paths.log_p
    origin = np.zeros(len(counts))
    origin[full] = run[paths.stops[:-1][full]]
    begin = paths.stops[:-1] + paths.branch + 1

    def masses(step: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        passed = -np.expm1(paths.log_p[step])
        some = passed > 1e-12
        step, doc = step[some], doc[some]
        return step, doc, run[step] - origin[doc] + np.log(passed[some])

    docs = np.flatnonzero(exists & full)
    near = np.minimum(paths.stops[1:][docs] - begin[docs], 64)
    step, doc, mass = masses(_ranges(begin[docs], near), np.repeat(docs, near))
    turn = np.arange(len(doc)) - np.searchsorted(doc, doc)
    enough = np.bincount(doc[turn == k], minlength=len(counts)) > 0
    bound = np.full(len(counts), np.inf)
    np.minimum.at(bound, doc[turn <= k], mass[turn <= k])
    bound[~enough] = -np.inf
    # A step is never heavier than the path up to it.
    reach = np.repeat(np.where(exists, bound - _REACH + origin, np.inf), counts)
    step = np.flatnonzero(run >= reach)
    doc = np.searchsorted(paths.stops, step, side="right") - 1
    late = step >= begin[doc]
    step, doc, mass = masses(step[late], doc[late])
    noise = -np.log(_uniform(seeds[doc], step - paths.stops[doc], stream))
    time = np.logaddexp(below[doc], np.log(noise) - mass)
    return Groups(step, time, np.searchsorted(doc, np.arange(len(counts) + 1)))


def _with_rest(groups: Groups, at: np.ndarray, time: np.ndarray, docs: np.ndarray) -> Groups:
    """``groups`` with one more for each of ``docs``, at a step before all others of its text."""
    place = groups.stops[docs]
    more = np.zeros(len(groups.stops) - 1, np.int64)
    more[docs] = 1
    return Groups(np.insert(groups.step, place, at), np.insert(groups.time, place, time), groups.stops + np.concatenate(([0], np.cumsum(more))))


def _first_of(groups: Groups) -> tuple[np.ndarray, np.ndarray]:
    """Least time of every text (infinite for none) and its place among the groups."""
    counts = np.diff(groups.stops)
    least, place = np.full(len(counts), np.inf), np.zeros(len(counts), np.int64)
    full = np.flatnonzero(counts)
    if len(full):
        least[full] = np.minimum.reduceat(groups.time, groups.stops[:-1][full])
        hit = np.flatnonzero(groups.time == np.repeat(least, counts))
        owner = np.searchsorted(groups.stops, hit, side="right") - 1
        place[owner[::-1]] = hit[::-1]
    return least, place


@dataclass
class Words:
    """The words of a group of texts: lattice rows, sizes, texts, and where their generators stand."""

    row: np.ndarray
    size: np.ndarray
    doc: np.ndarray
    counter: np.ndarray


def _split(texts: list[str], vocabulary: Vocabulary) -> tuple[Lattices, Words]:
    pairs, numbers = _trie(vocabulary).pairs, defaultdict(count().__next__)
    words, counts = [], np.zeros(len(texts), np.int64)
    for d, text in enumerate(texts):
        if not text:
            continue
        if "  " in text or MARK in text:
            found = [w.removeprefix(MARK) if w[1:2] != MARK else w for w in _WORD.findall(MARK + text.replace(" ", MARK))]
        else:
            found = text.split(" ")
        if max(map(len, found)) > LONG_WORD:
            found = [part for w in found for part in (_cut_long(w, pairs) if len(w) > LONG_WORD else (w,))]
        counts[d] = len(found)
        words += [numbers[w] for w in found]
    # Words are kept without their mark; those that are not a word's start have a sign instead.
    lat = Lattices([_marked(w) for w in numbers], vocabulary)
    row = lat.rank[np.array(words, np.int64)] if words else np.empty(0, np.int64)
    size = lat.sizes[row]
    # Every word has its own range of numbers, as wide as it is long.
    counter = np.cumsum(size) - size
    begin = (np.cumsum(counts) - counts)[counts > 0]
    counter = counter - np.repeat(counter[begin], counts[counts > 0])
    return lat, Words(row, size, np.repeat(np.arange(len(texts)), counts), counter)


def sample_group(texts: list[str], seeds: np.ndarray, vocabulary: Vocabulary, k: int = SAMPLES):
    """Per rank: ``(ids, stops, log_prob, perturbed)`` of all texts, NaN where there is no such sample; and the log of
    the time of the next one, infinite where all were found."""
    n = len(texts)
    lat, words = _split(texts, vocabulary)
    edge, word, steps = _draw(lat, words.size, words.row, np.arange(len(words.row)), _state(seeds[words.doc], words.counter, 1))
    stops = np.concatenate(([0], np.cumsum(np.bincount(words.doc, steps, n).astype(np.int64))))
    path = Paths(edge, word, lat.log_p[edge], stops, np.full(n, -1), np.zeros(n, np.int64))
    time = np.log(-np.log(_uniform(seeds, 0, 2)))
    exists = np.ones(n, bool)
    found, open_, rest = [], [], None
    for turn in range(1, k + 1):
        log_prob = np.bincount(np.repeat(np.arange(n), np.diff(path.stops)), path.log_p, n)
        found.append((path, np.where(exists, log_prob, np.nan), np.where(exists, -time, np.nan)))
        groups = _groups(path, time, exists, seeds, 2 + 2 * turn, 2 * k)
        if rest is not None:
            # What the branch's step still holds beside the pieces that are gone.
            docs = np.flatnonzero(exists & (rest > -np.inf))
            noise = -np.log(_uniform(seeds[docs], 0, 3 + 2 * turn))
            left = np.logaddexp(time[docs], np.log(noise) - rest[docs])
            groups = _with_rest(groups, path.stops[docs] + path.branch[docs], left, docs)
        open_.append((path, groups))
        best, whose, place = np.full(n, np.inf), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for number, (_, g) in enumerate(open_):
            least, at = _first_of(g)
            better = least < best
            best[better], whose[better], place[better] = least[better], number, at[better]
        time, exists = best, np.isfinite(best)
        if turn < k:
            path, rest = _branch(lat, words, open_, exists, whose, place, seeds, turn)
    return [(*_ids(lat, p, vocabulary), log_prob, perturbed) for p, log_prob, perturbed in found], time


def _branch(lat: Lattices, words: Words, open_: list[tuple[Paths, Groups]], exists: np.ndarray, whose: np.ndarray, place: np.ndarray, seeds: np.ndarray, turn: int) -> tuple[Paths, np.ndarray]:
    """The path that leaves each text's best group: its parent's steps, another piece, then a fresh draw; and the
    log-mass of what its step still holds."""
    n = len(exists)
    branch, gone, word, edge = (np.zeros(n, np.int64) for _ in range(4))
    to_go, rest = np.zeros(n, np.int64), np.full(n, -np.inf)
    for number, (p, groups) in enumerate(open_):
        docs = np.flatnonzero(exists & (whose == number))
        if not len(docs):
            continue
        groups.time[place[docs]] = np.inf
        at = groups.step[place[docs]]
        branch[docs], word[docs] = at - p.stops[docs], p.word[at]
        run = np.cumsum(p.log_p) - p.log_p
        taken = np.where(branch[docs] == p.branch[docs], p.gone[docs], 1 << (lat.length[p.edge[at]].astype(np.int64) - 1))
        node = lat.node_of(p.edge[at])
        first = lat.edges[node]
        wide = lat.edges[node + 1] - first
        r, option = np.repeat(np.arange(len(docs)), wide), _ranges(first, wide)
        free = (taken[r] >> (lat.length[option].astype(np.int64) - 1)) & 1 == 0
        share = np.zeros((len(docs), int(wide.max())))
        share[r[free], (option - first[r])[free]] = np.exp(lat.log_p[option[free]])
        upto = np.cumsum(share, axis=1)
        u = _uniform(seeds[docs], 0, 1000 + turn) * upto[:, -1]
        pick = (upto <= u[:, None]).sum(axis=1)
        edge[docs] = first + pick
        to_go[docs] = lat.to_go(node) - lat.length[edge[docs]]
        left = upto[:, -1] - share[np.arange(len(docs)), pick]
        with np.errstate(divide="ignore"):
            rest[docs] = np.where(left > 1e-12, run[at] - run[p.stops[docs]] + np.log(left), -np.inf)
        gone[docs] = taken | (1 << (lat.length[edge[docs]].astype(np.int64) - 1))
    # Fresh: what is left of the branch's word, and all words after it.
    fresh_word = np.flatnonzero(exists[words.doc] & (np.arange(len(words.row)) >= word[words.doc]))
    docs = words.doc[fresh_word]
    size = np.where(fresh_word == word[docs], to_go[docs], words.size[fresh_word])
    states = _state(seeds[docs], words.counter[fresh_word], 2000 + turn)
    f_edge, f_word, steps = _draw(lat, size, words.row[fresh_word], fresh_word, states)
    tail = np.bincount(docs, steps, n).astype(np.int64)
    parts = [p for p, _ in open_]
    source = np.cumsum([0, *(len(p.edge) for p in parts), n])
    head = np.zeros(n, np.int64)
    for number, p in enumerate(parts):
        mine = whose == number
        head[mine] = source[number] + p.stops[:-1][mine]
    one = exists.astype(np.int64)
    starts = np.column_stack((head, source[-2] + np.arange(n), source[-1] + np.cumsum(tail) - tail)).ravel()
    counts = np.column_stack((branch * one, one, tail))
    index = _ranges(starts, counts.ravel())
    edges = np.concatenate([*(p.edge for p in parts), edge, f_edge])[index]
    owners = np.concatenate([*(p.word for p in parts), word, f_word])[index]
    stops = np.concatenate(([0], np.cumsum(counts.sum(axis=1))))
    return Paths(edges, owners, lat.log_p[edges], stops, np.where(exists, branch, -1), gone), rest


def _marked(word: str) -> str:
    return word[1:] if word[:1] == _INNER else word if word[:1] == MARK else MARK + word


def _cut_long(word: str, pairs: set[str]) -> list[str]:
    """Parts between which no piece reaches; those after the first say that no mark precedes them."""
    whole, parts, start = _marked(word), [], 0
    for i in range(1, len(whole)):
        if whole[i - 1 : i + 1] not in pairs:
            parts.append(whole[start:i])
            start = i
    parts.append(whole[start:])
    return [p if p[:1] == MARK else _INNER + p for p in parts]


def _ids(lat: Lattices, path: Paths, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids with byte pieces spelt out, and each text's stop."""
    ids = lat.piece[path.edge]
    bare = np.flatnonzero(ids == -2)
    if not len(bare):
        return ids, path.stops
    chars = lat.char[lat.node_of(path.edge[bare])]
    data = np.frombuffer(chars.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"), np.uint8)
    width = np.ones(len(ids), np.int64)
    width[bare] = _utf8_size(chars)
    upto = np.concatenate(([0], np.cumsum(width)))
    ids = np.repeat(ids, width)
    ids[ids == -2] = np.array(vocabulary.bytes_, np.int32)[data]
    return ids, upto[path.stops]


# --- DataFrames --------------------------------------------------------------------------------------------


SAMPLES_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("log_prob", T.DoubleType()),
            T.StructField("perturbed", T.DoubleType()),
            T.StructField("log_inclusion", T.DoubleType()),
        ]
    )
)


def _blocks(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours of at most ``most`` together; what is larger alone is a range of its own."""
    start = 0
    while start < len(sizes):
        stop, held = start, 0
        while stop < len(sizes) and (stop == start or held + sizes[stop] <= most):
            held += sizes[stop]
            stop += 1
        yield start, stop
        start = stop


def sample_texts(texts: pa.Array, keys: np.ndarray, vocabulary: Vocabulary, k: int) -> Iterator[tuple[int, int, pa.Array]]:
    """The samples of a batch, one list per text, a group of texts at a time."""
    sizes = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
    for start, stop in _blocks(sizes, GROUP_CHARS):
        group = [t or "" for t in texts.slice(start, stop - start).to_pylist()]
        yield start, stop, _sample_chunk(group, keys[start:stop], vocabulary, k)


def _sample_chunk(texts: list[str], keys: np.ndarray, vocabulary: Vocabulary, k: int) -> pa.Array:
    ranks, time = sample_group(texts, _mix(keys.astype(np.int64).view(np.uint64)), vocabulary, k)
    n = len(texts)
    there = np.column_stack([~np.isnan(log_prob) for _, _, log_prob, _ in ranks])
    sizes = np.column_stack([np.diff(stops) for _, stops, _, _ in ranks])
    base = np.cumsum([0, *(len(ids) for ids, *_ in ranks)])
    starts = np.column_stack([base[i] + stops[:-1] for i, (_, stops, _, _) in enumerate(ranks)])
    chosen = there.ravel()
    counts = sizes.ravel()[chosen]
    flat = np.concatenate([ids for ids, *_ in ranks])[_ranges(starts.ravel()[chosen], counts)]
    log_prob = np.column_stack([r[2] for r in ranks]).ravel()[chosen]
    perturbed = np.column_stack([r[3] for r in ranks]).ravel()[chosen]
    after = np.repeat(time[:, None], len(ranks), axis=1).ravel()[chosen]
    # P(included) = 1 - exp(-exp(log_prob + after)), as a logarithm that does not underflow.
    rate = log_prob + after
    with np.errstate(over="ignore", divide="ignore"):
        inclusion = np.where(rate < -30, rate, np.log(-np.expm1(-np.exp(np.minimum(rate, 700)))))
    offsets = lambda c: pa.array(np.concatenate(([0], np.cumsum(c))), pa.int32())
    ids = pa.ListArray.from_arrays(offsets(counts), pa.array(flat, pa.int32()))
    rows = pa.StructArray.from_arrays([ids, pa.array(log_prob), pa.array(perturbed), pa.array(inclusion)], ["ids", "log_prob", "perturbed", "log_inclusion"])
    return pa.ListArray.from_arrays(offsets(there.sum(axis=1)), rows)


def encode(
    docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", key_col: str = "doc_id", k: int = SAMPLES, seed: int = 42
) -> DataFrame:
    """``docs`` with ``samples``: up to ``k`` different segmentations, best perturbed score first, each
    ``struct<ids, log_prob, perturbed, log_inclusion>``."""

    extra = [c for c in docs.columns if c.lower() != "samples"]
    (key,) = fresh(docs, "key")
    place, names = extra.index(text_col), [*extra, "samples"]

    def batches(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups:
            keys = rows.column(len(extra)).to_numpy(zero_copy_only=False)
            # Results leave group by group, so that a batch's are never held together.
            for start, stop, samples in sample_texts(rows.column(place), keys, vocabulary, k):
                kept = [rows.column(i).slice(start, stop - start) for i in range(len(extra))]
                yield pa.RecordBatch.from_arrays([*kept, samples], names)

    seeds = F.xxhash64(F.lit(seed), F.coalesce(col(key_col).cast("string"), F.lit("")))
    keyed = docs.select(*[col(c) for c in extra], seeds.alias(key))
    schema = T.StructType([*keyed.schema.fields[:-1], T.StructField("samples", SAMPLES_TYPE)])
    return keyed.mapInArrow(batches, schema)


@lru_cache(maxsize=2)
def _spelling(vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """All pieces' bytes, and where each id's begin."""
    parts = [(p or "").replace(MARK, " ").encode() for p in vocabulary.pieces]
    for byte, i in enumerate(vocabulary.bytes_):
        if vocabulary.pieces[i] is None:
            parts[i] = bytes([byte])
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate(([0], np.cumsum([len(p) for p in parts])))


def decode_ids(flat: np.ndarray, stops: np.ndarray, vocabulary: Vocabulary) -> list[str]:
    """The texts of many id lists laid end to end."""
    letters, at = _spelling(vocabulary)
    last, at = len(at) - 1, np.append(at, at[-1]).astype(np.int32)
    ids = np.where((flat >= 0) & (flat < last), flat, last)
    sizes = at[ids + 1] - at[ids]
    data = letters[_ranges(at[ids], sizes)].tobytes()
    upto = np.concatenate(([0], np.cumsum(sizes)))[stops].tolist()
    parts = [data[a:b].decode("utf-8", "replace") for a, b in zip(upto, upto[1:])]
    return [t[1:] if t[:1] == " " else t for t in parts]


def decode(rows: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of an id list; null for a null list."""
    extra = [c for c in rows.columns if c.lower() != text_col.lower()]
    place, names = extra.index(ids_col), [*extra, text_col]

    def batches(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups:
            sizes = pc.fill_null(pc.list_value_length(batch.column(place)), 0).to_pylist()
            for start, stop in _blocks(sizes, DECODE_IDS):
                part = batch.slice(start, stop - start)
                ids = part.column(place)
                flat = ids.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
                texts = decode_ids(flat, np.concatenate(([0], np.cumsum(sizes[start:stop]))).astype(np.int64), vocabulary)
                decoded = pa.array([t if there else None for t, there in zip(texts, ids.is_valid().to_pylist())], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], names)

    kept = rows.select(*[col(c) for c in extra])
    return kept.mapInArrow(batches, T.StructType([*kept.schema.fields, T.StructField(text_col, T.StringType())]))

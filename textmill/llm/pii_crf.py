"""Personal data: four patterns, and a linear-chain conditional random field.

Patterns find emails, IP addresses, cards and phone numbers exactly. The field
labels every word by its shape and its neighbours' (never by what it spells), and
adds spans where people write such data in forms the patterns do not take: phone
numbers without a plus, IPv6 addresses, emails without a dot or with ``(at)``.

The field is trained from a small labelled table of (sentence, position, word,
label) rows; its weights are a few hundred numbers. Decoding is exact Viterbi in
numpy over a whole batch: a word whose best other label cannot make up for the
transitions is outside any span on every best path, so it cuts the chain, and
the short pieces between such words are decoded side by side.

Spans count code points, ends exclusive. Defined results: a null or empty text has
no spans; equal rows are scanned each for itself; an empty table gives an empty result. A
field trained on no rows adds nothing.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm.common import col, fresh

KINDS = ("email", "ip", "card", "phone")
OUTSIDE = 0
LABELS = ("O", *KINDS)
Span = tuple[int, int, int]  # rank of the kind, start, end

# --- patterns -----------------------------------------------------------------------------------

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# Possessive and only at the first digit of a run: a later start would meet the same rest and fail too.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(values[::2] + [2 * d - 9 * (d > 4) for d in values[1::2]]) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each ``@``: what can stand before it, back to the last match, and the domain after it."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1)
        free = at + 1
        if start < at and domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", free)


def base_spans(text: str) -> list[Span]:
    found = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        # Leading zeros go first: Python bounds the digits of a number it reads.
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := _NOT_DIGIT.sub("", m.group())) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                found.append((3, *m.span()))
    return found


# --- words and their shapes -----------------------------------------------------------------------

#: Classes of characters: blank, lower, upper, digit, and punctuation by what it may mean.
_BLANK, _LOWER, _UPPER, _NUMBER, _AT, _DOT, _DASH, _PAREN, _PLUS, _COLON, _OTHER = range(11)
_CLASS = np.full(1 << 7, _OTHER, np.uint8)
_CLASS[:33] = _BLANK
for _chars, _kind in (("abcdefghijklmnopqrstuvwxyz", _LOWER), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", _UPPER), ("0123456789", _NUMBER), ("@", _AT), (".", _DOT), ("-", _DASH), ("()[]", _PAREN), ("+", _PLUS), (":", _COLON)):
    _CLASS[[ord(c) for c in _chars]] = _kind
_DIGIT_BUCKET = np.array([0, 1, 2, 3, 4, 5, 5, 6, 6, 6, 7, 7, 7, 8, 8, 8, 9], np.int64)
#: Sizes of the feature groups of one word: digits by case, punctuation, dots by length, ends.
_GROUPS = (40, 128, 40, 121)
_NEIGHBOUR = 41  # the first group of a neighbour, or that there is none
_OFFSETS = np.cumsum((0, *_GROUPS, _NEIGHBOUR, _NEIGHBOUR))
FEATURES = int(_OFFSETS[-1])


def _words(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of every character, start and end of every word."""
    classes = np.where(codes < 128, _CLASS[np.minimum(codes, 127)], np.uint8(_LOWER))
    classes[(codes == 0xA0) | (codes == 0x3000) | ((codes >= 0x2000) & (codes <= 0x200A))] = _BLANK
    inside = np.concatenate(([0], classes != _BLANK, [0])).astype(np.int8)
    steps = np.diff(inside)
    return classes, np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def features(classes: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Six feature numbers for every word; ``first`` and ``last`` mark the ends of a text."""
    if not len(starts):
        return np.empty((0, 6), np.int64)

    def count(kind: int) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(classes == kind, dtype=np.int64)))
        return sums[ends] - sums[starts]

    n = {kind: count(kind) for kind in range(_LOWER, _OTHER + 1)}
    lower, upper = n[_LOWER] > 0, n[_UPPER] > 0
    letters = lower + 2 * upper  # none, lower, upper, both
    shape = _DIGIT_BUCKET[np.minimum(n[_NUMBER], 16)] * 4 + letters
    marks = sum((n[kind] > 0).astype(np.int64) << i for i, kind in enumerate(range(_AT, _OTHER + 1)))
    length = np.minimum(np.log2(ends - starts).astype(np.int64), 7)
    dots = np.minimum(n[_DOT] + n[_COLON], 4) * 8 + length
    tips = classes[starts].astype(np.int64) * 11 + classes[ends - 1]
    before = np.concatenate(([0], shape[:-1] + 1))
    after = np.concatenate((shape[1:] + 1, [0]))
    before[first], after[last] = 0, 0
    return np.stack((shape, marks, dots, tips, before, after), axis=1) + _OFFSETS[:-1]


# --- the field --------------------------------------------------------------------------------------


@dataclass
class Field:
    """Weights: of every feature for every label, between labels, at a text's start and end."""

    emit: np.ndarray
    move: np.ndarray
    start: np.ndarray
    stop: np.ndarray

    @classmethod
    def blank(cls) -> Field:
        k = len(LABELS)
        return cls(np.zeros((FEATURES, k)), np.zeros((k, k)), np.zeros(k), np.zeros(k))


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def _encode(sentences: list[list[tuple[str, str]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    longest, n = max(map(len, sentences)), len(sentences)
    x, y, real = np.zeros((n, longest, 6), np.int64), np.zeros((n, longest), np.int64), np.zeros((n, longest), bool)
    for i, sentence in enumerate(sentences):
        codes = np.frombuffer(" ".join(w for w, _ in sentence).encode("utf-32-le"), np.uint32)
        classes, starts, ends = _words(codes)
        x[i, : len(sentence)] = features(classes, starts, ends, np.array([0]), np.array([len(starts) - 1]))
        y[i, : len(sentence)] = [LABELS.index(label) for _, label in sentence]
        real[i, : len(sentence)] = True
    return x, y, real


def train(labelled: DataFrame, rounds: int = 100, rate: float = 0.1, decay: float = 2e-4) -> Field:
    """Maximise the likelihood of ``(sentence, position, word, label)`` rows, a small table.

    Full-batch Adam with forward-backward over all sentences side by side. Words
    must hold no blank; rows with a null word or label are left out.
    """
    sentences: dict = {}
    for r in labelled.where("word IS NOT NULL AND label IS NOT NULL").orderBy("sentence", "position").collect():
        sentences.setdefault(r["sentence"], []).append((r["word"], r["label"]))
    field = Field.blank()
    if not sentences:
        return field
    x, y, real = _encode(list(sentences.values()))
    n, longest, _ = x.shape
    rows, lengths, k = np.arange(n), real.sum(axis=1), len(LABELS)
    ends = lengths - 1
    weights = [field.emit, field.move, field.start, field.stop]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    gold = np.zeros((n, longest, k))
    gold[rows[:, None], np.arange(longest), y] = real
    both = real[:, 1:] & real[:, :-1]
    for step in range(1, rounds + 1):
        e = field.emit[x].sum(axis=2)
        ahead, back = np.zeros((n, longest, k)), np.zeros((n, longest, k))
        ahead[:, 0] = field.start + e[:, 0]
        for t in range(1, longest):
            ahead[:, t] = _sum_exp(ahead[:, t - 1, :, None] + field.move, 1) + e[:, t]
        back[rows, ends] = field.stop
        for t in range(longest - 2, -1, -1):
            on = _sum_exp(field.move + (e[:, t + 1] + back[:, t + 1])[:, None, :], 2)
            back[:, t] = np.where((t < ends)[:, None], on, back[:, t])
        total = _sum_exp(ahead[rows, ends] + field.stop, 1)
        seen = np.exp(ahead + back - total[:, None, None]) * real[:, :, None]
        pair = np.exp(ahead[:, :-1, :, None] + field.move + (e + back)[:, 1:, None, :] - total[:, None, None, None]) * both[:, :, None, None]
        gap = gold - seen
        gradient = [np.zeros_like(w) for w in weights]
        for label in range(k):
            gradient[0][:, label] = np.bincount(x[real].ravel(), np.repeat(gap[real][:, label], x.shape[2]), FEATURES)
        gradient[1] = np.einsum("ntk,ntl->kl", gold[:, :-1] * both[:, :, None], gold[:, 1:]) - pair.sum(axis=(0, 1))
        gradient[2], gradient[3] = gap[:, 0].sum(axis=0), gap[rows, ends].sum(axis=0)
        for w, g, (m, v) in zip(weights, gradient, moments):
            g = g / n - decay * w
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return field


def viterbi(e: np.ndarray, field: Field, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The best label of every word of many texts laid end to end; exact."""
    total, k = e.shape
    labels = np.zeros(total, np.int64)
    if not total:
        return labels
    into = np.vstack((field.move, field.start))  # the last row: a text begins
    out = np.column_stack((field.move, field.stop))  # the last column: it ends
    detour = (into[:, None, :] + out.T[None, :, :]) - (into[:, None, :1] + out.T[None, :, :1])
    surely = e[:, OUTSIDE] - e[:, 1:].max(axis=1) > detour.max()
    begins, finishes = np.zeros(total, bool), np.zeros(total, bool)
    begins[first], finishes[last] = True, True
    open_ = ~surely
    head = open_ & (begins | np.concatenate(([True], surely[:-1])))
    tail = open_ & (finishes | np.concatenate((surely[1:], [True])))
    heads, tails = np.flatnonzero(head), np.flatnonzero(tail)
    order = np.argsort(heads - tails, kind="stable")  # longest piece first
    heads, tails = heads[order], tails[order]
    sizes = tails - heads + 1
    if not len(sizes):
        return labels
    score = np.where(begins[heads][:, None], field.start, field.move[OUTSIDE]) + e[heads]
    came, alive = [], []
    for t in range(1, int(sizes[0])):
        n = int(np.searchsorted(-sizes, -t, side="left"))  # pieces longer than t
        paths = score[:n, :, None] + field.move
        best = paths.argmax(axis=1)
        came.append(best)
        alive.append(n)
        score[:n] = np.take_along_axis(paths, best[:, None, :], 1)[:, 0] + e[heads[:n] + t]
    score += np.where(finishes[tails][:, None], field.stop, field.move[:, OUTSIDE])
    state = score.argmax(axis=1)
    for t in range(int(sizes[0]) - 1, 0, -1):
        n = alive[t - 1]
        labels[heads[:n] + t] = state[:n]
        state[:n] = came[t - 1][np.arange(n), state[:n]]
    labels[heads] = state
    return labels


_TRIM = ".,;:!?\"'<>"


def _valid(rank: int, text: str) -> bool:
    digits = _NOT_DIGIT.sub("", text)
    if KINDS[rank] == "email":
        return len(text) >= 5
    if KINDS[rank] == "ip":
        parts = text.split(".")
        return text.count(":") >= 2 or len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    if KINDS[rank] == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 7 <= len(digits) <= 15


def find_spans(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """Pattern spans and added spans of every text, each in order of kind, then start."""
    base = [sorted(base_spans(t)) for t in texts]
    added: list[list[Span]] = [[] for _ in texts]
    joined = "\n".join(texts)
    classes, starts, ends = _words(np.frombuffer(joined.encode("utf-32-le"), np.uint32))
    edges = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    doc = np.searchsorted(edges, starts, side="right") - 1
    change = np.flatnonzero(np.diff(doc))
    first, last = np.concatenate(([0], change + 1)), np.concatenate((change, [len(doc) - 1]))
    if len(starts):
        x = features(classes, starts, ends, first, last)
        e = sum(field.emit[x[:, i]] for i in range(x.shape[1]))
        labels = viterbi(e, field, first, last)
        at = np.flatnonzero(labels)
        # Neighbouring words of one label and one text are one span.
        split = np.flatnonzero((np.diff(at) != 1) | (np.diff(labels[at]) != 0) | (np.diff(doc[at]) != 0)) + 1
        for run in np.split(at, split) if len(at) else []:
            d, rank = int(doc[run[0]]), int(labels[run[0]]) - 1
            s, e_ = int(starts[run[0]] - edges[d]), int(ends[run[-1]] - edges[d])
            whole = texts[d][s:e_]
            s, e_ = s + len(whole) - len(whole.lstrip(_TRIM)), e_ - len(whole) + len(whole.rstrip(_TRIM))
            if s < e_ and _valid(rank, texts[d][s:e_]):
                added[d].append((rank, s, e_))
    for d, new in enumerate(added):
        if new and base[d]:
            taken = np.array([b[1:] for b in base[d]])
            taken = taken[np.argsort(taken[:, 0], kind="stable")]
            reach = np.maximum.accumulate(taken[:, 1])
            place = [int(np.searchsorted(taken[:, 0], e_)) for _, _, e_ in new]
            added[d] = [span for span, p in zip(new, place) if p == 0 or reach[p - 1] <= span[1]]
    return [(b, sorted(a)) for b, a in zip(base, added)]


def joined_spans(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[rank]}:{s}:{e}" for rank, s, e in spans)


def scan(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``added_spans``, arrays of ``struct<kind, start, end>``
    in order of kind, then start."""
    kind = "array<struct<kind:string,start:bigint,end:bigint>>"

    def batches(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            found: list = []
            group: list[str] = []
            held = 0
            # A group of texts is labelled at a time; a very long one is a group of its own.
            for text in batch.fillna("").tolist():
                group.append(text)
                held += len(text)
                if held >= 1 << 20:
                    found += find_spans(group, field)
                    group, held = [], 0
            found += find_spans(group, field)
            rows = [[[{"kind": KINDS[r], "start": s, "end": e} for r, s, e in spans] for spans in both] for both in found]
            yield pd.DataFrame(rows, columns=["base_spans", "added_spans"])

    results = ["base_spans", "added_spans"]
    extra = [c for c in docs.columns if c.lower() not in results]
    (found,) = fresh(docs, "found")
    udf = F.pandas_udf(batches, f"base_spans {kind}, added_spans {kind}").asNondeterministic()
    return docs.select(*[col(c) for c in extra], udf(col(text_col)).alias(found)).select(
        *[col(c) for c in extra], *[F.col(found)[r].alias(r) for r in results]
    )


# --- a small labelled table ---------------------------------------------------------------------------


def labelled_table(spark: SparkSession, sentences: int = 500, seed: int = 7) -> DataFrame:
    """``(sentence, position, word, label)``: invented sentences, half of them with data of one kind."""
    rng = random.Random(seed)

    def digits(n: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(n))

    def card(n: int) -> str:
        body = digits(n - 1)
        return next(body + d for d in "0123456789" if luhn(body + d))

    def grouped(number: str, *sizes: int) -> list[str]:
        at = [sum(sizes[:i]) for i in range(len(sizes))]
        return [number[i : i + n] for i, n in zip(at, sizes)]

    def name(least: int = 2, most: int = 9) -> str:
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(least, most)))

    def plain() -> str:
        word = rng.choice([name, name, name, lambda: name().capitalize(), lambda: name().upper()])()
        return word + rng.choice(["", "", "", "", ".", ",", "!!", "***", "%%%", "&&&", "###", "$$$", ":"])

    def noise() -> str:
        return rng.choice([
            digits(rng.randint(1, 6)), f"{digits(2)}.{digits(2)}", f"{digits(1)},{digits(3)}", f"20{digits(2)}-{digits(2)}-{digits(2)}",
            f"{digits(2)}:{digits(2)}", f"{digits(1)}.{digits(1)}.{digits(1)}", f"v{digits(1)}.{digits(1)}", f"{name()}={digits(3)}{name()}{digits(4)}",
            f"https://{name()}.{name()}.com/{name()}/{digits(3)}", f"${digits(2)}.{digits(2)}", f"{name()}{digits(2)}", f"({digits(2)})", f"{digits(2)}%",
            f"{name().upper()}{digits(6)}{name().upper()}{digits(4)}", f"{digits(1)}.", f"@{name()}", f"+{digits(2)}", f"{name()}-{name()}", "-", f"({name()})",
            f'"{digits(4)}{name()}{digits(8)}{name()}"', f"{digits(12)}", f"{digits(20)}{name()}",
        ])

    makers = {
        "email": lambda: [rng.choice([f"{name()}@{name()}.{name(2, 3)}", f"{name()}.{digits(2)}@{name()}.example.com", f"{name()}@{name()}", f"{name()}(at){name()}.{name(2, 3)}", f"{name()}[at]{name()}.{name(2, 3)}"])],
        "ip": lambda: [rng.choice([".".join(str(rng.randint(0, 255)) for _ in range(4)), ":".join(f"{rng.randint(0, 65535):x}" for _ in range(8)), f"fe80::{rng.randint(0, 65535):x}:{rng.randint(0, 65535):x}"])],
        "card": lambda: rng.choice([grouped(card(16), 4, 4, 4, 4), ["-".join(grouped(card(16), 4, 4, 4, 4))], [card(16)], grouped(card(15), 4, 6, 5)]),
        "phone": lambda: rng.choice([
            [f"+{digits(1)}", f"({digits(3)})", f"{digits(3)}-{digits(4)}"], [f"({digits(3)})", f"{digits(3)}-{digits(4)}"], [f"{digits(3)}-{digits(3)}-{digits(4)}"],
            [f"+{digits(2)}", digits(3), digits(3), digits(4)], [f"+{digits(11)}"], [f"{digits(3)}.{digits(3)}.{digits(4)}"],
        ]),
    }
    rows = []
    for sentence in range(sentences):
        words = [(plain() if rng.random() < 0.85 else noise(), "O") for _ in range(rng.randint(3, 12))]
        if sentence % 2:
            kind = rng.choice(KINDS)
            found = [(w, kind) for w in makers[kind]()]
            at = rng.randint(0, len(words))
            if rng.random() < 0.3:
                found[-1] = (found[-1][0] + rng.choice(".,;"), kind)
            words[at:at] = found
        rows += [(sentence, i, w, label) for i, (w, label) in enumerate(words)]
    return spark.createDataFrame(rows, "sentence INT, position INT, word STRING, label STRING")

"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

A text's features are rates: hits of fixed word lists and of a lexicon learnt from the
labelled rows, their nearness to words that address someone, capitals, punctuation, and
disguised words (signs inside, letters apart, letters stretched) with the hits that show
once the disguise is undone. Whole texts are read, each by itself, without a shuffle.

Fitting takes a bounded sample: about ``SAMPLE_ROWS`` labelled rows of each label, chosen by
digest, weighted back to their true share. The lexicon is counted on the sample in Spark; a
term needs ``MIN_SUPPORT`` toxic texts, and the ``LEXICON_TERMS`` best by support are kept.
Sample rows are dealt into ``FOLDS``; a row's features use the lexicon of the other folds,
and its calibration score the trees of the other folds, so neither has seen it. Features of
the sample, some 30 numbers a row, are what the driver gets.

Defined results: a null text counts as empty; an empty one is scored like any other, and all
of its features are 0. Rows with a null text, label or id are not learnt from; a label above
0 is toxic, and a document with several labels is toxic if one is. Without labelled rows
every score is 0, with labels of one kind only it is 0 or 1. Equal texts get equal scores.
Columns named like a result are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import col, fresh
from textmill.session import cut

# Words of abuse, of threat, and of address, in the four languages of the corpus.
ABUSE = frozenset(
    "idiot idiots moron morons stupid dumb fool fools loser losers trash garbage scum worthless pathetic disgusting clown "
    "clowns jerk creep coward liar vermin filth ugly imbecile cretin dimwit halfwit bastard bitch asshole shit crap fuck "
    "fucking damn hate despise "
    "dumm dummkopf idioten trottel depp arschloch scheisse abschaum wertlos ekelhaft versager blödmann hässlich hass "
    "idiote imbécile crétin stupide nul ordure connard salaud merde ignoble minable déchet haine laid "
    "estúpido estúpida imbécil idiota basura inútil asqueroso patético payaso mierda cabrón escoria odio feo".split()
)
THREAT = frozenset("kill die hurt hang shoot burn destroy töten sterben verletzen tuer mourir crève matar morir muere".split())
ADDRESS = frozenset(
    "you your yours yourself u ur du dich dir dein deine euch ihr tu te toi ton ta tes vous votre vos tú ti tus usted "
    "ustedes vosotros".split()
)
SAMPLE_ROWS = 6000
MIN_SUPPORT = 3
LEXICON_TERMS = 4000
MIN_LOG_ODDS = 1.0
#: Lengths of the beginnings of words that are terms too.
STEMS = (4, 6, 8)
FOLDS = 4
NEAR = 5
THRESHOLD = 0.7

_WORD = re.compile(r"[^\W\d_]+")
#: Cheap signs that a disguise may be there, and the disguises, anchored so that no letter starts two attempts.
_SIGN_INSIDE = re.compile(r"[@$*!|+#0-9](?=[^\W\d_])")
_MASKED = re.compile(r"(?<![^\W\d_])[^\W\d_]+(?:[@$*!|+#0-9]+[^\W\d_]+)+")
_APART = re.compile(r"(?<![^\W_])[^\W\d_](?:[ .*_-][^\W\d_](?![^\W_])){3,}")
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
_LOUD = re.compile(r"[!?]{2,}")
_SIGNS = "#$%&*@^~|"
_UNMASK = str.maketrans({"@": "a", "$": "s", "!": "i", "|": "l", "+": "t", "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "*": "", "#": ""})
_TIGHT = str.maketrans("", "", " .*_-")

FEATURES = [
    "abuse_rate", "abuse_count", "threat_rate", "learnt_rate", "learnt_count", "learnt_weight", "learnt_most", "stem_rate",
    "stem_weight", "stem_most", "address_rate", "near_rate", "near_count", "capital_rate", "shout_rate", "bang_rate", "ask_rate", "loud_rate",
    "sign_rate", "masked_rate", "apart_rate", "stretched_rate", "disguised_hits", "word_length", "words",
]


class Lexicon(NamedTuple):
    """Learnt log-odds of words and, by length, of the beginnings of words."""

    words: dict[str, float]
    stems: dict[int, dict[str, float]]


def _undisguised(lower: str, words: list[str]) -> tuple[int, int, int, list[str]]:
    """How many words have signs inside, letters apart, letters stretched; and how they may read without."""
    masked = _MASKED.findall(lower) if _SIGN_INSIDE.search(lower) else []
    apart = [m.group() for m in _APART.finditer(lower)]
    stretched = [w for w in words if _TRIPLE.search(w)] if _TRIPLE.search(lower) else []
    plain = [w.translate(_UNMASK) for w in masked] + [w.translate(_TIGHT) for w in apart]
    plain += [re.sub(r"(.)\1\1+", keep, w) for w in stretched for keep in (r"\1", r"\1\1")]
    return len(masked), len(apart), len(stretched), plain


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """The numbers named in ``FEATURES``. Different words are met with the lists first, since most texts share none."""
    text = text or ""
    lower = text.lower()
    words = _WORD.findall(lower)
    different = set(words)
    n, chars = max(1, len(words)), max(1, len(text))
    abusive, learnt = different & ABUSE, {w: lexicon.words[w] for w in different & lexicon.words.keys()}
    threatening, addressing = different & THREAT, different & ADDRESS
    begun: dict[str, float] = {}
    for size, stems in lexicon.stems.items():
        heads = {w[:size] for w in different}.intersection(stems)
        for w in [w for w in different if w[:size] in heads] if heads else ():
            begun[w] = max(begun.get(w, 0.0), stems[w[:size]])
    marked = abusive | learnt.keys() | threatening | addressing | begun.keys()
    met = [(i, w) for i, w in enumerate(words) if w in marked] if marked else []
    abuse, hits = [i for i, w in met if w in abusive], [i for i, w in met if w in abusive or w in learnt]
    weights, stem_weights = [learnt[w] for _, w in met if w in learnt], [begun[w] for _, w in met if w in begun]
    threat, address, near = sum([w in threatening for _, w in met]), [i for i, w in met if w in addressing], 0
    if address:
        for i in hits:
            at = bisect_left(address, i)
            near += min([abs(i - p) for p in address[max(0, at - 1) : at + 1]]) <= NEAR
    capitals = _CAPITALS.findall(text)
    bangs, asks = text.count("!"), text.count("?")
    loud = len(_LOUD.findall(text)) if bangs + asks > 1 else 0
    masked, apart, stretched, plain = _undisguised(lower, words)
    undone = sum([w in ABUSE or w in lexicon.words for w in plain])
    return [
        len(abuse) / n, math.log1p(len(abuse)), threat / n, len(weights) / n, math.log1p(len(weights)), sum(weights) / n,
        max(weights, default=0.0), len(stem_weights) / n, sum(stem_weights) / n, max(stem_weights, default=0.0), len(address) / n,
        near / n, math.log1p(near), sum(map(len, capitals)) / chars, sum([len(c) > 2 for c in capitals]) / n, bangs / chars,
        asks / chars, loud / chars, sum([text.count(s) for s in _SIGNS]) / chars, masked / n, apart / n, stretched / n,
        math.log1p(undone), sum(map(len, words)) / n, math.log1p(len(words)),
    ]


class Trees(NamedTuple):
    """Complete trees of one depth, laid end to end: splits in heap order, then leaf values."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        total, rows, splits = np.full(len(x), self.base), np.arange(len(x)), self.feature.shape[1]
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            while len(x) and node[0] < splits:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - splits]
        return total


def boost(x: np.ndarray, y: np.ndarray, w: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 32, ridge: float = 1.0) -> Trees:
    """Trees for the weighted log loss, from second-order histograms over quantile bins."""
    n, d = x.shape
    w = w / w.mean()
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    # Rare features: between zero and the smallest other value there must be a cut.
    cuts = [np.unique(np.append(c, 0.0)) if (x[:, j] > 0).any() else c for j, c in enumerate(cuts)]
    width = max(len(c) for c in cuts) + 1
    binned = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(d)], axis=1)
    edges = np.full((d, width), np.inf)
    for j, c in enumerate(cuts):
        edges[j, : len(c)] = c
    share = np.clip((w * y).sum() / w.sum(), 1e-6, 1 - 1e-6)
    margin = np.full(n, math.log(share / (1 - share)))
    splits, cell = 2**depth - 1, binned + np.arange(d) * width
    feature, threshold, value = np.zeros((rounds, splits), np.int64), np.full((rounds, splits), np.inf), np.zeros((rounds, 2**depth))
    for r in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = w * (p - y), w * p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            at = (cell + (node - first)[:, None] * d * width).ravel()
            g = np.bincount(at, np.repeat(grad, d), many * d * width).reshape(many, d, width).cumsum(axis=2)
            h = np.bincount(at, np.repeat(hess, d), many * d * width).reshape(many, d, width).cumsum(axis=2)
            gt, ht = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (gt - g) ** 2 / (ht - h + ridge) - gt**2 / (ht + ridge)
            gain[~np.isfinite(edges)[None].repeat(many, 0)] = -np.inf
            best = gain.reshape(many, -1).argmax(axis=1)
            useful = gain.reshape(many, -1)[np.arange(many), best] > 1e-9
            feature[r, first : first + many] = best // width
            threshold[r, first : first + many] = np.where(useful, edges[best // width, best % width], np.inf)
            node = 2 * node + 1 + (x[np.arange(n), feature[r, node]] > threshold[r, node])
        leaf = node - splits
        value[r] = -rate * np.bincount(leaf, grad, 2**depth) / (np.bincount(leaf, hess, 2**depth) + ridge)
        margin += value[r, leaf]
    return Trees(math.log(share / (1 - share)), feature, threshold, value)


def isotonic(score: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising step function that is closest to ``y``: pools of violators, adjacent ones merged."""
    at, place = np.unique(score, return_inverse=True)
    pools: list[list[float]] = []
    # Equal scores are one pool from the start.
    for s, total, weight in zip(at, np.bincount(place, y * w), np.bincount(place, w)):
        pools.append([s, s, total, weight])
        while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
            _, stop, total, weight = pools.pop()
            pools[-1][1:] = [stop, pools[-1][2] + total, pools[-1][3] + weight]
    knots = [(at, p[2] / p[3]) for p in pools for at in dict.fromkeys(p[:2])]
    return np.array([k[0] for k in knots]), np.array([k[1] for k in knots])


class Model(NamedTuple):
    lexicon: Lexicon
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray]

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.trees is None or not texts:
            return np.full(len(texts), self.knots[1][0])
        margin = self.trees.margin(np.array([features(t, self.lexicon) for t in texts]))
        return np.clip(np.interp(margin, *self.knots), 0.0, 1.0)


def _lexicon(counts: pd.DataFrame, fold: int | None) -> Lexicon:
    """Terms whose log-odds are high in all folds but one."""
    used = [k for k in range(FOLDS) if k != fold]
    toxic, clean = counts[[f"t{k}" for k in used]].sum(axis=1), counts[[f"c{k}" for k in used]].sum(axis=1)
    whole = counts["term"] == ""
    if not whole.any():
        return Lexicon({}, {})
    all_toxic, all_clean = max(1.0, toxic[whole].sum()), max(1.0, clean[whole].sum())
    odds = np.log((toxic + 0.5) / (all_toxic + 1)) - np.log((clean + 0.5) / (all_clean + 1))
    kept = counts[(toxic >= MIN_SUPPORT) & (odds >= MIN_LOG_ODDS) & ~whole].assign(odds=odds)
    stems, words = kept[kept["stem"]], kept[~kept["stem"]]
    by_length = {k: stems[stems["term"].str.len() == k] for k in STEMS}
    return Lexicon(dict(zip(words["term"], words["odds"])), {k: dict(zip(p["term"], p["odds"])) for k, p in by_length.items()})


def _count_terms(sample: DataFrame) -> pd.DataFrame:
    """Toxic and clean sample texts per term and fold; at most ``LEXICON_TERMS`` terms, and the texts as term ''."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))
    long = [F.filter(words, lambda w, k=k: F.length(w) >= k) for k in STEMS]
    stems = F.array_distinct(F.concat(*[F.transform(ws, lambda w, k=k: F.substring(w, 1, k)) for ws, k in zip(long, STEMS)]))
    terms = F.concat(
        F.transform(F.array_distinct(words), lambda w: F.struct(w.alias("term"), F.lit(False).alias("stem"))),
        F.transform(stems, lambda s: F.struct(s.alias("term"), F.lit(True).alias("stem"))),
        F.array(F.struct(F.lit("").alias("term"), F.lit(False).alias("stem"))),
    )
    rows = sample.select("toxic", "fold", "weight", F.explode(terms).alias("t"))
    counts = [
        F.sum(F.when(F.col("toxic").eqNullSafe(label) & (F.col("fold") == k), F.col("weight")).otherwise(0.0)).alias(f"{name}{k}")
        for name, label in (("t", True), ("c", False)) for k in range(FOLDS)
    ]
    table = rows.groupBy("t.term", "t.stem").agg(F.count_if("toxic").alias("support"), *counts)
    best = table.where((F.col("support") >= MIN_SUPPORT) | (F.col("term") == ""))
    return best.orderBy(F.desc(F.col("term") == ""), F.desc("support"), "term", "stem").limit(LEXICON_TERMS + 1).toPandas()


def _sample(rows: DataFrame, sample_rows: int, span: int) -> tuple[DataFrame, dict[bool, int]]:
    """About ``sample_rows`` rows of each label by their ``h`` below ``span``, with a ``weight``; and all rows' number."""
    counts = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {label: min(1.0, sample_rows / n) for label, n in counts.items()}
    rate = F.when(F.col("toxic"), F.lit(share.get(True, 1.0))).otherwise(F.lit(share.get(False, 1.0)))
    return rows.where(F.col("h") < rate * span).withColumn("weight", 1 / rate), counts


def fit(
    docs: DataFrame, labels: DataFrame, text_col: str = "text", label_col: str = "toxic", id_col: str = "doc_id",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """A model from about ``sample_rows`` documents of each label.

    Labels are sampled first, by a digest of their ids, so that only the bounded sample
    is broadcast to the documents and no text is shuffled. Documents that share an id are
    sampled once more, by their text, should they exceed the bound.
    """
    span = 1 << 32
    ids = col(id_col).cast("string")
    known = labels.where(col(id_col).isNotNull() & col(label_col).isNotNull())
    one = known.groupBy(ids.alias("id")).agg((F.max(col(label_col).cast("double")) > 0).alias("toxic"))
    one = cut(one.withColumn("h", F.pmod(F.xxhash64("id"), F.lit(span))), "labels")
    chosen, first = _sample(one, sample_rows, span)
    rows = docs.where(col(text_col).isNotNull()).select(ids.alias("id"), col(text_col).alias("text"))
    found = rows.join(F.broadcast(chosen.drop("h")), "id")
    key = F.xxhash64("id", "text")
    table = cut(found.select("text", "toxic", "weight", key.alias("key"), F.pmod(key, F.lit(span)).alias("h")), "labelled")
    again, counts = _sample(table.withColumnRenamed("weight", "before"), sample_rows, span)
    if len(counts) < 2:
        return Model(Lexicon({}, {}), None, (np.array([0.0]), np.array([1.0 if counts.get(True) else 0.0])))
    chosen = again.select(
        "text", "toxic", (F.col("before") * F.col("weight")).alias("weight"), F.col("key").alias("h"),
        F.pmod(F.shiftright("key", 33), F.lit(FOLDS)).cast("int").alias("fold"),
    )
    sample = cut(chosen, "labelled")
    counted = _count_terms(sample)
    lexicons = [_lexicon(counted, k) for k in range(FOLDS)]

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            values = [features(t, lexicons[k]) for t, k in zip(part["text"], part["fold"])]
            yield part[["h", "toxic", "weight", "fold"]].assign(x=values)

    table = sample.mapInPandas(batches, "h bigint, toxic boolean, weight double, fold int, x array<double>").orderBy("h").toPandas()
    x, y, w, fold = np.stack(table["x"].to_numpy()), table["toxic"].to_numpy(float), table["weight"].to_numpy(), table["fold"].to_numpy()
    held = np.zeros(len(y))
    for k in range(FOLDS):
        if (fold == k).any() and (fold != k).any():
            held[fold == k] = boost(x[fold != k], y[fold != k], w[fold != k]).margin(x[fold == k])
    return Model(_lexicon(counted, None), boost(x, y, w), isotonic(held, y, w))


def score(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score double`` and ``predicted int``, 1 from ``threshold`` on."""

    def batches(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series(model.score(texts.tolist()))

    extra = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    (found,) = fresh(docs, "found")
    # Non-deterministic for the planner only, so that a filter on the result does not score every text twice.
    udf = F.pandas_udf(batches, "double").asNondeterministic()
    scored = docs.select(*[col(c) for c in extra], udf(col(text_col)).alias(found))
    return scored.select(*[col(c) for c in extra], F.col(found).alias("score"), (F.col(found) >= threshold).cast("int").alias("predicted"))

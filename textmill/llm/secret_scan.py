"""Secrets: three patterns, and runs of characters that look random.

Two first-order Markov chains over characters, one of random strings and one of
ordinary identifiers, are trained from a labelled table. A run of at least
``MIN_LENGTH`` token characters is a secret when the mean log-likelihood ratio of its
character pairs is above ``threshold``, over the run or over any ``MIN_LENGTH``
neighbouring characters, so that a key joined to a long path or name counts too. The
span is the whole run. Runs that touch a pattern's match add nothing.

Everything is a column expression: no shuffle, no Python. A model has one number
per pair of known characters (``ALPHABET`` and one class for all others), so it is
bounded and travels inside the plan.

Spans count code points, ends exclusive. Defined results: a null or empty text has
no spans; equal rows are scanned each for itself; an empty table gives an empty
result; a model trained on an empty table finds no runs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import col, fresh, prefix_sums, text_or_empty

#: kind: (pattern, pattern whose first group of the match is measured, fewest characters of it)
PATTERNS = {
    "assign": (
        r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
        r"""^(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$""",
        6,
    ),
    # Runs that are too short can hold no longer match, so the length goes into the pattern.
    "access": (r"AKIA[A-Z0-9]{16,}", None, 20),
    "hex": (r"[0-9a-f]{24,}", None, 24),
}
RUN = r"[A-Za-z0-9+/_=-]{20,}"
MIN_LENGTH = 20
THRESHOLD = 0.5

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
OTHER = len(ALPHABET)
CLASSES = OTHER + 1
#: Class of every code point below 128.
CLASS_OF = [ALPHABET.index(chr(c)) if chr(c) in ALPHABET else OTHER for c in range(128)]


def _array(values: list, kind: str) -> Column:
    return F.expr(f"array({', '.join(f'CAST({v} AS {kind})' if v != v // 1 or kind != 'INT' else str(v) for v in values)})")


def _classes(text: Column) -> Column:
    """Class numbers of a text's characters; one split, linear in its length."""
    table = F.expr(f"array({', '.join(map(str, CLASS_OF))})")
    return F.transform(F.split(text, ""), lambda c: F.coalesce(F.get(table, F.ascii(c)), F.lit(OTHER)))


def pair_classes(text: Column) -> Column:
    """The pairs of neighbouring characters as one number each."""

    def pairs(codes: Column) -> Column:
        return F.zip_with(codes, F.slice(codes, F.lit(2), F.greatest(F.size(codes) - 1, F.lit(0))), lambda a, b: a * CLASSES + b)

    # zip_with pads the shorter side with a null: the last character has no successor.
    return F.filter(F.transform(F.array(_classes(text)), pairs)[0], lambda x: x.isNotNull())


def train(samples: DataFrame, text_col: str = "text", random_col: str = "is_random", smoothing: float = 0.5) -> list[float]:
    """Log-likelihood ratio of every pair of classes, random over ordinary.

    Collects one row per pair and label, at most ``2 * CLASSES**2``.
    """
    pairs = samples.where(col(text_col).isNotNull() & col(random_col).isNotNull()).select(
        col(random_col).cast("boolean").alias("r"), F.explode(pair_classes(col(text_col))).alias("pair")
    )
    counts: dict[bool, dict[int, int]] = {True: {}, False: {}}
    for row in pairs.groupBy("r", "pair").count().collect():
        counts[row["r"]][row["pair"]] = row["count"]
    if not counts[True] or not counts[False]:
        return []

    def log_chain(seen: dict[int, int]) -> list[float]:
        table = []
        for a in range(CLASSES):
            row = [seen.get(a * CLASSES + b, 0) + smoothing for b in range(CLASSES)]
            table += [math.log(x / sum(row)) for x in row]
        return table

    return [round(r - o, 6) for r, o in zip(log_chain(counts[True]), log_chain(counts[False]))]


def log_ratio(text: Column, model: list[float]) -> Column:
    """Mean log-likelihood ratio of a text's pairs; null below two characters."""
    if not model:
        return F.lit(None).cast("double")
    table = F.expr(f"array({', '.join(f'{x:.6f}D' for x in model)})")
    return F.transform(
        F.array(pair_classes(text)),
        lambda p: F.when(F.size(p) > 0, F.aggregate(p, F.lit(0.0), lambda acc, x: acc + F.get(table, x)) / F.size(p)),
    )[0]


def best_log_ratio(text: Column, model: list[float], width: int = MIN_LENGTH) -> Column:
    """The highest mean log-likelihood ratio over the whole text or ``width`` neighbouring
    characters of it; null below two characters. One fold, linear in the length."""
    if not model:
        return F.lit(None).cast("double")
    # Whole millionths, as the model is rounded: a sliding sum of them does not drift.
    table = F.expr(f"array({', '.join(f'{round(x * 1e6)}L' for x in model)})")
    pairs, zero = width - 1, F.lit(0).cast("bigint")
    start = F.struct(zero.alias("n"), zero.alias("all"), zero.alias("s"), F.lit(None).cast("double").alias("best"))

    def best(scores: Column) -> Column:
        left = F.slice(F.concat(F.array_repeat(zero, pairs), scores), F.lit(1), F.size(scores))
        steps = F.zip_with(scores, left, lambda x, y: F.struct(x.alias("x"), (x - y).alias("d")))

        def add(acc: Column, step: Column) -> Column:
            full = F.when(acc["n"] + 1 >= pairs, (acc["s"] + step["d"]) / pairs)
            return F.struct(
                (acc["n"] + 1).alias("n"), (acc["all"] + step["x"]).alias("all"), (acc["s"] + step["d"]).alias("s"), F.greatest(acc["best"], full).alias("best")
            )

        return F.when(F.size(scores) > 0, F.aggregate(steps, start, add, lambda acc: F.greatest(acc["best"], acc["all"] / acc["n"]) / 1e6))

    return F.transform(F.array(F.transform(pair_classes(text), lambda p: F.get(table, p))), best)[0]


def _spans(text: Column, pattern: str, keep) -> Column:
    """``array<struct<match, start, end>>`` of a pattern's matches that ``keep`` holds.

    What lies between the matches gives their places: splitting finds the same
    matches in the same order.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), 0)

    def placed(m: Column) -> Column:
        sizes = F.transform(m, lambda x: F.char_length(x).cast("bigint"))
        gaps = F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x).cast("bigint"))
        before = F.concat(F.array(F.lit(0).cast("bigint")), sizes)
        steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(m)), F.slice(before, F.lit(1), F.size(m)), lambda a, b: a + b)
        spans = F.zip_with(m, prefix_sums(steps), lambda x, s: F.struct(x.alias("match"), s.alias("start"), (s + F.char_length(x)).alias("end")))
        return F.filter(spans, lambda s: keep(s["match"]))

    none = F.array().cast("array<struct<match:string,start:bigint,end:bigint>>")
    # The match list is computed once and bound to a name; texts without a match stop there.
    return F.transform(F.array(found), lambda m: F.when(F.size(m) > 0, placed(m)).otherwise(none))[0]


def _marked(spans: Column, rank: int, kind: str) -> Column:
    return F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"))
    )


def scan(docs: DataFrame, model: list[float], text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``secrets array<struct<start, rank, end, kind>>`` in order of start, then
    kind: ``assign``, ``access``, ``hex``, and ``random`` for what the chains add."""
    (runs, base) = fresh(docs, "runs", "base")
    text = text_or_empty(text_col)
    kinds = []
    for rank, (kind, (pattern, inner, least)) in enumerate(PATTERNS.items()):
        long = lambda m, i=inner, n=least: F.char_length(m if i is None else F.regexp_extract(m, i, 1)) >= n
        kinds.append(_marked(_spans(text, pattern, long), rank, kind))

    def random(m: Column) -> Column:
        return F.coalesce(best_log_ratio(m, model) > threshold, F.lit(False))

    added = _marked(_spans(text, RUN, random), len(PATTERNS), "random")
    kept = [c for c in docs.columns if c.lower() != "secrets"]
    rows = docs.select(*[col(c) for c in kept], F.concat(*kinds).alias(base), added.alias(runs))
    new = F.filter(F.col(runs), lambda r: ~F.exists(F.col(base), lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    return rows.select(*[col(c) for c in kept], F.array_sort(F.concat(F.col(base), new)).alias("secrets"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def labelled_samples(docs: DataFrame, id_col: str, text_col: str, rows: int = 300, words: int = 40) -> DataFrame:
    """``(text, is_random)`` out of at most ``rows`` documents that have words, and ``words`` different
    words of each, both the first by digest: of id and text, and of the word, wherever in the text it stands.

    Ordinary are the words, alone and joined as identifiers are; random is the
    base64 and hexadecimal form of the words' digests. Repeated rows count once; null ids are an id.
    """
    # The sample is a documented bound of the classifier; the scan covers every row.
    text, span = text_or_empty(text_col), 1 << 32
    keyed = docs.select(F.xxhash64(col(id_col).cast("string")).alias("o"), F.xxhash64(text).alias("t"), text.alias("text")).where(text.rlike("[A-Za-z0-9]{3}"))
    # By a share of the digests first, so that what is sorted does not grow with the table.
    share = min(1.0, 4.0 * rows / max(1, docs.count()))
    drawn = keyed.where(F.pmod(F.xxhash64("o", "t"), F.lit(span)) < share * span).dropDuplicates(["o", "t"]).orderBy("o", "t").limit(rows)
    different = F.array_distinct(F.filter(F.split("text", r"[^A-Za-z0-9]+"), lambda w: F.char_length(w) > 2))
    ranked = F.array_sort(F.transform(different, lambda w: F.struct(F.xxhash64(w).alias("h"), w.alias("w"))))
    some = drawn.select(F.slice(ranked["w"], 1, words).alias("w"))
    lists = some.withColumn("raw", F.transform("w", lambda x: F.unhex(F.sha2(x, 256))))
    ordinary = lists.select(F.explode(F.concat(
        F.col("w"), F.array(F.array_join("w", "_"), F.array_join("w", "-"), F.array_join(F.transform("w", F.initcap), ""), F.array_join(F.transform("w", F.upper), "_"), F.array_join("w", "/")),
    )).alias("text"))
    random = lists.select(F.explode(F.concat(
        F.transform("raw", lambda r: F.translate(F.base64(r), "=\r\n", "")), F.transform("raw", lambda r: F.lower(F.hex(r))),
    )).alias("text"))
    return ordinary.withColumn("is_random", F.lit(False)).unionByName(random.withColumn("is_random", F.lit(True)))

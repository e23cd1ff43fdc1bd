"""Integer character and word n-grams, computed in generated code.

A gram is an integer rather than a string: the code points of its characters
are combined by a fixed multilinear hash modulo 2^31 - 1. The grams of a text
come from exploding its start positions, so the arithmetic runs in whole-stage
code and a following aggregation by document combines before the shuffle.

Grams of words are MD5 numbers. Where whole tables of texts are hashed, Arrow batches of
lower-cased texts go through ``word_grams``, which gives the same integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.md5 import BLOCK, FITS, md5_heads

# The Mersenne prime and the multiplier of the "minimal standard"
# Lehmer generator, from which every other coefficient follows.
MERSENNE31 = 2**31 - 1
LEHMER = 48271


def lehmer_sequence(count: int, seed: int) -> list[int]:
    """``count`` coefficients in [1, 2^31 - 2]."""
    values, state = [], seed
    for _ in range(count):
        state = state * LEHMER % MERSENNE31
        values.append(state)
    return values


def remainder() -> Callable[[np.ndarray], np.ndarray]:
    """A function to the remainders by 2^31 - 1 of unsigned numbers below 2^61, without a division.

    The two parts of a number have its remainder as their sum, less the prime where that is not below
    zero. The helper is built here, so it travels to the executors by value.
    """
    modulus, shift = np.uint64(MERSENNE31), np.uint64(31)

    def remainders(numbers: np.ndarray) -> np.ndarray:
        parts = numbers >> shift
        parts += numbers & modulus
        return np.minimum(parts, parts - modulus, out=parts)

    return remainders


GRAM_SEED = 20011
# Word grams that numpy handles at a time.
PIECE = 1 << 12


def gram_multipliers(n: int) -> list[int]:
    return lehmer_sequence(n, GRAM_SEED)


def code_points(text: Column) -> Column:
    return F.transform(F.split(text, ""), F.ascii)


def _combine(points: Column, start: Column, n: int) -> Column:
    terms = [F.get(points, start + k) * F.lit(m).cast("bigint") for k, m in enumerate(gram_multipliers(n))]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total % F.lit(MERSENNE31).cast("bigint")


def words(text: Column) -> Column:
    """Lower-cased, split at every whitespace character, trailing empties gone."""
    return F.split(F.regexp_replace(F.lower(text), r"(?<!\s)\s++$", ""), r"\s")


def word_grams(n: int) -> Callable[[pa.Array], Iterator[tuple[np.ndarray, np.ndarray]]]:
    """A function from lower-cased texts to ``(row, gram)`` arrays, row by row, some ``PIECE`` grams at a time.

    Words are those of ``words``, whose pattern also drops blanks before a line end of another
    kind at a text's end. The helper is built here, so it travels to the executors by value.
    """
    heads, md5, piece, fits, block = md5_heads(), hashlib.md5, PIECE, FITS, BLOCK
    blanks, ends_of_line = b" \t\n\x0b\f\r", tuple(c.encode() for c in "\u0085\u2028\u2029")
    spaced = bytes.maketrans(blanks, b" " * len(blanks))

    def bare(line: bytes) -> bytes:
        last = next((c for c in ends_of_line if line.endswith(c)), b"")
        return line.removesuffix(last).rstrip(blanks).translate(spaced) + last

    def hashed(held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        rows, texts, starts, sizes = zip(*held)
        counts = [len(s) for s in starts]
        begins = np.cumsum([0, *map(len, texts)])[:-1]
        data = np.concatenate([*texts, np.zeros(block, np.uint8)])
        starts, sizes = np.concatenate(starts) + np.repeat(begins, counts), np.concatenate(sizes)
        found = heads(data, starts, np.minimum(sizes, fits))
        for i in np.flatnonzero(sizes > fits):
            digest = md5(data[starts[i] : starts[i] + sizes[i]].tobytes()).digest()
            found[i] = int.from_bytes(digest[:4], "big")
        # The first seven hexadecimal digits of every digest.
        return np.repeat(rows, counts), (found >> np.uint32(4)).astype(np.int64)

    def grams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        held, size = [], 0
        for row, line in enumerate(texts):
            if not line.is_valid:
                continue
            text = np.frombuffer(bare(line.as_buffer().to_pybytes()), np.uint8)
            bounds = np.concatenate(([-1], np.flatnonzero(text == ord(" ")), [len(text)]))
            for at in range(0, len(bounds) - n, piece):
                ends = bounds[at + n : at + n + piece]
                starts = bounds[at : at + len(ends)] + 1
                held.append((row, text[starts[0] : ends[-1]], starts - starts[0], ends - starts))
                size += len(ends)
                if size >= piece:
                    yield hashed(held)
                    held, size = [], 0
        if held:
            yield hashed(held)

    return grams


def char_grams(n: int) -> Callable[[pa.Array], Iterator[tuple[np.ndarray, np.ndarray]]]:
    """The same of characters: the integers of ``explode_grams``. The helper is built here, so it travels by value."""
    multipliers, modulus = gram_multipliers(n), MERSENNE31

    def grams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for row, line in enumerate(texts):
            if not line.is_valid:
                continue
            # An empty text is split into one empty character, whose code point is 0.
            points = np.frombuffer((line.as_py() or "\0").encode("utf-32-le"), np.uint32).astype(np.int64)
            count = len(points) - n + 1
            if count > 0:
                yield np.full(count, row), sum(points[k : k + count] * m for k, m in enumerate(multipliers)) % modulus

    return grams


def _word_gram(parts: Column, start: Column, n: int) -> Column:
    gram = F.concat_ws(" ", *[F.get(parts, start + k) for k in range(n)])
    return F.conv(F.substring(F.md5(gram), 1, 7), 16, 10).cast("bigint")


def explode_grams(df: DataFrame, keep: list[str], text: Column, n: int, unit: str = "char") -> DataFrame:
    """One row ``(*keep, h)`` per n-gram; texts shorter than ``n`` units give no row."""
    if unit == "char":
        source, gram = code_points(F.lower(text)), _combine
    elif unit == "word":
        source, gram = words(text), _word_gram
    else:
        raise ValueError(f"unit must be 'char' or 'word', not {unit!r}")
    parts = df.select(*keep, source.alias("_parts"))
    # No filter on the size: it would be pushed below and cut every text twice.
    positions = F.when(F.size("_parts") >= n, F.sequence(F.lit(0), F.size("_parts") - n))
    starts = parts.select(*keep, "_parts", F.explode(positions).alias("_start"))
    return starts.select(*keep, gram(F.col("_parts"), F.col("_start"), n).alias("h"))


def gram_set(text: Column, n: int, unit: str = "char") -> Column:
    """The distinct grams of one text as an array, without a shuffle."""
    if unit == "char":
        parts, gram = code_points(F.lower(text)), _combine
    else:
        parts, gram = words(text), _word_gram
    grams = F.transform(
        F.array(parts),
        lambda p: F.when(
            F.size(p) >= n,
            F.transform(F.sequence(F.lit(0), F.size(p) - n), lambda i: gram(p, i, n).cast("int")),
        ),
    )
    return F.array_distinct(F.get(grams, F.lit(0)))

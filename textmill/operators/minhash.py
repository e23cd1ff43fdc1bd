"""MinHash signatures and LSH bands."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.functions.grams import MERSENNE31, explode_grams, lehmer_sequence, remainder, word_grams

# Fixed values of the near-duplicate contract.
NGRAM_SIZE = 5
NUM_HASHES = 24
BANDS = 8
ROWS = 3
THRESHOLD = 0.5
HASH_SEED = 42


def hash_coefficients(num_hashes: int = NUM_HASHES) -> list[tuple[int, int]]:
    """Pairs ``(a, b)`` of the hash family ``(a * h + b) mod (2^31 - 1)``."""
    values = lehmer_sequence(2 * num_hashes, HASH_SEED)
    return list(zip(values[::2], values[1::2]))


def minhash_signature(
    df: DataFrame,
    id_col: str,
    text_col: str,
    n: int = NGRAM_SIZE,
    unit: str = "word",
    num_hashes: int = NUM_HASHES,
    keep: list[str] | None = None,
) -> DataFrame:
    """``(id, *keep, m0 .. m{k-1})`` for every document with at least one shingle.

    Grams of words are hashed over Arrow batches of texts, those of characters in exploded
    rows. The minima are plain aggregates: a document's grams lie in one task, so each
    document leaves it as a single row.
    """
    keys = [id_col, *(keep or [])]
    if unit == "word":
        minima = [F.min(f"m{i}").alias(f"m{i}") for i in range(num_hashes)]
        return _word_minima(df, keys, text_col, n, num_hashes).groupBy(*keys).agg(*minima)
    grams = explode_grams(df, keys, F.col(text_col), n, unit)
    minima = [
        F.min((F.col("h") * F.lit(a).cast("bigint") + F.lit(b).cast("bigint")) % F.lit(MERSENNE31).cast("bigint")).alias(
            f"m{i}"
        )
        for i, (a, b) in enumerate(hash_coefficients(num_hashes))
    ]
    return grams.groupBy(*keys).agg(*minima)


def _word_minima(df: DataFrame, keys: list[str], text_col: str, n: int, num_hashes: int) -> DataFrame:
    """``(*keys, m0 .. m{k-1})`` for every row with at least one gram of words."""
    grams, remainders, modulus = word_grams(n), remainder(), MERSENNE31
    coefficients = [(np.uint64(a), np.uint64(b)) for a, b in hash_coefficients(num_hashes)]
    texts = df.select(*keys, F.lower(text_col).alias("_text"))
    kinds = T.StructType([*texts.schema.fields[:-1], *[T.StructField(f"m{i}", T.LongType()) for i in range(num_hashes)]])

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            least = np.full((num_hashes, batch.num_rows), modulus, np.int64)
            for row, h in grams(batch.column("_text")):
                first = np.flatnonzero(np.diff(row, prepend=-1))
                of, h = row[first], h.astype(np.uint64)
                for held, (a, b) in zip(least, coefficients):
                    hashed = remainders(a * h + b).view(np.int64)
                    held[of] = np.minimum(held[of], np.minimum.reduceat(hashed, first))
            columns = [*batch.columns[:-1], *map(pa.array, least)]
            yield pa.RecordBatch.from_arrays(columns, names=kinds.names).filter(pa.array(least[0] < modulus))

    return texts.mapInArrow(batches, kinds)


def band_table(signatures: DataFrame, keep: list[str], bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(*keep, band, bucket)``: one row per document and band; equal buckets are candidates."""
    keys = F.array(
        *[F.xxhash64(F.lit(b), *[F.col(f"m{b * rows + r}") for r in range(rows)]) for b in range(bands)]
    )
    return signatures.select(*keep, F.posexplode(keys).alias("band", "bucket"))


def minhash_candidates(bands: DataFrame, id_col: str) -> DataFrame:
    """Buckets shared by two or more documents: ``(band, first_id, last_id, n_docs)``.

    The candidate relation is kept as buckets; listing its pairs would be
    quadratic in a bucket that a common template fills.
    """
    return (
        bands.groupBy("band", "bucket")
        .agg(F.min(id_col).alias("first_id"), F.max(id_col).alias("last_id"), F.count("*").alias("n_docs"))
        .where("n_docs > 1")
        .drop("bucket")
    )

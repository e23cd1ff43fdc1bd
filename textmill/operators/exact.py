"""Exact deduplication by text fingerprint."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.functions.bloom import FALSE_POSITIVES, MAX_BYTES, bloom_filter, bloom_size, might_contain
from textmill.session import cut


def exact_dedup(
    df: DataFrame, text_col: str, order_cols: list[str], false_positives: float = FALSE_POSITIVES, max_bytes: int = MAX_BYTES
) -> DataFrame:
    """One row per distinct text: the first by ``order_cols``, nulls last.

    Hashes of 8 bytes are counted first; those that repeat make a Bloom filter. Rows that
    miss it are alone with their text and stay where they are read; only the others, a
    ``false_positives`` share of single texts among them, are shuffled and ranked. A filter
    that would exceed ``max_bytes`` is not made, and every row is ranked.
    """
    hashed = F.xxhash64(text_col)
    repeated = cut(df.select(hashed.alias("h")).groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "repeated")
    n = repeated.count()
    if not n:
        return df
    words, hashes = bloom_size(n, false_positives)
    if words * 8 > max_bytes:
        return first_of_each(df, text_col, order_cols)
    held = cut(bloom_filter(repeated, "h", words, hashes), "bloom")
    maybe = might_contain(held, hashed, words, hashes)
    return df.where(~maybe).unionByName(first_of_each(df.where(maybe), text_col, order_cols))


def first_of_each(df: DataFrame, text_col: str, order_cols: list[str]) -> DataFrame:
    """The same by one shuffle of all rows.

    The rank filter is pushed below the shuffle as a per-partition group limit,
    so a text copied into a third of all rows leaves each task at most once.
    """
    fingerprint = Window.partitionBy("_fp").orderBy(*[F.col(c).asc_nulls_last() for c in order_cols])
    return (
        df.withColumn("_fp", F.md5(F.col(text_col)))
        .withColumn("_rank", F.row_number().over(fingerprint))
        .where("_rank = 1")
        .drop("_fp", "_rank")
    )


def dedup_compare(kept_a: DataFrame, kept_b: DataFrame, id_col: str) -> DataFrame:
    """How many ids two methods keep: ``n_a, n_b, n_both, only_a, only_b``."""
    a = kept_a.select(id_col, F.lit(1).alias("in_a"), F.lit(0).alias("in_b"))
    b = kept_b.select(id_col, F.lit(0).alias("in_a"), F.lit(1).alias("in_b"))
    marks = a.unionByName(b).groupBy(id_col).agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))
    return marks.agg(
        F.sum("in_a").alias("n_a"),
        F.sum("in_b").alias("n_b"),
        F.sum(F.col("in_a") * F.col("in_b")).alias("n_both"),
        F.sum(F.col("in_a") * (1 - F.col("in_b"))).alias("only_a"),
        F.sum(F.col("in_b") * (1 - F.col("in_a"))).alias("only_b"),
    )

"""Shingles: the n-gram sets whose overlap defines near duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions.grams import gram_set


def shingles(df: DataFrame, id_col: str, text_col: str, n: int = 5, unit: str = "word") -> DataFrame:
    """Long table ``(id, h)`` with each distinct shingle of a document once."""
    return df.select(F.col(id_col).alias("id"), F.explode(gram_set(F.col(text_col), n, unit)).alias("h"))


def shingle_profile(df: DataFrame, id_col: str, text_col: str, n: int = 5, unit: str = "word") -> DataFrame:
    """Per document: number of distinct shingles and checksums over them."""
    return (
        shingles(df, id_col, text_col, n, unit)
        .groupBy(F.col("id").alias(id_col))
        .agg(
            F.count("*").alias("n_shingles"),
            F.sum("h").alias("shingle_sum"),
            F.min("h").alias("shingle_min"),
            F.max("h").alias("shingle_max"),
        )
    )

"""Fixed-length hash tokenization."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the token contract.
MAX_LENGTH = 512
VOCAB_SIZE = 50000
PAD_ID = 0
# Letters, numbers and the underscore in any script.
WORD_PATTERN = r"[\p{L}\p{N}_]+"


def words_of(text: Column) -> Column:
    """All lower-cased words of a text; none for null."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD_PATTERN), F.lit(0))


def token_id(word: Column, vocab_size: int = VOCAB_SIZE) -> Column:
    """MD5-derived id in ``[1, vocab_size - 1]``; 0 is left for padding."""
    head = F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("bigint")
    return (head % (vocab_size - 1) + 1).cast("int")


def word_tokens(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row ``(id, pos, word)`` per word, ``pos`` from 0."""
    return df.select(id_col, F.posexplode(words_of(F.col(text_col))).alias("pos", "word"))


def token_ids(df: DataFrame, id_col: str, text_col: str, vocab_size: int = VOCAB_SIZE) -> DataFrame:
    """One row ``(id, pos, token)`` per word."""
    return word_tokens(df, id_col, text_col).select(id_col, "pos", token_id(F.col("word"), vocab_size).alias("token"))


def tokenize_fixed(
    df: DataFrame,
    id_col: str = "warc_id",
    text_col: str = "extracted_text",
    max_length: int = MAX_LENGTH,
    vocab_size: int = VOCAB_SIZE,
    pad_id: int = PAD_ID,
) -> DataFrame:
    """``(id, tokens, attention_mask)``: the first ``max_length`` word ids, padded, and their mask.

    Row-wise, so no shuffle. Only the words that survive the cut are hashed.
    """
    ids = df.select(
        id_col,
        F.transform(
            F.slice(words_of(F.col(text_col)), 1, max_length), lambda w: token_id(w, vocab_size)
        ).alias("_ids"),
    )
    used = F.size("_ids")
    return ids.select(
        id_col,
        F.concat("_ids", F.array_repeat(F.lit(pad_id).cast("int"), max_length - used)).alias("tokens"),
        F.concat(
            F.array_repeat(F.lit(1), used), F.array_repeat(F.lit(0), max_length - used)
        ).alias("attention_mask"),
    )


def token_stats(tokens: DataFrame, id_col: str = "warc_id") -> DataFrame:
    """One row: documents, real tokens, padded slots, full sequences, empty sequences."""
    real = F.aggregate("attention_mask", F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    per_doc = tokens.select(id_col, real.alias("n"), F.size("attention_mask").cast("bigint").alias("slots"))
    return per_doc.agg(
        F.count("*").alias("n_docs"),
        F.sum("n").alias("n_tokens"),
        F.sum(F.col("slots") - F.col("n")).alias("n_padding"),
        F.count_if(F.col("n") == F.col("slots")).alias("n_full"),
        F.count_if(F.col("n") == 0).alias("n_empty"),
    )

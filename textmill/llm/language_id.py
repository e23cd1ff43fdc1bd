"""Language identification by compression.

A language's model is a raw-content zstandard dictionary: text of that language.
A text is encoded with every dictionary, in blocks, and belongs to the language
that needs the fewest bytes. The margin is the share of bytes saved against the
second best; a text with too narrow a margin is rejected. Letters only are
encoded, lower-cased, so that digits and punctuation count for no language.

The dictionaries are fitted on a bounded sample: about ``sample_rows`` different
texts of each language and ``dict_bytes`` of them, to which each text gives a piece of equal
length from a place chosen by its digest, however long it is. They are what travels to the
executors; their number is that of the languages. Every row is scored by itself, without a shuffle.

Defined results: a null text and one without a letter is ``und`` with score 0 and
rejected. Equal sizes go to the language that sorts first and have score 0. With a single
language every text with a letter gets it, with score 1; with none all are ``und``.
Labels are used for fitting only; rows with a null text or label are left out there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import col, fresh

UNDETERMINED = "und"
DICT_BYTES = 1 << 16
SAMPLE_ROWS = 100
LEVEL = 6
BLOCK = 4096
#: Texts below this many bytes are encoded from several starts and at a level that finds
#: shorter matches, since one size is too coarse to tell.
SHORT = 512
SHORT_LEVEL = 12
STARTS = 8
MIN_MARGIN = 0.002

#: ASCII letters and all bytes of other characters stay, the rest become blanks.
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))

Model = list[tuple[str, bytes]]


def letters(text: str | None) -> bytes:
    """Lower-cased words, one blank between; empty when no character is a letter."""
    text = text or ""
    kept = b" ".join(text.lower().encode().translate(_LETTERS).split())
    if kept.isascii() or any(c.isalpha() for c in text):
        return kept
    return b""


def fit(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", dict_bytes: int = DICT_BYTES,
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """One dictionary per language, out of texts chosen by their digest.

    Collects a piece of about ``sample_rows`` texts a language, in all about twice ``dict_bytes``:
    the second half of a piece fills what short texts leave.
    """
    lang, digest = col(lang_col).cast("string").alias("lang"), F.xxhash64(col(text_col)).alias("h")
    rows = labelled.where(col(lang_col).isNotNull() & col(text_col).isNotNull() & (F.length(col(text_col)) > 0))
    different = rows.select(lang, digest).groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()
    span = 1 << 32
    wanted, piece, shares = F.lit(0).cast("bigint"), F.lit(0), {}
    for row in different:
        bound = min(span, span * sample_rows // max(1, row["n"]) + 1)
        shares[row["lang"]] = max(1, dict_bytes // max(1, min(row["n"], sample_rows)))
        wanted = F.when(F.col("lang") == row["lang"], F.lit(bound)).otherwise(wanted)
        piece = F.when(F.col("lang") == row["lang"], F.lit(2 * shares[row["lang"]])).otherwise(piece)
    start = F.pmod(F.xxhash64("h"), F.greatest(F.length("text") - piece, F.lit(0)) + 1) + 1
    rows = rows.select(lang, digest, col(text_col).cast("string").alias("text")).where(F.pmod("h", F.lit(span)) < wanted)
    chosen = rows.select("lang", "h", F.substring("text", start.cast("int"), piece).alias("text")).groupBy("lang", "h").agg(F.min("text").alias("text"))
    found: dict[str, list] = {}
    for row in chosen.collect():
        found.setdefault(row["lang"], []).append((row["h"], letters(row["text"])))
    model = []
    for name in sorted(found):
        pieces = [content for _, content in sorted(found[name]) if content]
        own = [content[: shares[name]] for content in pieces]
        rest = [content[shares[name] :] for content in pieces]
        content = b" ".join([c for c in own + rest if c])[:dict_bytes]
        if content:
            model.append((name, content))
    return model


@lru_cache(maxsize=256)
def _encoder(content: bytes, level: int) -> zstandard.ZstdCompressor:
    words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    words.precompute_compress(level=level)
    return zstandard.ZstdCompressor(level=level, dict_data=words, write_content_size=False, write_checksum=False, write_dict_id=False)


def _blocks(data: bytes) -> list[bytes]:
    if len(data) >= SHORT:
        return [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
    words = data.split(b" ")
    step = max(1, len(words) // STARTS)
    return [b" ".join(words[i:] + words[:i]) for i in range(0, len(words), step)]


def identify(text: str | None, model: Model, min_margin: float = MIN_MARGIN) -> tuple[str, float, bool]:
    """``(language, margin, rejected)`` of one text."""
    data = letters(text)
    if not data or not model:
        return UNDETERMINED, 0.0, True
    blocks, sizes = _blocks(data), []
    level = SHORT_LEVEL if len(data) < SHORT else LEVEL
    for name, content in model:
        encode = _encoder(content, level).compress
        sizes.append((sum([len(encode(b)) for b in blocks]), name))
    sizes.sort()
    margin = 1.0 if len(sizes) == 1 else 1.0 - sizes[0][0] / sizes[1][0]
    return sizes[0][1], margin, margin < min_margin


def predict(docs: DataFrame, model: Model, text_col: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """``docs`` with ``lang_pred string, score double, rejected boolean``."""

    def batches(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame([identify(t, model, min_margin) for t in batch], columns=["lang_pred", "score", "rejected"])

    results = ["lang_pred", "score", "rejected"]
    extra = [c for c in docs.columns if c.lower() not in results]
    (found,) = fresh(docs, "found")
    # Non-deterministic for the planner only, so that a filter on the result does not score every text twice.
    udf = F.pandas_udf(batches, "lang_pred string, score double, rejected boolean").asNondeterministic()
    return docs.select(*[col(c) for c in extra], udf(col(text_col)).alias(found)).select(
        *[col(c) for c in extra], *[F.col(found)[r].alias(r) for r in results]
    )

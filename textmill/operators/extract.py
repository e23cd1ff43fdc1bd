"""Main-text extraction and removal of text that a host repeats on its pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.markup import (
    HIDDEN_PATTERN,
    MARK_PATTERN,
    MAX_LINK_SHARE,
    decode_entities,
    folded,
    is_prose,
    marked_text,
    unmarked,
)


VISIBLE_PATTERN = r"[^\s\p{Z}]"


def _nonblank(df: DataFrame, others: list[str], text: Column, out: str) -> DataFrame:
    """``others`` and ``text`` where it has a visible character.

    The test sits inside a generator: as a filter it would be pushed below the
    projection and every text would be made twice.
    """
    kept = F.filter(F.array(text), lambda t: t.rlike(VISIBLE_PATTERN))
    return df.select(*others, F.explode(kept).alias(out))


def html_extract(
    df: DataFrame,
    html_col: str = "html_content",
    out: str = "extracted_text",
    max_link_share: float = MAX_LINK_SHARE,
) -> DataFrame:
    """``df`` with ``html_col`` replaced by its main text; pages without text are dropped.

    Comments and page furniture go, tables stay, blocks that are mostly links
    go. A page that this leaves without text (all of it in one form, a ``nav`` that
    is never closed) gives its whole visible text instead. Row-wise string functions
    only: no shuffle and no Python.
    """
    others = [c for c in df.columns if c != html_col]
    html = F.col(html_col)
    lines = (
        df.where(F.length(html_col) > 0)
        .select(*others, html_col, marked_text(html).alias("_t"))
        .select(*others, html_col, folded(decode_entities(F.col("_t"))).alias("_t"))
    )
    blocks = F.filter(F.split("_t", "\n"), lambda b: is_prose(b, max_link_share))
    text = F.get(F.transform(F.array(F.array_join(blocks, "\n")), unmarked), F.lit(0))
    whole = folded(F.regexp_replace(decode_entities(marked_text(html, HIDDEN_PATTERN)), MARK_PATTERN, ""))
    either = F.transform(F.array(text), lambda t: F.when(t.rlike(VISIBLE_PATTERN), t).otherwise(whole))
    return _nonblank(lines, others, F.get(either, F.lit(0)), out)


def repeated_blocks(df: DataFrame, host_col: str, text_col: str, min_pages: int) -> DataFrame:
    """``(host, block)`` hashes of the lines found on at least ``min_pages`` pages of a host.

    A line counts once per page and pages are combined before the shuffle, so a
    host or a line with a third of all pages costs one row per task.
    """
    lines = df.select(
        F.col(host_col).alias("host"),
        F.explode(F.array_distinct(F.split(text_col, "\n"))).alias("line"),
    )
    return (
        lines.groupBy("host", F.xxhash64("line").alias("block"))
        .agg(F.count("*").alias("n_pages"))
        .where(F.col("n_pages") >= min_pages)
        .select("host", "block")
    )


def boilerplate_filter(
    df: DataFrame, id_col: str, host_col: str, text_col: str, min_pages: int = 3
) -> DataFrame:
    """``df`` without the lines its hosts repeat; pages left without text are dropped.

    Only hashes are exploded and joined. The hits of a page come back as one
    small array, so the page texts are shuffled once, by page id.
    """
    repeated = repeated_blocks(df, host_col, text_col, min_pages)
    lines = df.select(
        F.col(id_col).alias("_id"),
        F.col(host_col).alias("host"),
        F.explode(F.array_distinct(F.transform(F.split(text_col, "\n"), lambda b: F.xxhash64(b)))).alias("block"),
    )
    hits = lines.join(repeated, ["host", "block"], "left_semi").groupBy("_id").agg(F.collect_list("block").alias("_hits"))
    joined = df.join(hits, F.col(id_col) == F.col("_id"), "left")
    kept = F.filter(F.split(text_col, "\n"), lambda b: ~F.array_contains("_hits", F.xxhash64(b)))
    text = F.when(F.col("_hits").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    others = [c for c in df.columns if c != text_col]
    return _nonblank(joined, others, text, text_col).select(*df.columns)

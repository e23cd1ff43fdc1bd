"""Main text of a page by its element tree.

A page becomes one row per tag and piece of text. Elements are matched by prefix sums over
those rows, per element name: an opening tag at depth ``d`` of its name ends at the first
closing tag of the name that goes back to ``d - 1``. A closing tag without an opening one is
ignored, and so is an opening tag that is never closed: its content belongs to what
encloses it. Elements may overlap where tags are mis-nested; each one's extent is
defined all the same, and an element's parent is the last one opened before it whose
extent holds its opening tag.

Every row has a weight: a piece of text its visible characters, less if it is link text; a
tag costs some. The weight of a subtree is the difference of one more prefix sum at its
ends, and the page's text is that of the block element that weighs most: a menu adds links
and tags, an article adds text.

A page's rows lie in one partition after a single shuffle; what follows are sorts there. A
page of a megabyte is some hundred thousand rows, whatever its nesting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.functions.markup import BLOCK_ELEMENTS, DROPPED_ELEMENTS, HIDDEN_PATTERN, decode_entities, folded
from textmill.operators.extract import VISIBLE_PATTERN

TOKEN_PATTERN = r"<[A-Za-z/!?][^<>]*>|[^<]+|<"
NAME_PATTERN = r"^</?([A-Za-z][A-Za-z0-9]*)"
# Elements that never have content.
VOID_ELEMENTS = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
#: Elements that may be a page's main text.
CONTAINERS = ["html", "body", "main", "article", "section", "div", "td", "blockquote"]
#: Partitions of the tokens for every split of the pages, which they exceed many times.
SPLIT_PARTS = 16
LINK_WEIGHT = -1
TAG_WEIGHT = -4


def page_tokens(df: DataFrame, key: str, html_col: str) -> DataFrame:
    """``(key, pos, tok, name, kind)``: tags (``kind`` 1 opens, -1 closes) and text (``kind`` 0), scripts and comments gone."""
    shown = df.where(F.length(html_col) > 0).select(key, F.regexp_replace(html_col, HIDDEN_PATTERN, "").alias("h"))
    tokens = shown.select(key, F.posexplode(F.regexp_extract_all("h", F.lit(TOKEN_PATTERN), F.lit(0))).alias("pos", "tok"))
    name = F.lower(F.regexp_extract("tok", NAME_PATTERN, 1))
    alone = (F.col("name") == "") | F.col("name").isin(VOID_ELEMENTS) | F.endswith("tok", F.lit("/>"))
    kind = F.when(alone, 0).when(F.startswith("tok", F.lit("</")), -1).otherwise(1)
    return tokens.withColumn("name", name).withColumn("kind", kind)


def element_tree(tokens: DataFrame, key: str) -> DataFrame:
    """``tokens`` with ``mate``, the position of a matched element's closing tag, at its opening one,
    ``matched`` at both, and ``level``, the depth among elements of its name."""
    by_name = Window.partitionBy(key, "name").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    one_before = Window.partitionBy(key, "name").orderBy("pos")
    # A running sum held at zero: closing tags of nothing do not count.
    depth = F.col("sum") - F.least(F.lit(0), F.min("sum").over(by_name))
    deep = tokens.withColumn("sum", F.sum("kind").over(by_name)).withColumn("depth", depth)
    before = F.coalesce(F.lag("depth").over(one_before), F.lit(0))
    level = F.when(F.col("kind") == 1, F.col("depth")).when((F.col("kind") == -1) & (before > 0), before)
    leveled = deep.withColumn("level", level).drop("sum", "depth")
    # On one level opening and closing tags take turns.
    alike = Window.partitionBy(key, "name", "level").orderBy("pos")
    mate = F.when((F.col("kind") == 1) & F.col("level").isNotNull(), F.lead("pos").over(alike))
    matched = F.col("mate").isNotNull() | ((F.col("kind") == -1) & F.col("level").isNotNull())
    return leveled.withColumn("mate", mate).withColumn("matched", matched)


def subtree_weights(tree: DataFrame, key: str, link_weight: int = LINK_WEIGHT, tag_weight: int = TAG_WEIGHT) -> DataFrame:
    """``tree`` with ``hidden`` inside dropped elements and, at a matched opening tag, its subtree's ``weight``."""
    along = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    alike = Window.partitionBy(key, "name", "level").orderBy("pos")

    def inside(names: list[str]):
        return F.coalesce(F.sum(F.when(F.col("matched") & F.col("name").isin(names), F.col("kind"))).over(along), F.lit(0))

    marked = tree.withColumns({"hidden": inside(DROPPED_ELEMENTS) > 0, "linked": inside(["a"]) > 0})
    size = F.length(F.regexp_replace("tok", r"[\s\p{Z}]+", ""))
    value = F.when(F.col("hidden"), 0).when(F.col("name") != "", tag_weight)
    value = value.otherwise(size * F.when(F.col("linked"), link_weight).otherwise(1))
    summed = marked.withColumn("total", F.sum(value).over(along))
    weight = F.when(F.col("mate").isNotNull(), F.lead("total").over(alike) - F.col("total"))
    return summed.withColumn("weight", weight).drop("total", "linked")


def main_text(df: DataFrame, html_col: str = "html_content", out: str = "extracted_text") -> DataFrame:
    """``df`` with ``html_col`` replaced by the text of its heaviest block element.

    Of equal weights the first wins; a page without a matched block element gives all of its
    shown text. Pages without text, null and empty ones are dropped. Rows that repeat
    stay apart. ``df`` should come from a table: rows are told apart by their place in it.
    """
    others = [c for c in df.columns if c != html_col]
    keyed = df.select(F.monotonically_increasing_id().alias("_row"), *others, html_col)
    # A task's sorts stay of one size as the input grows: so many partitions for each of its splits.
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), SPLIT_PARTS * df.rdd.getNumPartitions())
    tokens = page_tokens(keyed, "_row", html_col).repartition(parts, "_row")
    weighed = subtree_weights(element_tree(tokens, "_row"), "_row")
    heavy = F.when(F.col("mate").isNotNull() & F.col("name").isin(CONTAINERS) & ~F.col("hidden"), F.struct("weight", -F.col("pos"), "mate"))
    best = weighed.withColumn("best", F.max(heavy).over(Window.partitionBy("_row")))
    within = F.col("best").isNull() | ((F.col("pos") > -F.col("best.col2")) & (F.col("pos") < F.col("best.mate")))
    piece = F.when(F.col("name") == "", F.when(F.substring("tok", 1, 2).rlike("^<[/!?]"), "").otherwise(F.col("tok")))
    piece = piece.when(F.col("name").isin(BLOCK_ELEMENTS), "\n").when(F.col("name").isin("td", "th") & (F.col("kind") == 1), " ").otherwise("")
    pieces = best.where(within & ~F.col("hidden")).select("_row", F.struct("pos", piece.alias("piece")).alias("p"))
    texts = pieces.groupBy("_row").agg(F.array_sort(F.collect_list("p")).alias("p"))
    joined = texts.select("_row", F.array_join("p.piece", "").alias("_t"))
    shown = F.filter(F.array(folded(decode_entities(F.col("_t")))), lambda t: t.rlike(VISIBLE_PATTERN))
    found = joined.select("_row", F.explode(shown).alias(out))
    return keyed.drop(html_col).join(found, "_row").select(*others, out)

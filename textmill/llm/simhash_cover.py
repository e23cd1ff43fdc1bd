"""SimHash near-duplicates found by covering locality-sensitive hashing.

Every bit position gets a vector of ``radius + 1`` bits. Each of the
``2**(radius + 1) - 1`` tables belongs to a non-zero vector and keeps the positions
whose vector has an odd product with it. The vectors of ``radius`` differing
positions cannot span the space, so some table's vector is orthogonal to them
all: its mask ignores every difference and the two fingerprints meet there
(Pagh, 2016). No pair within the radius is lost.

Copies collapse to one fingerprint first. In a bucket every member is compared
with its smallest and largest one; what that links is a component. Only buckets
that still hold several components are compared inside, across components: the bits
that the bucket's mask leaves free are cut into ``radius + 2`` blocks, two of which are
equal in any linked pair, so members meet only under an equal pair of blocks. A
large group of near copies costs its size, not its square, and every link
between different fingerprints is either inside a component or found.

Defined results: a null text counts as empty; a text without words has
fingerprint 0, linked like any other; null ids are never a component's smallest
id unless it has no other. Equal rows share a fingerprint and a component. An
empty table gives an empty result. A very long text is hashed in blocks of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import col, fresh
from textmill.operators.components import connected_components
from textmill.session import cut

BITS = 64
RADIUS = 4
SHINGLE = 4
SEED = 42
#: Shingles whose bits are counted at a time, so that a very long text needs little memory.
BLOCK = 1 << 16
#: Open buckets of more members are compared by pairs of blocks; the links found are the same.
SMALL = 128


def fingerprint(text: str | None, n: int = SHINGLE) -> int:
    """The signed 64-bit SimHash of a text's word shingles, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(lengths + 1) - 1
    n = min(n, len(words))
    first, last = (stops - lengths)[: len(words) - n + 1], stops[n - 1 :]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(first), BLOCK):
        spans = zip(first[at : at + BLOCK].tolist(), last[at : at + BLOCK].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(joined[i:j], SEED) for i, j in spans], np.dtype("<u8"))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(first), bitorder="little")
    return int(bits.view(np.dtype("<i8"))[0])


def _batches(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([fingerprint(t) for t in batch], dtype="int64")


def _fingerprints(text: Column) -> Column:
    return F.pandas_udf(_batches, "bigint")(text)


def cover_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """The tables' masks as signed integers."""
    size = 1 << (radius + 1)
    # The vectors come round evenly, so every table keeps about half of the positions.
    vectors = [i % size for i in range(bits)]
    masks = []
    for v in range(1, size):
        mask = sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() % 2)
        masks.append(mask - (1 << bits) if mask >> (bits - 1) else mask)
    return masks


def block_masks(mask: int, radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """Masks of every pair of ``radius + 2`` blocks of the bits that ``mask`` leaves free.

    At most ``radius`` differing bits spoil as many blocks, so two stay equal. The
    masks are signed integers.
    """
    free = [i for i in range(bits) if not mask >> i & 1]
    blocks = [sum(1 << i for i in free[b :: radius + 2]) for b in range(radius + 2)]
    pairs = [a | b for a, b in combinations(blocks, 2)]
    return [m - (1 << bits) if m >> (bits - 1) else m for m in pairs]


def _near(a: Column, b: Column, radius: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= radius


def fingerprint_components(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(fp, component)`` for distinct ``fp`` that link to another; the component is its smallest fingerprint."""
    tables = F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("bigint")) for m in cover_masks(radius)])
    # Spark sizes exploded rows as if they were as few as before, so no join may broadcast them by that.
    keys = prints.select("fp", F.posexplode(tables).alias("t", "key")).hint("merge")
    shared = keys.groupBy("t", "key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi")
    members = cut(keys.join(shared, ["t", "key"]), "buckets")
    ends = F.explode(F.array(F.col("lo"), F.col("hi")))
    stars = members.select("fp", ends.alias("end")).where((F.col("fp") != F.col("end")) & _near(F.col("fp"), F.col("end"), radius))
    links = cut(stars.select(F.greatest("fp", "end").alias("a"), F.least("fp", "end").alias("b")).distinct(), "stars")
    rough = cut(connected_components(links, "a", "b").withColumnsRenamed({"id": "fp", "component": "known"}), "rough")
    # What is left: buckets that hold more than one component.
    labelled = cut(
        members.select("t", "key", "fp").join(rough, "fp", "left").select("t", "key", "fp", F.coalesce("known", "fp").alias("known")),
        "labelled",
    )
    mixed = labelled.groupBy("t", "key").agg(F.min("known").alias("x"), F.max("known").alias("y"), F.count("*").alias("n")).where("x <> y").select("t", "key", "n")
    open_ = cut(labelled.join(mixed, ["t", "key"]), "open")
    across = (F.col("known") < F.col("known2")) & _near(F.col("fp"), F.col("fp2"), radius)

    def met(members: DataFrame, *group: str) -> DataFrame:
        other = members.select(*group, F.col("fp").alias("fp2"), F.col("known").alias("known2"))
        return members.hint("merge").join(other, list(group)).where(across).select("known", "known2")

    # Below so many members the blocks would cost more rows than the comparisons that they save.
    few = met(open_.where(F.col("n") <= SMALL), "t", "key")
    inner = F.array(*[F.array(*[F.lit(m).cast("bigint") for m in block_masks(mask, radius)]) for mask in cover_masks(radius)])
    blocks = open_.where(F.col("n") > SMALL).select("t", "key", "fp", "known", F.posexplode(F.get(inner, F.col("t"))).alias("pair", "mask"))
    many = met(blocks.withColumn("block", F.col("fp").bitwiseAND(F.col("mask"))), "t", "key", "pair", "block")
    bridges = cut(few.unionByName(many).distinct(), "bridges")
    merged = connected_components(bridges, "known", "known2").withColumnsRenamed({"id": "known"})
    nodes = rough.unionByName(
        bridges.select(F.explode(F.array("known", "known2")).alias("fp")).distinct().join(rough, "fp", "left_anti").withColumn("known", F.col("fp"))
    )
    return nodes.join(merged, "known", "left").select("fp", F.coalesce("component", "known").alias("component"))


def simhash_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS
) -> DataFrame:
    """``docs`` without their text, with ``simhash`` (signed) and ``component_id``, the smallest id that links reach."""
    results = ["simhash", "component_id"]
    extra = [c for c in docs.columns if c.lower() not in results and c != text_col]
    (fp,) = fresh(docs, "fp")
    hashed = cut(docs.select(*[col(c) for c in extra], _fingerprints(col(text_col)).alias(fp)), "hashed")
    prints = cut(hashed.groupBy(F.col(fp).alias("fp")).agg(F.min(col(id_col)).alias("least")), "prints")
    # Read from a table, the classes can be joined to a fingerprint that very many rows share.
    component = cut(fingerprint_components(prints.select("fp"), radius), "classes")
    named = prints.join(component, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_print = cut(named.join(least, "component").select(F.col("fp").alias("simhash"), "component_id"), "by_print")
    rows = hashed.withColumnRenamed(fp, "simhash")
    return rows.join(by_print, "simhash").select(*[col(c) for c in extra], *results)


def hex_of(simhash: Column) -> Column:
    return F.lpad(F.lower(F.hex(simhash)), 16, "0")


def _row_key(id_col: Column, text: Column) -> Column:
    """A digest of id and text; the length in front keeps pairs apart that join to the same string."""
    name = id_col.cast("string")
    length = F.coalesce(F.char_length(name), F.lit(-1)).cast("string")
    return F.unhex(F.md5(F.concat(length, F.lit(":"), F.coalesce(name, F.lit("")), F.coalesce(text, F.lit("")))))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: one with its smallest id, a null id only
    where the component has no other.

    Rows that repeat an id are told apart by their text, so those of other components stay.
    """
    id_, text = col(id_col), col(text_col)
    hashed = cut(docs.select(id_.alias("id"), _row_key(id_, text).alias("key"), _fingerprints(text).alias("fp")), "hashed")
    first = F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "key"))
    prints = cut(hashed.groupBy("fp").agg(first.alias("first")), "prints")
    component = cut(fingerprint_components(prints.select("fp"), radius), "classes")
    named = prints.join(component, "fp", "left").select(F.coalesce("component", "fp").alias("component"), "first")
    root, key, rank = fresh(docs, "root", "key", "rank")
    roots = cut(named.groupBy("component").agg(F.min("first")["key"].alias(root)).select(root), "roots")
    # Rows of equal id and text are limited to one inside every task before the shuffle.
    one = Window.partitionBy(key).orderBy(text.isNull())
    single = docs.withColumn(key, _row_key(id_, text)).withColumn(rank, F.row_number().over(one)).where(F.col(rank) == 1)
    return single.join(roots, F.col(key) == F.col(root), "left_semi").select(*[col(c) for c in docs.columns])

"""Merkle manifest of a dataset, by checkpoint and recompute.

Every row is a leaf; per group (a source) the leaves in id order form a tree in which
every ``FANOUT`` consecutive nodes, the last run perhaps fewer, become one node, until one
is left: the group's subroot. The subroots in group order form a tree in the same way,
whose last node is the root. A node's digest is the SHA-256 of its children's lower-case
hex digests, concatenated.

Only every ``span``-th level is written. A stored level's nodes that share an ancestor on
the next stored level are an aligned subtree of at most ``FANOUT ** span`` nodes: building
folds it to that ancestor in one task, and proof extraction folds it again, hands every
node its siblings on the levels between, and forgets them. Proofs of the upper levels are
made first, one per stored node, and each subtree meets its own in a cogroup, so no proof
is shuffled and no task sees a whole group, however large.

Places in a group come from a range sort over (group, id, digest, row), each part's size
added to those before it; equal rows are told apart by their place in the written table.

Defined results: a null value counts as ``-``; null ids come first in their group, the null
group before all others; equal ids are ordered by leaf digest, and rows equal in both take
interchangeable leaves. A lone leaf is its group's subroot, a lone subroot the root. An empty
table has no rows and no root. Texts of any length are hashed in place, without Python; only
the fields, id and group columns are read, so other columns and their names do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import col
from textmill.session import cut

FANOUT = 3
#: Levels from one stored level to the next: 729 nodes a subtree.
SPAN = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The order in which repeated rows are told apart; any would do, so long as it is read from a written table.
_PATH = "array<struct<before: string, after: string>>"


def field_bytes(value: Column) -> Column:
    """A field's contribution to a leaf: ``-`` for null, else its byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field_bytes(v) for v in values]), 256)


def group_key(value: Column) -> Column:
    """A key that is never null and orders the null group first, others by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("1"), value.cast("string")), F.lit("0"))


def fold_proof(leaf: Column, proof: Column) -> Column:
    """The root that a leaf gives with its proof."""
    return F.aggregate(proof, leaf, lambda acc, p: F.sha2(F.concat(p["before"], acc, p["after"]), 256))


def proof_digest(proof: Column) -> Column:
    """SHA-256 of a proof's sibling digests, left to right and level by level."""
    return F.sha2(F.array_join(F.transform(proof, lambda p: F.concat(p["before"], p["after"])), ""), 256)


def place(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows(grp, digest, ...)``, a written table, with ``idx``, the place in the group, and the group's size ``n``."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["grp", *order, "digest", "row"]
    dealt = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(parts, *keys)
    # Sorted inside parts, so the running id counts each group's rows without a gap.
    seq = cut(dealt.sortWithinPartitions(*keys).drop("row").withColumn("seq", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("seq", 33).alias("part")
    runs = cut(seq.groupBy("grp", part).agg(F.min("seq").alias("first"), F.count("*").alias("rows")), "runs")
    ahead = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        "grp", "part", (F.coalesce(F.sum("rows").over(ahead), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(Window.partitionBy("grp")).alias("n"),
    )
    # By part only: every part holds few groups, and a large group is dealt over many parts.
    placed = seq.withColumn("part", part).join(starts, ["grp", "part"])
    return placed.withColumn("idx", F.col("seq") + F.col("shift")).drop("seq", "shift", "part")


def _levels(digests: list[str], n: int, span: int, fanout: int) -> list[list[str]]:
    """A subtree's levels from a stored one up, ``n`` being the whole group's nodes there."""
    levels = [digests]
    while n > 1 and len(levels) <= span:
        below = levels[-1]
        runs = ["".join(below[i : i + fanout]) for i in range(0, len(below), fanout)]
        levels.append([hashlib.sha256(r.encode()).hexdigest() for r in runs])
        n = -(-n // fanout)
    return levels


def _folder(span: int, fanout: int) -> Callable[[pa.Table], pa.Table]:
    """Folds one subtree to its node on the next stored level."""

    def fold(nodes: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("idx")
        n, width = nodes["n"][0].as_py(), fanout**span
        top = _levels(nodes["digest"].to_pylist(), n, span, fanout)[-1][0]
        return pa.table({"grp": [nodes["grp"][0].as_py()], "idx": [nodes["block"][0].as_py()], "digest": [top], "n": [-(-n // width)]})

    return fold


def _prover(span: int, fanout: int, columns: list[str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Gives every node of one subtree its siblings, then those of the subtree's own node."""

    def prove(nodes: pa.Table, above: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("idx")
        levels = _levels(nodes["digest"].to_pylist(), nodes["n"][0].as_py(), span, fanout)
        upper = above["proof"][0].as_py()
        proofs = []
        for at in range(nodes.num_rows):
            proof = []
            for level in levels[:-1]:
                run = at - at % fanout
                proof.append({"before": "".join(level[run:at]), "after": "".join(level[at + 1 : run + fanout])})
                at //= fanout
            proofs.append(proof + upper)
        kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
        fixed = {c: pa.array([above[c][0].as_py()] * nodes.num_rows, pa.string()) for c in ("subroot", "root")}
        return pa.table({**{c: nodes[c] for c in columns}, "proof": pa.array(proofs, kind), **fixed})

    return prove


def _schema(table: DataFrame, columns: list[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.select(*columns).schema)


@dataclass
class Forest:
    """Stored levels of the trees of many groups; the last has one node a group."""

    levels: list[DataFrame]
    span: int
    fanout: int

    @classmethod
    def grow(cls, placed: DataFrame, span: int = SPAN, fanout: int = FANOUT) -> Forest:
        """Stores ``placed(grp, idx, digest, n, ...)`` and every ``span``-th level above it."""
        width, levels = fanout**span, [cut(placed, "level")]
        while (levels[-1].agg(F.max("n")).first()[0] or 0) > 1:
            below = levels[-1].select("grp", "idx", "digest", "n", F.floor(F.col("idx") / width).cast("bigint").alias("block"))
            up = below.groupBy("grp", "block").applyInArrow(_folder(span, fanout), "grp string, idx bigint, digest string, n bigint")
            levels.append(cut(up, "level"))
        return cls(levels, span, fanout)

    def roots(self) -> DataFrame:
        """``(grp, digest)``"""
        return self.levels[-1].select("grp", "digest")

    def proofs(self, above: DataFrame) -> DataFrame:
        """The lowest level's rows with ``proof, subroot, root``; ``above(grp, proof, subroot, root)`` is each
        group's proof beyond its own tree."""
        width, known = self.fanout**self.span, above.withColumn("idx", F.lit(0).cast("bigint"))
        for at in range(len(self.levels) - 2, -1, -1):
            level = self.levels[at]
            keep = [c for c in level.columns if c != "n"] if at == 0 else ["grp", "idx"]
            nodes = level.withColumn("block", F.floor(F.col("idx") / width).cast("bigint"))
            kind = f"{_schema(level, keep)}, proof {_PATH}, subroot string, root string"
            parents = known.withColumnRenamed("idx", "block")
            pairs = nodes.groupBy("grp", "block").cogroup(parents.groupBy("grp", "block"))
            known = pairs.applyInArrow(_prover(self.span, self.fanout, keep), kind)
            if at:
                known = cut(known, "proofs")
        if len(self.levels) == 1:
            return self.levels[0].drop("n").join(above, "grp")
        return known


@dataclass
class Manifest:
    """The trees of all groups and the tree over their subroots."""

    sources: Forest
    top: Forest

    @classmethod
    def build(
        cls, docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "source",
        carry: dict[str, Column] | None = None, span: int = SPAN, fanout: int = FANOUT,
    ) -> Manifest:
        """Hashes every row of ``docs`` and stores the levels; ``carry`` are further values to keep beside a leaf."""
        rows = docs.select(
            group_key(col(group_col)).alias("grp"), col(id_col).alias("id"), leaf_digest([col(f) for f in fields]).alias("digest"),
            *[value.alias(name) for name, value in (carry or {}).items()],
        )
        sources = Forest.grow(place(cut(rows, "leaves"), ["id"]), span, fanout)
        subroots = sources.roots().select(F.lit("").alias("grp"), F.col("grp").alias("id"), "digest")
        return cls(sources, Forest.grow(place(cut(subroots, "subroots"), ["id"]), span, fanout))

    def root(self) -> str | None:
        """The digest of the whole dataset."""
        found = self.top.roots().first()
        return found["digest"] if found else None

    def proofs(self) -> DataFrame:
        """``(id, digest, <carried>, proof, subroot, root)`` per row; ``proof`` lists, level by level, the
        siblings' digests ``before`` and ``after`` the path."""
        none = F.array().cast(_PATH)
        roots = self.top.roots().select("grp", none.alias("proof"), F.lit("").alias("subroot"), F.col("digest").alias("root"))
        above = self.top.proofs(roots).select(F.col("id").alias("grp"), "proof", F.col("digest").alias("subroot"), "root")
        return self.sources.proofs(cut(above, "above")).drop("grp", "idx")


def verify(proofs: DataFrame, claimed: Column) -> DataFrame:
    """``proofs`` with ``folded_root``, which a claimed leaf digest gives with the stored proof, and ``verified``."""
    return proofs.withColumn("folded_root", fold_proof(claimed, F.col("proof"))).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )


def _crc_even_sql(text: str) -> str:
    """Whether 2 divides the CRC-32 of an ASCII string, bit by bit."""
    step = "lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    byte = f"lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)::BIGINT[]), {step})"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    # The final inversion flips the lowest bit.
    return f"list_reduce(list_prepend(4294967295::BIGINT, {codes}), {byte}) & 1 = 1"


def _tree_sql(name: str, levels: int, key: str) -> str:
    """Levels ``name_0`` (given) to ``name_<levels>`` of many trees, with ``n`` nodes each, and the runs between."""
    parts = []
    for k in range(levels):
        parts.append(
            f"{name}_r{k} AS (SELECT {key}, idx // {FANOUT} AS idx, any_value(n) AS n, string_agg(h, '' ORDER BY idx) AS run FROM {name}_{k} GROUP BY {key}, idx // {FANOUT})"
        )
        parts.append(
            f"{name}_{k + 1} AS (SELECT {key}, idx, CASE WHEN n > 1 THEN sha256(run) ELSE run END AS h, (n + {FANOUT - 1}) // {FANOUT} AS n FROM {name}_r{k})"
        )
    return ",\n".join(parts)


def _paths_sql(name: str, levels: int, start: str, key: str) -> str:
    """From ``start(..., idx, sib, fold)``: climbs the tree, adding siblings and folding the claimed leaf."""
    parts, size = [], 64
    for k in range(levels):
        before = f"substr(run, 1, {size} * (idx % {FANOUT}))"
        after = f"substr(run, {size} * (idx % {FANOUT} + 1) + 1)"
        source = start if k == 0 else f"{name}_p{k - 1}"
        parts.append(
            f"""{name}_p{k} AS (SELECT p.* EXCLUDE (idx, sib, fold), p.idx // {FANOUT} AS idx,
    CASE WHEN r.n > 1 THEN sib || {before.replace('idx', 'p.idx')} || {after.replace('idx', 'p.idx')} ELSE sib END AS sib,
    CASE WHEN r.n > 1 THEN sha256({before.replace('idx', 'p.idx')} || fold || {after.replace('idx', 'p.idx')}) ELSE fold END AS fold
  FROM {source} p JOIN {name}_r{k} r ON p.{key} = r.{key} AND p.idx // {FANOUT} = r.idx)"""
        )
    return ",\n".join(parts)


#: Levels that the SQL unrolls: 3 ** 16 rows a source, 3 ** 8 sources.
SQL_LEVELS, SQL_TOP = 16, 8


def _leaf_sql(text: str) -> str:
    def part(value: str) -> str:
        return f"coalesce(octet_length(encode({value}::VARCHAR))::VARCHAR || ':' || {value}::VARCHAR, '-')"

    return "sha256(" + " || ".join(part(f if f != "text" else text) for f in FIELDS) + ")"


SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce('1' || source, '0') AS grp, {_leaf_sql('text')} AS leaf,
         CASE WHEN coalesce({_crc_even_sql('doc_id::VARCHAR')}, false) THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql('text')} END AS claimed
  FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS idx,
             count(*) OVER (PARTITION BY grp) AS n FROM d),
s_0 AS (SELECT grp, idx, n, leaf AS h FROM o),
{_tree_sql('s', SQL_LEVELS, 'grp')},
subroots AS (SELECT grp, h, row_number() OVER (ORDER BY grp) - 1 AS place, count(*) OVER () AS n FROM s_{SQL_LEVELS}),
t_0 AS (SELECT 0 AS one, place AS idx, n, h FROM subroots),
{_tree_sql('t', SQL_TOP, 'one')},
climb AS (SELECT doc_id, grp, leaf, idx, '' AS sib, claimed AS fold FROM o),
{_paths_sql('s', SQL_LEVELS, 'climb', 'grp')},
over_source AS (SELECT doc_id, leaf, b.h AS subroot, sib, fold, 0 AS one, b.place AS idx FROM s_p{SQL_LEVELS - 1} p JOIN subroots b ON p.grp = b.grp),
{_paths_sql('t', SQL_TOP, 'over_source', 'one')}
SELECT doc_id, leaf, subroot, h AS root, sha256(sib) AS proof_sha256, fold AS folded_root, fold = h AS verified
FROM t_p{SQL_TOP - 1}, t_{SQL_TOP}
"""

"""Mixing sources to target weights by weighted fair queueing.

Every document of a source, shuffled by a digest of its id and text, gets a virtual
finish time: the source's words up to and with it, divided by the source's target. A
source goes round again in the same order, at most ``repeat`` times in all. All copies
are sorted by finish time over the whole cluster, ties by source and place, and the mix
ends where their running total reaches the budget, the sum of the targets. So a source
is served its target, but for less than one document and for what other sources' documents
in service at the end leave over.

No task sees a whole source or the whole order: the shuffle key is cut into bins and
virtual time into slots, their sums give each its start, and rows are summed in order
only within a bin and within the one slot in which the budget ends.

Defined results: a null text has no words; a null source is one of its own, after
all others. Null ids share an empty id. Rows equal in id and text get separate,
interchangeable places. A document without words takes none. The copy on which the
budget ends is taken in part, in words. An empty table gives an empty mix. Texts of any
length count whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import col, fresh, text_or_empty
from textmill.session import cut

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEAT = 2
#: Hex digits of the shuffle key that name a bin: 16**3 bins a source.
BIN_DIGITS = 3
#: Slots of one unit of virtual time; from ``LAST_TIME`` on there is one slot.
SLOTS = 4096
LAST_TIME = 4


def word_count(text_col: str) -> Column:
    return F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("bigint")


def source_key(source_col: str) -> Column:
    """A key that orders sources by code point and the null source last."""
    return F.coalesce(F.concat(F.lit("s"), col(source_col).cast("string")), F.lit("t"))


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeat: float = REPEAT
) -> DataFrame:
    """``(source_key, source_size, target)`` out of ``(source_key, source_size)``, one row a source.

    Targets divide ``share`` of all words by weight; one above ``repeat`` times its
    source's size stops there and the excess goes to the others, until none is above.
    Each round is one aggregate over the sources; a round that caps none is the last.
    """
    order = Window.orderBy("source_key")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.get(cycle, (F.row_number().over(order) - 1) % len(weights))
    table = cut(sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * float(repeat)), "sources")
    budget = float(table.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = 0.0, -1
    while True:
        full = F.col("most") <= F.col("weight") * level
        got = table.agg(
            F.sum(F.when(full, F.col("most")).otherwise(0.0)).alias("spent"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
            F.sum(full.cast("int")).alias("capped"),
        ).first()
        if got["capped"] is None or got["capped"] == capped or not got["open"]:
            break
        level, capped = (budget - got["spent"]) / got["open"], got["capped"]
    target = F.least(F.col("most"), F.col("weight") * level)
    return table.select("source_key", "source_size", target.alias("target"))


def shuffle_key(id_col: str, text_col: str, seed: int) -> Column:
    text = F.md5(F.encode(text_or_empty(text_col), "UTF-8"))
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(col(id_col).cast("string"), F.lit("")), text), 256)


def _finish(size: Column, passed: Column, target: Column) -> Column:
    """Null where there is no target."""
    return (passed + size) / F.nullif(target, F.lit(0.0))


def _end(placed: DataFrame, budget: int, skey: str, repeat: int) -> tuple[float, str, int, int] | None:
    """The copy on which the budget ends: its finish time, source and place, and its words that still fit.

    None where the budget outlasts all copies."""
    if budget <= 0:
        return (-1.0, "", 0, 0)
    lap = F.explode(F.sequence(F.lit(0), F.lit(repeat - 1)))
    copies = placed.where("size > 0").select(skey, "size", "target", "before", "source_size", lap.alias("lap")).select(
        skey, "size", "target", (F.col("lap") * F.col("source_size") + F.col("before")).alias("passed")
    ).withColumn("finish", _finish(F.col("size"), F.col("passed"), F.col("target"))).where("finish IS NOT NULL")
    copies = copies.withColumn("slot", F.floor(F.least("finish", F.lit(float(LAST_TIME))) * SLOTS))
    slots = copies.groupBy("slot").agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.orderBy("slot"))
    last = slots.withColumn("upto", upto).where(F.col("upto") >= budget).orderBy("slot").first()
    if last is None:
        return None
    left = budget - (last["upto"] - last["words"])
    upto = F.sum("size").over(Window.orderBy("finish", skey, "passed").rowsBetween(Window.unboundedPreceding, 0))
    at = copies.where(F.col("slot") == last["slot"]).withColumn("upto", upto).where(F.col("upto") >= left).orderBy("upto").first()
    return (at["finish"], at[skey], at["passed"], left - (at["upto"] - at["size"]))


def _order(end: tuple[float, str, int, int] | None, finish: Column, source: Column, passed: Column) -> tuple[Column, Column]:
    """Whether a copy comes before the one on which the budget ends, and whether it is that one."""
    if end is None:
        return F.lit(True), F.lit(False)
    at, same = finish == F.lit(end[0]), source == F.lit(end[1])
    return (finish < F.lit(end[0])) | (at & ((source < F.lit(end[1])) | (same & (passed < F.lit(end[2]))))), at & same & (passed == F.lit(end[2]))


def _queued(
    rows: DataFrame, skey: str, key: str, targets: DataFrame | None, repeat: int
) -> tuple[DataFrame, tuple[float, str, int, int] | None]:
    """``rows`` (with ``size`` and both keys) with ``source_size, target, before``, and where the budget ends."""
    bin_, start = fresh(rows, "bin", "bin_start")
    named = F.substring(key, 1, BIN_DIGITS)
    narrow = cut(rows.select(skey, key, "size"), "sizes")
    bins = cut(narrow.groupBy(skey, named.alias(bin_)).agg(F.sum("size").alias("words")), "bins")
    if targets is None:
        sizes = bins.groupBy(F.col(skey).alias("source_key")).agg(F.sum("words").alias("source_size"))
        targets = cut(source_targets(sizes), "targets")
    budget = targets.agg(F.floor(F.sum(F.col("target").cast("decimal(28,3)")) + F.lit(0.5))).first()[0] or 0
    ahead = Window.partitionBy(skey).orderBy(bin_).rowsBetween(Window.unboundedPreceding, -1)
    starts = cut(
        bins.select(skey, bin_, F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias(start)).join(
            targets.withColumnRenamed("source_key", skey), skey
        ),
        "starts",
    )
    order = Window.partitionBy(skey, bin_).orderBy(key, "size").rowsBetween(Window.unboundedPreceding, -1)

    def placed(some: DataFrame) -> DataFrame:
        within = some.withColumn(bin_, named).withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0)))
        return within.join(starts, [skey, bin_]).withColumn("before", F.col("before") + F.col(start)).drop(bin_, start, key)

    return placed(rows), _end(placed(narrow), int(budget), skey, repeat)


def queue(
    docs: DataFrame, targets: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source", seed: int = 42, repeat: int = REPEAT,
) -> DataFrame:
    """``docs`` with ``size, source_size, target``, the words ``before`` it in its source's queue, the
    ``finish`` time of its first copy, and ``taken``: its words that the mix takes, repeats counted."""
    results = ["size", "source_size", "target", "before", "finish", "taken"]
    extra = [c for c in docs.columns if c.lower() not in results]
    skey, key = fresh(docs, "source_key", "shuffle_key")
    # The count is not repeated where the column is used: regular expressions are never inlined twice.
    rows = docs.select(
        *[col(c) for c in extra], word_count(text_col).alias("size"), source_key(source_col).alias(skey),
        shuffle_key(id_col, text_col, seed).alias(key),
    )
    placed, end = _queued(rows, skey, key, targets, repeat)
    size, zero = F.col("size"), F.lit(0).cast("bigint")
    taken = zero
    for lap in range(repeat):
        passed = F.lit(lap) * F.col("source_size") + F.col("before")
        whole, part = _order(end, _finish(size, passed, F.col("target")), F.col(skey), passed)
        taken = taken + F.when(size == 0, zero).when(whole, size).when(part, F.lit(end[3] if end else 0).cast("bigint")).otherwise(zero)
    finish = _finish(size, F.col("before"), F.col("target"))
    return placed.withColumn("finish", finish).withColumn("taken", taken).select(*[col(c) for c in extra], *results)


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 42,
    repeat: int = REPEAT,
) -> DataFrame:
    """The mix itself: ``docs``, one row per copy taken, sorted by virtual finish time.

    Texts stay whole: the copy on which the budget ends is in the mix if at least half of
    its words fit. A document without words is taken when its turn is.
    """
    keep = docs.columns
    rows = docs.select(
        F.struct(*[col(c) for c in keep]).alias("row"), word_count(text_col).alias("size"),
        source_key(source_col).alias("source_key"), shuffle_key(id_col, text_col, seed).alias("shuffle_key"),
    )
    placed, end = _queued(rows, "source_key", "shuffle_key", None, repeat)
    size, passed = F.col("size"), F.col("lap") * F.col("source_size") + F.col("before")
    copies = placed.select(
        "row", "size", "target", "source_key", "source_size", "before", F.explode(F.sequence(F.lit(0), F.lit(repeat - 1))).alias("lap")
    ).where("source_size > 0 OR lap = 0")
    copies = copies.withColumn("finish", F.coalesce(_finish(size, passed, F.col("target")), F.lit(0.0)))
    whole, part = _order(end, F.col("finish"), F.col("source_key"), passed)
    inside = whole | (part & (size <= 2 * (end[3] if end else 0)))
    return copies.where(inside).orderBy("finish").select(*[F.col("row")[c].alias(c) for c in keep])


SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce('s' || source, 't') AS skey,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS k
  FROM documents),
s AS (SELECT skey, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY skey),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY skey) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w,
             {REPEAT}.0::DOUBLE * source_size AS most FROM s),
o AS (SELECT *, most / w AS r FROM w),
-- Sources in the order in which they fill up: the level at which those from here on share what the earlier ones leave.
c AS (SELECT *, coalesce(sum(most) OVER (ORDER BY r, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
             sum(w) OVER (ORDER BY r, skey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w,
             row_number() OVER (ORDER BY r, skey) AS place, (SELECT {SHARE} * sum(source_size) FROM s) AS budget FROM o),
l AS (SELECT arg_min((budget - spent) / open_w, place) FILTER (r >= (budget - spent) / open_w) AS level FROM c),
t AS (SELECT skey, source_size, least(most, w * level)::DOUBLE AS target FROM o, l),
q AS (SELECT doc_id, d.skey, size, source_size, target,
             CAST(sum(size) OVER (PARTITION BY d.skey ORDER BY k, size ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS before
      FROM d JOIN t USING (skey)),
b AS (SELECT floor(sum(CAST(target AS DECIMAL(28, 3))) + 0.5) AS words FROM t),
copies AS (SELECT skey, before, size, lap * source_size + before AS passed,
                  (lap * source_size + before + size) / target AS finish
           FROM q, (SELECT unnest(range({REPEAT})) AS lap) WHERE size > 0),
served AS (SELECT skey, before, size, sum(size) OVER (ORDER BY finish, skey, passed ROWS UNBOUNDED PRECEDING) - size AS ahead FROM copies),
-- The mix ends where the copies in the order of finish times use up the budget.
got AS (SELECT skey, before, CAST(sum(greatest(0, least(size, words - ahead))) AS BIGINT) AS taken FROM served, b GROUP BY ALL)
SELECT doc_id, size, source_size, round(target, 3) AS target, q.before, round((q.before + size) / nullif(target, 0), 6) AS finish,
       coalesce(taken, 0) AS taken
FROM q LEFT JOIN got ON q.skey = got.skey AND q.before = got.before AND size > 0
"""

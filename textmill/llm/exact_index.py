"""Exact deduplication against a persistent digest index.

The index is a Parquet table with one row per distinct text seen so far,
bucketed and sorted by the text's SHA-256. A batch is deduplicated in itself by a
partial aggregate, then against the index by a sort-merge anti-join that reads
the index bucket by bucket without a shuffle; what is new is appended.

Defined results: a null text counts as empty. Of equal texts in one batch the
row with the largest id stays, null ids last; texts of earlier batches stay in
the index, so later copies go. Rows equal in id *and* text are one document: they get the same
labels, and ``dedup`` leaves one of them. An empty batch adds nothing. Admitting
a batch twice under one label changes nothing, so a job that broke off may be
run again. A text's length does not matter after its digest: texts themselves are not moved.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textmill.llm.common import col, fresh, text_or_empty
from textmill.session import cut


def digest(text_col: str) -> Column:
    return F.sha2(text_or_empty(text_col), 256)


class DigestIndex:
    """The index at ``path``. ``buckets`` is fixed when the table is made: choose a
    few times the cluster's cores, so that a bucket sorts in an executor's memory."""

    COLUMNS = "digest STRING, keep_id BIGINT, group_size BIGINT, batch STRING"

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets
        self._hold_buckets()
        self.table = "digest_index_" + hashlib.md5(path.encode()).hexdigest()
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({self.COLUMNS}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def _hold_buckets(self) -> None:
        """Stores the bucket count beside a new index; refuses another one for an index that exists.

        Bucketed files are told apart by their number only, so a table read with another
        count would look for digests in the wrong files.
        """
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        beside = jvm.org.apache.hadoop.fs.Path(self.path.rstrip("/") + "-buckets")
        system = beside.getFileSystem(conf)
        if not system.exists(beside):
            self.spark.range(1).select(F.lit(self.buckets).alias("buckets")).write.mode("overwrite").json(beside.toString())
            return
        made = self.spark.read.schema("buckets INT").json(beside.toString()).first()
        if made is not None and made["buckets"] != self.buckets:
            raise ValueError(f"the index at {self.path} has {made['buckets']} buckets, not {self.buckets}")

    def admit(self, docs: DataFrame, batch: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Append the digests of ``docs`` that no other batch has brought.

        Returns the batch's own groups, new or known: ``digest, keep_id, group_size``.
        """
        # Written first, else the planner would move the anti-join below the aggregate and shuffle every copy.
        groups = cut(
            docs.select(digest(text_col).alias("digest"), col(id_col).cast("bigint").alias("id"))
            .groupBy("digest")
            .agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size")),
            "batch",
        )
        known = self.spark.table(self.table).select("digest")
        new = groups.repartition(self.buckets, "digest").join(known.hint("merge"), "digest", "left_anti")
        new.withColumn("batch", F.lit(batch)).select("digest", "keep_id", "group_size", "batch").write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)
        return groups

    def admit_newest_first(
        self, docs: DataFrame, batches: int = 4, id_col: str = "doc_id", text_col: str = "text", label: str = "part"
    ) -> DataFrame:
        """``docs`` in several batches by falling ranges of the id, null ids with the last.

        So the first batch that brings a text holds its largest id, and later copies meet the
        filled index. Returns ``digest, group_size`` over all batches.
        """
        if batches < 1:
            raise ValueError("at least one batch")
        id_ = col(id_col).cast("bigint")
        cuts = docs.agg(F.percentile_approx(id_, [i / batches for i in range(1, batches)] or [0.5]).alias("cuts")).first()["cuts"]
        above, sizes = None, []
        for i, low in enumerate([*sorted(set(cuts or []) if batches > 1 else [], reverse=True), None]):
            part = docs if low is None else docs.where(id_ > low)
            if above is not None:
                part = part.where((id_ <= above) | id_.isNull()) if low is None else part.where(id_ <= above)
            sizes.append(self.admit(part, f"{label}-{i}", id_col, text_col).select("digest", "group_size"))
            above = low
        return reduce(DataFrame.unionByName, sizes).groupBy("digest").agg(F.sum("group_size").alias("group_size"))

    def entries(self) -> DataFrame:
        """All entries as a plain scan: a join with many copies of one digest can then be split."""
        return self.spark.read.schema(self.COLUMNS).parquet(self.path)

    def label(
        self, docs: DataFrame, batch: str | None, id_col: str = "doc_id", text_col: str = "text", sizes: DataFrame | None = None
    ) -> DataFrame:
        """``docs`` of an admitted batch with ``keep_id, group_size, kept, text_sha256``.

        Without a ``batch``, ``docs`` are those of all batches together; ``sizes`` then
        counts a text's copies over all of them.
        """
        results = ["keep_id", "group_size", "kept", "text_sha256"]
        extra = [c for c in docs.columns if c.lower() not in results]
        rows = docs.select(*[col(c) for c in extra], digest(text_col).alias("text_sha256"))
        entries = self.entries()
        if sizes is not None:
            entries = cut(entries.drop("group_size").join(sizes, "digest"), "sized")
        (first,) = fresh(docs, "first_batch")
        kept = col(id_col).cast("bigint").eqNullSafe(F.col("keep_id"))
        if batch is not None:
            kept = (col(first) == batch) & kept
        return (
            rows.join(entries.withColumnsRenamed({"digest": "text_sha256", "batch": first}), "text_sha256")
            .withColumn("kept", kept)
            .select(*[col(c) for c in extra], *results)
        )

    def dedup(self, docs: DataFrame, batch: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """The rows of an admitted batch that stay, one per text new in it.

        The rank is limited inside every task first, so a text copied into a third
        of the rows leaves each task once; all other rows are shuffled once.
        """
        key, rank, own = fresh(docs, "digest", "rank", "own_digest")
        first = Window.partitionBy(key).orderBy(col(id_col).cast("bigint").desc_nulls_last())
        rows = docs.withColumn(key, digest(text_col)).withColumn(rank, F.row_number().over(first)).where(F.col(rank) == 1)
        mine = self.entries().where(F.col("batch") == batch).select(F.col("digest").alias(own))
        return rows.join(mine, F.col(key) == F.col(own), "left_semi").select(*[col(c) for c in docs.columns])


SQL = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""

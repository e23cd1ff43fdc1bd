"""Parquet tables: pruned scans with declared schemas, and partitioned zstd writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    schema: T.StructType | None = None,
    spread_by: str | None = None,
) -> DataFrame:
    """Scan a Parquet table.

    ``spread_by`` hash-partitions an input that has fewer splits than the session
    has cores, so that costly row-wise work on a small file uses all of them. A
    large table has more splits than cores and is never shuffled here.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    if columns:
        df = df.select(*columns)
    cores = spark.sparkContext.defaultParallelism
    if spread_by and df.rdd.getNumPartitions() < cores:
        df = df.repartition(cores, spread_by)
    return df


def write_table(
    df: DataFrame, path: str, partition_by: str | None = None, max_records_per_file: int = 1_000_000
) -> None:
    """Overwrite ``path`` with zstd Parquet.

    No repartitioning: rows of one source file already sit together in its
    splits, and a shuffle by file name would send a whole archive to one task.
    """
    writer = (
        df.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", max_records_per_file)
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)

"""Blacklist folders: files, or folders of files, named ``domains`` or ``urls``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.operators.domains import blacklist_normalise

# Fixed value: what a list is called, at any depth, as a file or as a folder of parts.
LIST_PATTERN = r"/(domains|urls)(/[^/]*)?$"


def blacklist_load(spark: SparkSession, root: str) -> DataFrame:
    """Distinct normalised entries ``(domain)`` of every list under ``root``."""
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .text(root)
        .where(F.col("_metadata.file_path").rlike(LIST_PATTERN))
        .select("value")
    )
    return blacklist_normalise(lines, "value")

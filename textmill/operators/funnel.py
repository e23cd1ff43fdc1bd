"""Row counts along a job's steps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stage_funnel(stages: list[tuple[str, str | None, DataFrame]]) -> DataFrame:
    """``(step, stage, parent, rows_in, rows_out, share)`` for ``(stage, parent, table)`` given in order.

    Several stages may have the same parent. ``rows_in`` of a stage without one is
    its own count. Each count is a map-side aggregate over one scan; pass tables that
    are already written, or their work is repeated.
    """
    counts = [
        df.agg(F.count("*").alias("rows_out")).select(
            F.lit(i).alias("step"), F.lit(name).alias("stage"), F.lit(parent).cast("string").alias("parent"), "rows_out"
        )
        for i, (name, parent, df) in enumerate(stages)
    ]
    table = reduce(DataFrame.unionByName, counts)
    before = table.select(F.col("stage").alias("parent"), F.col("rows_out").alias("rows_in"))
    joined = table.join(before, "parent", "left").withColumn("rows_in", F.coalesce("rows_in", "rows_out"))
    return joined.select(
        "step", "stage", "parent", "rows_in", "rows_out",
        F.round(F.col("rows_out") / F.nullif("rows_in", F.lit(0)), 6).alias("share"),
    )

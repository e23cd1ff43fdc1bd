"""Grouped statistics on long tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.session import cut

#: Size of a KLL sketch; a larger one is more exact.
SKETCH_K = 1024


def _rounded(value: Column, digits: int | None) -> Column:
    return value if digits is None else F.round(value, digits)


def grouped_mean(df: DataFrame, group_cols: list[str], metrics: list[str], digits: int | None = None) -> DataFrame:
    """Mean of every metric per group, under the metric's own name."""
    return df.groupBy(*group_cols).agg(*[_rounded(F.avg(m), digits).alias(m) for m in metrics])


def mean_std_by_group(
    df: DataFrame, group_cols: list[str], metrics: list[str], digits: int | None = None
) -> DataFrame:
    """``{metric}_mean`` and ``{metric}_std`` (sample) per group, with the row count ``n``."""
    columns = [F.count("*").alias("n")]
    for m in metrics:
        columns.append(_rounded(F.avg(m), digits).alias(f"{m}_mean"))
        columns.append(_rounded(F.stddev_samp(m), digits).alias(f"{m}_std"))
    return df.groupBy(*group_cols).agg(*columns)


def first_by_group(df: DataFrame, group_cols: list[str], order_cols: list[str], cols: list[str]) -> DataFrame:
    """Per group the values of ``cols`` in the first row by ``order_cols``."""
    best = F.min_by(F.struct(*cols), F.struct(*order_cols)).alias("_first")
    return df.groupBy(*group_cols).agg(best).select(*group_cols, *[F.col("_first")[c].alias(c) for c in cols])


def best_row_by_group(df: DataFrame, group_cols: list[str], metric: str, tie_cols: list[str]) -> DataFrame:
    """The whole row with the smallest metric per group; ties go to the smallest ``tie_cols``.

    Whole rows are aggregated by sorting them. So the smallest metrics are found first, which
    takes no sort, and only the rows that have them are: ``df`` is read twice.
    """
    others = [c for c in df.columns if c not in group_cols]
    known = df.where(F.col(metric).isNotNull())
    groups = [F.col(c).alias(f"_group{i}") for i, c in enumerate(group_cols)]
    least = cut(known.groupBy(*groups).agg(F.min(metric).alias("_least")), "least")
    alike = [F.col(c).eqNullSafe(F.col(f"_group{i}")) for i, c in enumerate(group_cols)]
    best = known.join(least, reduce(Column.__and__, alike, F.col(metric) == F.col("_least")), "left_semi")
    return first_by_group(best, group_cols, [metric, *tie_cols], others)


def baseline_ratio(
    df: DataFrame, group_cols: list[str], order_cols: list[str], metric: str, out: str = "ratio"
) -> DataFrame:
    """Every row with ``baseline / metric``, the baseline being the metric of its group's first row.

    The baselines are an aggregate joined back, one row per group, so a group
    with a third of all rows is never brought together.
    """
    base = first_by_group(df, group_cols, order_cols, [metric]).withColumnRenamed(metric, "baseline")
    return df.join(base, group_cols).withColumn(out, F.col("baseline") / F.col(metric))


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """The sorted distinct values of a key."""
    return df.select(key).distinct().orderBy(key)


def quantiles_by_group(
    df: DataFrame,
    group_cols: list[str],
    metric: str,
    probs: dict[str, float] | None = None,
    slices: int = 256,
) -> DataFrame:
    """Exact interpolated quantiles per group, one column per entry of ``probs``.

    A group of any size is handled in parts. An approximate sketch cuts its value
    range into slices of nearly equal row counts, equal values are combined
    first, and only the slices that hold a wanted rank are sorted. The combined
    values are written once, so the input is read once.
    """
    probs = probs or {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}
    values = cut(
        df.where(F.col(metric).isNotNull())
        .groupBy(*group_cols, F.col(metric).cast("double").alias("v"))
        .agg(F.count("*").alias("c")),
        "values",
    )
    grid = [i / slices for i in range(1, slices)]
    cuts = cut(
        values.groupBy(*group_cols).agg(
            F.percentile_approx("v", grid, 10 * slices).alias("cuts"), F.sum("c").alias("n")
        ),
        "cuts",
    )
    sliced = values.join(cuts, group_cols).select(
        *group_cols, "n", "v", "c", F.size(F.filter("cuts", lambda x: x < F.col("v"))).alias("slice")
    )
    # At most `slices` rows per group from here on.
    totals = sliced.groupBy(*group_cols, "slice").agg(F.sum("c").alias("rows"), F.first("n").alias("n"))
    earlier = Window.partitionBy(*group_cols).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    placed = totals.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    ranks = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.lit(p).alias("p"), ((F.col("n") - 1) * F.lit(p)).alias("at"))
            for name, p in probs.items()
        ]
    )
    wanted = cut(
        placed.withColumn("rank", F.explode(ranks))
        .select(*group_cols, "slice", "before", "rows", "rank.name", "rank.at")
        .where((F.ceil("at") >= F.col("before")) & (F.floor("at") < F.col("before") + F.col("rows"))),
        "ranks",
    )
    needed = wanted.select(*group_cols, "slice", "before").distinct()
    inside = Window.partitionBy(*group_cols, "slice").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ordered = (
        sliced.join(needed, [*group_cols, "slice"])
        .withColumn("last", F.col("before") + F.sum("c").over(inside) - 1)
        .withColumn("first", F.col("last") - F.col("c") + 1)
    )
    pairs = wanted.select(*group_cols, "slice", "name", "at").join(ordered, [*group_cols, "slice"])
    low, high = F.floor("at"), F.ceil("at")
    ends = pairs.groupBy(*group_cols, "name", "at").agg(
        F.max(F.when((F.col("first") <= low) & (low <= F.col("last")), F.col("v"))).alias("lo"),
        F.max(F.when((F.col("first") <= high) & (high <= F.col("last")), F.col("v"))).alias("hi"),
    )
    value = F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("at") - F.floor("at"))
    return ends.groupBy(*group_cols).agg(*[F.max(F.when(F.col("name") == name, value)).alias(name) for name in probs])


def quantile_sketches(df: DataFrame, group_cols: list[str], metric: str, k: int = SKETCH_K) -> DataFrame:
    """``(*group_cols, sketch, n)``: one KLL sketch of a batch's values per group, combined inside every task first.

    A sketch takes a few kilobytes whatever its group's size. Store a batch's rows by
    appending them; nothing that is stored is read again. Nulls and NaN take no part, a
    group without other values has no row.
    """
    value = F.col(metric).cast("double")
    kept = df.select(*group_cols, value.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    return kept.groupBy(*group_cols).agg(F.kll_sketch_agg_double("v", k).alias("sketch"), F.count("*").alias("n"))


def merge_sketches(sketches: DataFrame, group_cols: list[str], k: int = SKETCH_K) -> DataFrame:
    """One sketch per group out of those of any number of batches, or of finer groups."""
    return sketches.groupBy(*group_cols).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"), F.sum("n").alias("n"))


def sketch_quantiles(sketches: DataFrame, group_cols: list[str], probs: dict[str, float]) -> DataFrame:
    """``(*group_cols, n)`` and one column per entry of ``probs``, read off merged sketches.

    Values are ones that occur. With ``k`` 1024 the rank of each is off by less than
    0.4 % of the group in 99 of 100 cases; ``quantiles_by_group`` is exact.
    """
    values = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(name) for name, p in probs.items()]
    return sketches.select(*group_cols, "n", *values)


def stack(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames, columns matched by name."""
    return reduce(DataFrame.unionByName, frames)

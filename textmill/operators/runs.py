"""Analytics of runs: scaling, time breakdown, memory and utilisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.operators.stats import best_row_by_group, grouped_mean, stack

# The run table's columns in file order.
CONFIG_COLUMNS = ["Type", "Execs", "Cores", "TotalCores", "MemGB", "Data", "AppID"]
STAGE_COLUMNS = ["S1", "S2", "S3", "S4", "S5a", "S5b", "S6a", "S6b"]
MS_COLUMNS = ["AppTimeMs", "ExecRunTimeMs", "GCMs", "ShuffleReadMs", "ShuffleWriteMs", "CommMs", "ComputeMs"]
MB_COLUMNS = ["MemSpillMB", "DiskSpillMB", "PeakHeapMB"]
INT_COLUMNS = {"Execs", "Cores", "TotalCores", "MemGB", "Run"}
LONG_COLUMNS = {"AppTimeMs", "ExecRunTimeMs", "GCMs", "ShuffleReadMs"}
TEXT_COLUMNS = {"Type", "Data", "AppID"}
RUN_COLUMNS = [
    *CONFIG_COLUMNS, *STAGE_COLUMNS, "TotalTime", "AppTimeMs", "ExecRunTimeMs", "Parallelism", "GCMs", "GCRatio",
    "ShuffleReadMs", "ShuffleWriteMs", "CommMs", "CommRatio", "ComputeMs", "ComputeRatio", *MB_COLUMNS, "Run",
]
# The columns that make a configuration, in the order that puts the baseline first.
CONFIGURATION = ["Execs", "Cores", "TotalCores", "MemGB"]
# Size of each data set in GB.
DATA_SIZES = {
    "small_1": 3.9,
    "small_2": 7.8,
    "small_4": 15.7,
    "small_6": 23.4,
    "small_8": 31.0,
    "small_16": 62.2,
}


def _type_of(column: str) -> T.DataType:
    if column in TEXT_COLUMNS:
        return T.StringType()
    if column in INT_COLUMNS:
        return T.IntegerType()
    return T.LongType() if column in LONG_COLUMNS else T.DoubleType()


RUN_SCHEMA = T.StructType([T.StructField(c, _type_of(c), True) for c in RUN_COLUMNS])


def _raw_runs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All cells as text, without header lines."""
    raw = T.StructType([T.StructField(c, T.StringType(), True) for c in RUN_COLUMNS])
    rows = spark.read.schema(raw).option("header", False).csv(path)
    return rows.where("Type IS NULL OR lower(Type) <> 'type'")


def read_runs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Run tables as CSV, with or without a header line and whatever the header's letter case.

    The declared schema goes by position, and a header line is the row whose
    first field is the first column's name. An empty cell is null, and so is one that
    does not fit its type: ``unread_cells`` lists those.
    """
    return _raw_runs(spark, path).select(*[F.col(c).try_cast(_type_of(c)).alias(c) for c in RUN_COLUMNS])


def unread_cells(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(column, value, rows)`` of the cells that ``read_runs`` gives as null because they do not fit."""
    cells = F.array(
        *[
            F.when(F.col(c).try_cast(_type_of(c)).isNull(), F.struct(F.lit(c).alias("column"), F.col(c).alias("value")))
            for c in RUN_COLUMNS
        ]
    )
    found = _raw_runs(spark, path).select(F.explode(cells).alias("cell")).where("cell.value IS NOT NULL")
    return found.groupBy("cell.column", "cell.value").agg(F.count("*").alias("rows"))


def append_runs(runs: DataFrame, path: str) -> None:
    """Append rows to a run table with a header in every part."""
    runs.select(*RUN_COLUMNS).write.mode("append").option("header", True).csv(path)


def write_report(table: DataFrame, path: str) -> None:
    """One CSV file; a report has a few rows per configuration, its computation stays distributed."""
    table.repartition(1).write.mode("overwrite").option("header", True).csv(path)


def data_sizes(spark: SparkSession) -> DataFrame:
    """The fixed sizes as literal rows, whose known size lets the planner broadcast them."""
    rows = ", ".join(f"('{name}', {size}D)" for name, size in DATA_SIZES.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS sizes(Data, DatasetSizeGB)")


def run_status(runs: DataFrame) -> DataFrame:
    """Adds ``status``: a run without total time or with a stage at zero has failed."""
    done = F.col("TotalTime") > 0
    for stage in STAGE_COLUMNS:
        done = done & (F.col(stage) > 0)
    return runs.withColumn("status", F.when(done, "ok").otherwise("failed"))


def run_dedup(runs: DataFrame, ignore: list[str] | None = None) -> DataFrame:
    """Distinct rows after dropping columns such as the application id."""
    return runs.drop(*(ignore if ignore is not None else ["AppID"])).distinct()


def run_enrich(runs: DataFrame, sizes: DataFrame, strict: bool = True) -> DataFrame:
    """Adds seconds, GiB, data set size and time per core and per unit of data.

    ``strict`` fails the job on a data set that ``sizes`` does not list.
    """
    known = runs.join(sizes, "Data", "left")
    if strict:
        known = known.withColumn(
            "DatasetSizeGB",
            F.when(
                F.col("DatasetSizeGB").isNull(),
                F.raise_error(F.concat(F.lit("unknown data set: "), F.coalesce("Data", F.lit("null")))).cast("double"),
            ).otherwise(F.col("DatasetSizeGB")),
        )
    seconds = {c[:-2] + "Sec": F.col(c) / 1000 for c in MS_COLUMNS}
    gigabytes = {c[:-2] + "GB": F.col(c) / 1024 for c in MB_COLUMNS}
    factor = F.nullif(F.regexp_extract("Data", r"_(\d+)", 1), F.lit("")).cast("double")
    return (
        known.withColumns({**seconds, **gigabytes, "SizeFactor": factor})
        .withColumns(
            {
                "TimePerCore": F.try_divide("AppTimeSec", "TotalCores"),
                "TimePerUnit": F.try_divide("AppTimeSec", "SizeFactor"),
            }
        )
    )


def completed(runs: DataFrame) -> DataFrame:
    """Runs that did not fail; averages and best rows are taken of these."""
    return run_status(runs).where("status = 'ok'").drop("status")


def configuration_means(runs: DataFrame, metrics: list[str], by: list[str] | None = None) -> DataFrame:
    """Mean of the metrics per configuration (of each ``by`` group), so that repetitions of a run do not weigh more."""
    return grouped_mean(runs, [*(by or []), *CONFIGURATION], metrics)


def _baseline(time_col: str, by: list[str]) -> Column:
    """The time of a group's first configuration; the window holds one row per configuration."""
    return F.first(time_col).over(Window.partitionBy(*by).orderBy(*CONFIGURATION))


def _efficiency(time_col: str, by: list[str]) -> Column:
    ideal = F.col("TotalCores") / F.min("TotalCores").over(Window.partitionBy(*by))
    return _baseline(time_col, by) / F.col(time_col) / ideal * 100


def strong_scaling(runs: DataFrame, time_col: str = "AppTimeSec", experiment_cols: list[str] | None = None) -> DataFrame:
    """Speedup, ideal speedup, efficiency and utilisation per core count of each experiment.

    Configurations are averaged first, each is compared with the experiment's first
    configuration, and the comparisons are averaged per core count.
    """
    by = experiment_cols or ["Type"]
    configs = configuration_means(runs, [time_col, "Parallelism"], by).withColumns(
        {
            "Speedup": _baseline(time_col, by) / F.col(time_col),
            "Efficiency": _efficiency(time_col, by),
            "_least": F.min("TotalCores").over(Window.partitionBy(*by)),
        }
    )
    means = configs.groupBy(*by, "TotalCores").agg(
        *[F.avg(c).alias(c) for c in [time_col, "Speedup", "Efficiency", "Parallelism"]], F.first("_least").alias("_least")
    )
    return means.select(
        *by,
        "TotalCores",
        F.round(time_col, 2).alias(time_col),
        F.round("Speedup", 2).alias("Speedup"),
        (F.col("TotalCores") / F.col("_least")).alias("IdealSpeedup"),
        F.round("Efficiency", 2).alias("Efficiency"),
        F.round("Parallelism", 2).alias("Parallelism"),
        F.round(F.round("Parallelism", 2) / F.col("TotalCores") * 100, 1).alias("Utilization"),
    )


def weak_scaling(runs: DataFrame, time_col: str = "AppTimeSec", metrics: list[str] | None = None) -> DataFrame:
    """One row per configuration with ``Efficiency = 100 * baseline / time``.

    The baseline of a width (``Cores``) is its first configuration.
    """
    means = configuration_means(runs, [time_col, *(metrics or [])])
    return means.withColumn("Efficiency", _baseline(time_col, ["Cores"]) / F.col(time_col) * 100)


def ratio_breakdown(runs: DataFrame, group_cols: list[str], digits: int | None = 2) -> DataFrame:
    """Mean seconds per group and the share of run time in compute, GC and communication, in percent.

    Shares are taken per configuration and averaged per group.
    """
    seconds = ["AppTimeSec", "ComputeSec", "GCSec", "ShuffleReadSec", "ShuffleWriteSec"]
    extra = [c for c in group_cols if c not in CONFIGURATION]
    configs = configuration_means(runs, [*seconds, "CommSec", "ExecRunTimeSec"], extra)
    shares = {f"{part}Ratio": 100 * F.col(f"{part}Sec") / F.col("ExecRunTimeSec") for part in ("Compute", "GC", "Comm")}
    return grouped_mean(configs.withColumns(shares), group_cols, [*seconds, *shares], digits)


def stage_time_by_group(runs: DataFrame, group_cols: list[str], digits: int | None = 2) -> DataFrame:
    """Mean of the eight stage times per group, over the means of its configurations."""
    extra = [c for c in group_cols if c not in CONFIGURATION]
    return grouped_mean(configuration_means(runs, STAGE_COLUMNS, extra), group_cols, STAGE_COLUMNS, digits)


# The labels of configurations and scenarios in the reports.
STRONG, STRONG_ENDS = "Strong Scaling", ("Strong Scaling (Min Cores)", "Strong Scaling (Max Cores)")
WEAK_FORMAT = "Weak Scaling (%d cores/exec)"


def memory_profile(runs: DataFrame, digits: int | None = 2) -> DataFrame:
    """Mean heap, spill and GC at the smallest and largest strong run and per weak width."""
    metrics = ["PeakHeapGB", "MemSpillGB", "DiskSpillGB", "GCSec"]
    configs = configuration_means(runs, metrics, ["Type"])
    strong = configs.where("Type = 'Strong'")
    ends = strong.agg(F.min("TotalCores").alias("low"), F.max("TotalCores").alias("high")).select(
        F.explode(
            F.array(
                F.struct(F.lit(STRONG_ENDS[0]).alias("Configuration"), F.col("low").alias("TotalCores")),
                F.struct(F.lit(STRONG_ENDS[1]).alias("Configuration"), F.col("high").alias("TotalCores")),
            )
        ).alias("e")
    ).select("e.Configuration", "e.TotalCores")
    weak = configs.where("Type = 'Weak' AND Cores IN (2, 4)").withColumn(
        "Configuration", F.format_string(WEAK_FORMAT, "Cores")
    )
    columns = ["Configuration", *metrics]
    return grouped_mean(
        stack([strong.join(ends, "TotalCores").select(*columns), weak.select(*columns)]),
        ["Configuration"], metrics, digits,
    )


def _scenario() -> Column:
    return (
        F.when(F.col("Type") == "Strong", STRONG)
        .when(
            (F.col("Type") == "Weak") & F.col("Cores").isin(2, 4),
            F.format_string(WEAK_FORMAT, "Cores"),
        )
    )


def utilisation(runs: DataFrame) -> DataFrame:
    """Parallelism and its share of the cores per scenario and core count, with the first configuration."""
    configs = configuration_means(runs, ["Parallelism"], ["Type"])
    rows = configs.withColumn("Scenario", _scenario()).where(F.col("Scenario").isNotNull())
    key = F.struct("Execs", "Cores", "MemGB")
    grouped = rows.groupBy("Scenario", "TotalCores").agg(
        F.avg("Parallelism").alias("Parallelism"),
        F.min_by("Execs", key).alias("Execs"),
        F.min_by("Cores", key).alias("Cores"),
    )
    return grouped.select(
        "Scenario",
        "TotalCores",
        "Execs",
        "Cores",
        F.round("Parallelism", 6).alias("Parallelism"),
        F.round(F.col("Parallelism") / F.col("TotalCores") * 100, 1).alias("Utilization"),
    )


def best_configurations(runs: DataFrame, digits: int = 6) -> DataFrame:
    """The fastest configuration of each scenario by its mean time; ``Efficiency`` is defined for strong scaling only."""
    configs = configuration_means(runs, ["AppTimeSec", "PeakHeapGB", "MemSpillGB"], ["Type"])
    rows = (
        configs.withColumn("Efficiency", F.when(F.col("Type") == "Strong", _efficiency("AppTimeSec", ["Type"])))
        .withColumn("Experiment", _scenario())
        .where(F.col("Experiment").isNotNull())
    )
    best = best_row_by_group(rows, ["Experiment"], "AppTimeSec", CONFIGURATION)
    return best.select(
        "Experiment", "Execs", "Cores", "TotalCores",
        F.round("AppTimeSec", digits).alias("AppTimeSec"),
        F.round("Efficiency", 1).alias("Efficiency"),
        F.round("PeakHeapGB", 2).alias("PeakHeapGB"),
        F.round("MemSpillGB", 2).alias("MemSpillGB"),
    )


def run_summary(runs: DataFrame) -> DataFrame:
    """One row of overall figures; ratios in percent, heap in GiB."""
    key = F.struct("AppTimeSec", "Execs", "Cores", "Data", "Run")
    core_key = F.struct("TimePerCore", "Execs", "Cores", "Data", "Run")
    config = F.concat_ws("x", "Execs", "Cores")
    return runs.agg(
        F.count("*").alias("Runs"),
        F.count_if(F.col("Type") == "Strong").alias("StrongRuns"),
        F.count_if(F.col("Type") == "Weak").alias("WeakRuns"),
        F.count_if(F.col("Type") == "MemoryStudy").alias("MemoryRuns"),
        F.round(F.avg("AppTimeSec"), 2).alias("AvgTime"),
        F.round(F.min("AppTimeSec"), 2).alias("MinTime"),
        F.round(F.max("AppTimeSec"), 2).alias("MaxTime"),
        F.round(F.avg("GCSec"), 2).alias("AvgGC"),
        F.round(F.avg("GCRatio") * 100, 2).alias("AvgGCRatio"),
        F.round(F.avg("ComputeRatio") * 100, 2).alias("AvgComputeRatio"),
        F.round(F.avg("CommRatio") * 100, 2).alias("AvgCommRatio"),
        F.round(F.avg("PeakHeapGB"), 2).alias("AvgPeakHeapGB"),
        F.round(F.avg("MemSpillGB"), 2).alias("AvgMemSpillGB"),
        F.round(F.avg("DiskSpillGB"), 2).alias("AvgDiskSpillGB"),
        F.round(F.sum("MemSpillGB"), 2).alias("SumMemSpillGB"),
        F.round(F.sum("DiskSpillGB"), 2).alias("SumDiskSpillGB"),
        F.min_by(config, key).alias("BestConfig"),
        F.min_by(config, core_key).alias("MostEfficientConfig"),
        F.round(F.min("TimePerCore"), 2).alias("TimePerCore"),
    )


def shuffle_profile(runs: DataFrame) -> DataFrame:
    """Mean seconds in compute, GC and shuffle and the mean recorded ratios, one row per configuration."""
    metrics = [
        "AppTimeSec", "ComputeSec", "GCSec", "ShuffleReadSec", "ShuffleWriteSec", "ComputeRatio", "GCRatio", "CommRatio",
    ]
    return configuration_means(runs, metrics)


def best_runs(runs: DataFrame) -> DataFrame:
    """The fastest run, the one with the least time per core, and the least time per unit of data among weak runs."""
    weak = runs.where("Type = 'Weak'")
    lists = [("time", runs, "AppTimeSec"), ("time per core", runs, "TimePerCore"), ("time per unit", weak, "TimePerUnit")]
    return stack(
        [
            best_row_by_group(
                rows.select(
                    F.lit(name).alias("Best"), "Execs", "Cores", "TotalCores", "Data", "Run", F.col(metric).alias("Value")
                ),
                ["Best"], "Value", ["TotalCores", "Execs", "Data", "Run"],
            )
            for name, rows, metric in lists
        ]
    )


def report_tables(runs: DataFrame) -> dict[str, DataFrame]:
    """All report tables of an enriched run table, by name; failed runs are left out."""
    runs = completed(runs)
    strong, weak = runs.where("Type = 'Strong'"), runs.where("Type = 'Weak'")
    widths = weak.where("Cores IN (2, 4)")
    spills = ["MemSpillGB", "DiskSpillGB", "PeakHeapGB"]
    # The names of the report tables.
    return {
        "strong_performance": strong_scaling(strong).drop("Type"),
        "strong_breakdown": ratio_breakdown(strong, ["TotalCores"]),
        "stage_strong_time": stage_time_by_group(strong, ["TotalCores"]),
        "weak_comparison": weak_scaling(widths, metrics=["DatasetSizeGB", "ExecRunTimeMs", "Parallelism", "TimePerUnit"]),
        "memory_analysis": memory_profile(runs),
        "best_configs": best_configurations(runs),
        "parallelism": utilisation(runs),
        "strong_spill": configuration_means(strong, spills),
        "stage_weak_time": stage_time_by_group(weak, ["TotalCores"]),
        "weak_shuffle": shuffle_profile(widths),
    }


def write_reports(tables: dict[str, DataFrame], path: str) -> None:
    """Write every report table as CSV under ``path``."""
    for name, table in tables.items():
        write_report(table, f"{path}/{name}")

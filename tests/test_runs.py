"""Event logs, console logs, run tables and their statistics."""

import json
import random
import statistics

import pytest
from conftest import rows
from pyspark.sql import functions as F

from textmill.operators import runs as R
from textmill.operators.stats import (
    baseline_ratio, best_row_by_group, mean_std_by_group, merge_sketches, quantile_sketches, quantiles_by_group, sketch_quantiles,
)
from textmill.sources.eventlog import eventlog_metrics, read_event_logs, runlog_scrape

APP = "application_1700000000000_0001"


def task(run, gc=0, mem=0, disk=0, wait=None, write=None):
    metrics = {"Executor Run Time": run, "JVM GC Time": gc, "Memory Bytes Spilled": mem, "Disk Bytes Spilled": disk}
    if wait is not None:
        metrics["Shuffle Read Metrics"] = {"Fetch Wait Time": wait}
    if write is not None:
        metrics["Shuffle Write Metrics"] = {"Shuffle Write Time": write}
    return {"Event": "SparkListenerTaskEnd", "Task Metrics": metrics}


def beat(executor, *heaps):
    updates = [{"Executor Metrics": {"JVMHeapMemory": h}} for h in heaps]
    return {"Event": "SparkListenerExecutorMetricsUpdate", "Executor ID": executor, "Executor Metrics Updated": updates}


def lines(*events):
    return "\n".join(e if isinstance(e, str) else json.dumps(e) for e in events) + "\n"


def test_event_logs(spark, tmp_path):
    start = {"Event": "SparkListenerApplicationStart", "Timestamp": 1000}
    end = {"Event": "SparkListenerApplicationEnd", "Timestamp": 3000}
    stage = {"Event": "SparkListenerStageExecutorMetrics", "Executor ID": "2", "Executor Metrics": {"JVMHeapMemory": 9 << 20}}
    log = lines(
        start, "{broken", task(1000, 100, 1 << 20, 2 << 20, 50, 30_000_000), task(3000), beat("1", 5 << 20, 7 << 20),
        beat("2", 3 << 20), stage, {"Event": "Other"}, end,
    )
    (tmp_path / APP).write_text(log)
    (tmp_path / "application_1700000000000_0002").write_text(lines(start, task(10)))
    wanted = spark.createDataFrame([(APP,), ("application_1700000000000_0002",), ("application_1700000000000_0003",)], "app string")
    got = {r["app"]: r for r in eventlog_metrics(read_event_logs(spark, str(tmp_path)), wanted).collect()}
    m = got[APP]
    assert (m["total_time_ms"], m["executor_run_time_ms"], m["gc_time_ms"], m["shuffle_read_ms"]) == (2000, 4000, 100, 50)
    assert m["shuffle_write_ms"] == 30 and m["communication_ms"] == 80 and m["compute_ms"] == 3820
    assert m["parallelism_factor"] == pytest.approx(2) and m["compute_ratio"] == pytest.approx(0.955)
    assert (m["memory_spill_mb"], m["disk_spill_mb"], m["peak_heap_mb"]) == (1, 2, 9)
    unfinished = got["application_1700000000000_0002"]
    assert unfinished["total_time_ms"] == 0 and unfinished["peak_heap_mb"] == 0
    absent = got["application_1700000000000_0003"].asDict()
    assert len(absent) == 15 and all(v == 0 for k, v in absent.items() if k != "app")


def test_newest_log_and_rolled_log(spark, tmp_path):
    import os

    for i, (folder, run) in enumerate([("old", 1), ("new", 2)]):
        (tmp_path / folder).mkdir()
        file = tmp_path / folder / APP
        file.write_text(lines(task(run)))
        os.utime(file, (1_000_000 + i, 1_000_000 + i))
    rolled = tmp_path / "eventlog_v2_application_1700000000000_0009"
    rolled.mkdir()
    (rolled / "events_1").write_text(lines(task(4)))
    (rolled / "events_2").write_text(lines(task(8)))
    got = {r["app"]: r["executor_run_time_ms"] for r in eventlog_metrics(read_event_logs(spark, str(tmp_path))).collect()}
    assert got == {APP: 2, "application_1700000000000_0009": 12}


def test_only_newest_logs_are_opened(spark, tmp_path):
    import os

    for i in range(6):
        folder = tmp_path / f"run {i} [a]%20"
        folder.mkdir()
        for n in (1, 2):
            # Opening an older log fails, since it is no gzip file.
            file = folder / f"application_1700000000000_000{n}{'' if i == 5 else '.gz'}"
            file.write_text(lines(task(10 * i + n)))
            os.utime(file, (1_000_000 + i, 1_000_000 + i))
    got = {r["app"]: r["executor_run_time_ms"] for r in eventlog_metrics(read_event_logs(spark, str(tmp_path), names=2)).collect()}
    assert got == {"application_1700000000000_0001": 51, "application_1700000000000_0002": 52}
    with pytest.raises(Exception, match="gzip"):
        read_event_logs(spark, str(tmp_path), names=1).collect()


def test_ids_of_parent_folders_do_not_count(spark, tmp_path):
    root = tmp_path / "run-local-1764000000000" / "logs application_1600000000000_0001"
    (root / "app=application_1700000000000_0007").mkdir(parents=True)
    (root / "app=application_1700000000000_0007" / "part-0").write_text(lines(task(3)))
    (root / "app-20250101000000-0003" / "again").mkdir(parents=True)
    (root / "app-20250101000000-0003" / "again" / APP).write_text(lines(task(4)))
    (root / "spark-4f2a.json").write_text(lines(task(5)))
    for asked in (str(root), f"file://{root}/", str(tmp_path / "run-local-1764000000000" / "logs*")):
        got = {r["app"]: r["executor_run_time_ms"] for r in eventlog_metrics(read_event_logs(spark, asked)).collect()}
        expected = {"application_1700000000000_0007": 3, APP: 4, "spark-4f2a": 5}
        if asked.endswith("*"):  # below the pattern's parent the folder's id is part of the path
            expected = {"application_1700000000000_0007": 3, APP: 4, "application_1600000000000_0001": 5}
        assert got == expected


def test_log_of_an_unknown_name_is_kept(spark, tmp_path):
    task = '{"Event": "SparkListenerTaskEnd", "Task Metrics": {"Executor Run Time": 7}}'
    (tmp_path / "spark-4f2a.json").write_text(task)
    (tmp_path / "app-20260101000000-0001").write_text(task)
    got = {r["app"]: r["executor_run_time_ms"] for r in eventlog_metrics(read_event_logs(spark, str(tmp_path))).collect()}
    assert got == {"spark-4f2a": 7, "app-20260101000000-0001": 7}


def test_run_logs(spark, tmp_path):
    (tmp_path / "a.log").write_text(
        "INFO application_1700000000000_1 then application_1700000000000_22\n>>> Step 1 completed in 8.250000 seconds\n"
        ">>> Step 5a completed in 3.5 seconds\nnoise\nINFO application_1700000000000_23 RUNNING\n"
        ">>> Step 1 completed in 9.5 seconds\nTotal execution time: 99.125 seconds\n"
    )
    (tmp_path / "b.log").write_text("nothing\n")
    got = {r["file"][-5:]: r for r in runlog_scrape(spark, str(tmp_path), "*.log").collect()}
    a, b = got["a.log"], got["b.log"]
    assert (a["AppID"], a["S1"], a["S5a"], a["S2"], a["TotalTime"]) == ("application_1700000000000_23", 9.5, 3.5, 0.0, 99.125)
    assert b["AppID"] is None and b["TotalTime"] == 0.0


def run(kind, execs, cores, data, app, ms, run=1, total=None, stage=1.0):
    values = dict.fromkeys(R.RUN_COLUMNS, 0.0)
    values.update(
        Type=kind, Execs=execs, Cores=cores, TotalCores=execs * cores, MemGB=8, Data=data, AppID=app, AppTimeMs=ms,
        TotalTime=ms / 1000 if total is None else total, ExecRunTimeMs=4 * ms, Parallelism=4.0, GCMs=ms // 10,
        GCRatio=0.025, ShuffleReadMs=ms // 20, ShuffleWriteMs=1.5, CommMs=ms / 20 + 1.5, CommRatio=0.0125,
        ComputeMs=3.0 * ms, ComputeRatio=0.75, MemSpillMB=1024.0 * execs, DiskSpillMB=512.0, PeakHeapMB=2048.0 + execs,
        Run=run,
    )
    values.update(dict.fromkeys(R.STAGE_COLUMNS, stage))
    return [values[c] for c in R.RUN_COLUMNS]


RUNS = [
    run("Strong", 2, 4, "small_2", "a1", 8000), run("Strong", 2, 4, "small_2", "a2", 10000, 2),
    run("Strong", 4, 4, "small_2", "a3", 6000), run("Strong", 8, 4, "small_2", "a4", 4000),
    run("Weak", 1, 2, "small_1", "b1", 5000), run("Weak", 2, 2, "small_2", "b2", 8000),
    run("Weak", 2, 4, "small_1", "c1", 4000), run("Weak", 4, 4, "small_2", "c2", 5000),
    run("MemoryStudy", 8, 2, "small_8", "d1", 9000), run("MemoryStudy", 8, 2, "small_8", "d2", 9000),
    run("Weak", 16, 2, "small_16", "f1", 7000, total=0.0, stage=0.0),
]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("runs")
    text = lambda rows: "\n".join(",".join(str(v) for v in r) for r in rows)
    (folder / "one.csv").write_text(",".join(R.RUN_COLUMNS).replace("GCMs", "GCms") + "\n" + text(RUNS[:8]))
    (folder / "two.csv").write_text(text(RUNS[8:]))
    return R.read_runs(spark, str(folder)).cache()


def test_read_dedup_status(spark, table, tmp_path):
    assert table.count() == 11 and table.schema == R.RUN_SCHEMA
    assert R.run_dedup(table).count() == 10
    assert rows(R.run_status(table).where("status = 'failed'").select("AppID")) == [("f1",)]
    R.append_runs(table.limit(3), str(tmp_path / "t"))
    R.append_runs(table.limit(2), str(tmp_path / "t"))
    assert R.read_runs(spark, str(tmp_path / "t")).count() == 5


def test_empty_type_and_bad_cells(spark, tmp_path):
    good = ["", *[str(v) for v in RUNS[0][1:]]]
    bad = [str(v) for v in RUNS[0]]
    bad[R.RUN_COLUMNS.index("Execs")] = "two"
    (tmp_path / "r.csv").write_text("\n".join(",".join(r) for r in (R.RUN_COLUMNS, good, bad)))
    got = R.read_runs(spark, str(tmp_path))
    assert {(r["Type"], r["Execs"]) for r in got.collect()} == {(None, 2), ("Strong", None)}
    assert rows(R.unread_cells(spark, str(tmp_path))) == [("Execs", "two", 1)]


def test_enrich(spark, table):
    done = R.run_enrich(table, R.data_sizes(spark))
    row = done.where("AppID = 'a1'").first()
    assert (row["AppTimeSec"], row["MemSpillGB"], row["DatasetSizeGB"], row["TimePerCore"], row["TimePerUnit"]) == (8, 2, 7.8, 1, 4)
    unknown = table.withColumn("Data", F.lit("tiny"))
    with pytest.raises(Exception, match="unknown data set: tiny"):
        R.run_enrich(unknown, R.data_sizes(spark)).select("DatasetSizeGB").collect()
    assert R.run_enrich(unknown, R.data_sizes(spark), strict=False).where("DatasetSizeGB IS NULL").count() == 11


def test_scaling(spark, table):
    done = R.run_enrich(R.run_status(table).where("status = 'ok'"), R.data_sizes(spark)).cache()
    strong = {r["TotalCores"]: r for r in R.strong_scaling(done.where("Type = 'Strong'")).collect()}
    assert strong[8]["Speedup"] == 1 and strong[16]["Speedup"] == 1.5 and strong[32]["Speedup"] == 2.25
    assert strong[32]["IdealSpeedup"] == 4 and strong[32]["Efficiency"] == 56.25 and strong[32]["Utilization"] == 12.5
    weak = {(r["Cores"], r["TotalCores"]): r["Efficiency"] for r in R.weak_scaling(done.where("Type = 'Weak'")).collect()}
    assert weak == {(2, 2): 100, (2, 4): 62.5, (4, 8): 100, (4, 16): 80}
    memory = {r["Configuration"]: r["MemSpillGB"] for r in R.memory_profile(done).collect()}
    assert memory == {
        "Strong Scaling (Min Cores)": 2, "Strong Scaling (Max Cores)": 8, "Weak Scaling (2 cores/exec)": 1.5,
        "Weak Scaling (4 cores/exec)": 3,
    }
    best = {r["Best"]: (r["Execs"], r["Value"]) for r in R.best_runs(done).collect()}
    assert best == {"time": (2, 4.0), "time per core": (8, 0.125), "time per unit": (4, 2.5)}
    assert set(R.report_tables(done)) == {
        "strong_performance", "strong_breakdown", "stage_strong_time", "weak_comparison", "memory_analysis",
        "best_configs", "parallelism", "strong_spill", "stage_weak_time", "weak_shuffle",
    }
    summary = R.run_summary(done).first()
    assert (summary["Runs"], summary["StrongRuns"], summary["BestConfig"], summary["AvgGCRatio"]) == (10, 4, "2x4", 2.5)


def test_configurations_are_averaged_first(spark):
    """Two memory sizes at one core count and uneven repetitions; a failed run does not count."""
    made = [
        run("Strong", 1, 4, "small_2", "a", 8000), run("Strong", 1, 4, "small_2", "b", 12000, 2),
        run("Strong", 2, 4, "small_2", "c", 4000), run("Strong", 2, 4, "small_2", "d", 4000, 2),
        run("Strong", 2, 4, "small_2", "e", 4000, 3), run("Strong", 2, 4, "small_2", "f", 10000),
        run("Strong", 2, 4, "small_2", "g", 1, total=0.0),
    ]
    at = R.RUN_COLUMNS.index("MemGB")
    made[5][at] = 16
    types = {"string": str, "int": int, "bigint": int, "double": float}
    typed = [[types[f.dataType.simpleString()](v) for f, v in zip(R.RUN_SCHEMA, r)] for r in made]
    runs = R.completed(R.run_enrich(spark.createDataFrame(typed, R.RUN_SCHEMA), R.data_sizes(spark)))
    strong = {r["TotalCores"]: r for r in R.strong_scaling(runs).collect()}
    # Configurations: 10 s on 4 cores; 4 s and 10 s on 8.
    assert (strong[4]["AppTimeSec"], strong[4]["Speedup"], strong[4]["Efficiency"]) == (10, 1, 100)
    assert (strong[8]["AppTimeSec"], strong[8]["Speedup"], strong[8]["Efficiency"]) == (7, 1.75, 87.5)
    best = R.best_configurations(runs).first()
    assert (best["Execs"], best["AppTimeSec"], best["Efficiency"]) == (2, 4, 125)
    weak = R.weak_scaling(runs.withColumn("Type", F.lit("Weak")))
    assert sorted((r["Execs"], r["MemGB"], r["Efficiency"]) for r in weak.collect()) == [(1, 8, 100), (2, 8, 250), (2, 16, 100)]
    stages = {r["TotalCores"]: r["S1"] for r in R.stage_time_by_group(runs, ["TotalCores"]).collect()}
    assert stages == {4: 1, 8: 1}


def test_statistics(spark):
    rng = random.Random(1)
    data = [("hot", float(int(rng.lognormvariate(3, 2)))) for _ in range(3000)] + [("flat", 5.0)] * 40 + [("one", 7.0), ("two", 1.0), ("two", 2.0), ("none", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(8)
    got = {r["g"]: r for r in quantiles_by_group(df, ["g"], "v", slices=16).collect()}
    hot = sorted(v for g, v in data if g == "hot")
    quartiles = statistics.quantiles(hot, n=4, method="inclusive")
    assert [got["hot"][c] for c in ("q1", "median", "q3")] == pytest.approx(quartiles)
    assert (got["hot"]["min"], got["hot"]["max"]) == (hot[0], hot[-1])
    assert got["two"]["median"] == 1.5 and got["one"]["q1"] == 7 and got["flat"]["q3"] == 5 and "none" not in got
    spread = {r["g"]: r for r in mean_std_by_group(df, ["g"], ["v"]).collect()}
    assert spread["two"]["v_std"] == pytest.approx(0.5**0.5) and spread["one"]["v_std"] is None
    ratio = rows(baseline_ratio(df.where("g = 'two'"), ["g"], ["v"], "v").select("v", "ratio"))
    assert ratio == [(1.0, 1.0), (2.0, 0.5)]
    assert rows(best_row_by_group(df.where("g in ('two', 'none')"), ["g"], "v", ["v"])) == [("two", 1.0)]


def test_sketches_of_appended_batches(spark, tmp_path):
    path, n = str(tmp_path / "sketches"), 200_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 5)).alias("g"),
        (F.pow(F.pmod(F.xxhash64("id"), F.lit(99_991)), 2)).alias("v"), (F.col("id") % 2).alias("batch"),
    )
    odd = spark.createDataFrame([("hot", None), ("hot", float("nan")), ("empty", None), (None, 4.0)], "g string, v double")
    for batch in (0, 1):
        quantile_sketches(rows.where(F.col("batch") == batch), ["g"], "v").write.mode("append").parquet(path)
    quantile_sketches(odd, ["g"], "v").write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    assert stored.agg(F.max(F.length("sketch"))).first()[0] < 40_000
    probs = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = {r["g"]: r for r in sketch_quantiles(merge_sketches(stored, ["g"]), ["g"], probs).collect()}
    values = {}
    for r in rows.select("g", "v").collect():
        values.setdefault(r["g"], []).append(r["v"])
    assert got.keys() == values.keys() | {None} and got[None]["p50"] == 4.0 and got[None]["n"] == 1
    for g, own in values.items():
        assert got[g]["n"] == len(own) and got[g]["p0"] == min(own) and got[g]["p100"] == max(own)
        for name, p in probs.items():
            below, upto = sum(v < got[g][name] for v in own), sum(v <= got[g][name] for v in own)
            assert below / len(own) - 0.01 <= p <= upto / len(own) + 0.01


def test_best_row_sorts_only_rows_that_have_the_smallest_metric(spark):
    nan = float("nan")
    data = [("a", 2.0, "x"), ("a", 1.0, "z"), ("a", 1.0, "y"), ("a", None, "w"), (None, 3.0, "n"), (None, nan, "m"), ("b", nan, "q"), ("c", None, "r"), ("d", -0.0, "t"), ("d", 0.0, "s")]
    best = best_row_by_group(spark.createDataFrame(data, "g string, v double, t string"), ["g"], "v", ["t"])
    assert {(r["g"], r["t"]) for r in best.collect()} == {("a", "y"), (None, "n"), ("b", "q"), ("d", "s")}
    plan = best._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and plan.index("Aggregate") < plan.index("LeftSemi")

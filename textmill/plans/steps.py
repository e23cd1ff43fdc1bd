"""Steps of a job as tables that outlive a crash and go when nobody reads them any more.

A step names the steps that it reads and a function of their tables. Its rows are written
under the job's folder; then one small file, put in place by a rename, says that it is done, with
its rows, its schema and what was observed of it on the way. A job that starts again under the
same folder runs only steps without that file whose rows somebody still needs. A table is removed
once every step that reads it is done, unless the caller wants it.

Steps that do not need each other run at the same time, each as a job group of its own; the
first failure cancels the others.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.session import discard


@dataclass(frozen=True)
class Step:
    """``make`` takes the tables of ``reads`` in order. ``faults`` are conditions that no row
    should meet; more than a share ``limit`` of rows that meet one fails the step."""

    name: str
    reads: tuple[str, ...]
    make: Callable[..., DataFrame]
    faults: dict[str, Column] = field(default_factory=dict)
    limit: float = 0.0


class StepFault(ValueError):
    """Too many rows of a step met a fault."""


def contract_faults(contract: T.StructType) -> dict[str, Column]:
    """Nulls of every column, and empty strings and arrays."""
    faults = {}
    for f in contract.fields:
        faults[f"{f.name}: null"] = F.col(f.name).isNull()
        if isinstance(f.dataType, T.StringType):
            faults[f"{f.name}: empty"] = F.col(f.name) == ""
        elif isinstance(f.dataType, T.ArrayType):
            faults[f"{f.name}: empty"] = F.size(f.name) == 0
    return faults


class StepRun:
    """The job in ``folder``. ``key`` names its inputs and settings; a folder made under another key is refused."""

    def __init__(self, spark: SparkSession, folder: str, steps: list[Step], key: str = ""):
        self.spark, self.folder, self.steps = spark, folder.rstrip("/"), {s.name: s for s in steps}
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._system = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        held = self._read("job")
        if held is None:
            self._write("job", {"key": key})
        elif held["key"] != key:
            raise ValueError(f"{folder} belongs to the job {held['key']!r}, not {key!r}")

    # --- the manifest --------------------------------------------------------------------------

    def _read(self, name: str) -> dict | None:
        place = self._path(f"{self.folder}/_manifest/{name}.json")
        if not self._system.exists(place):
            return None
        stream = self._system.open(place)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _write(self, name: str, entry: dict) -> None:
        """Written aside and renamed, so that a file that is there is whole."""
        place, aside = self._path(f"{self.folder}/_manifest/{name}.json"), self._path(f"{self.folder}/_manifest/.{name}.new")
        stream = self._system.create(aside, True)
        try:
            stream.write(bytearray(json.dumps(entry).encode()))
        finally:
            stream.close()
        self._system.delete(place, False)
        self._system.rename(aside, place)

    def done(self, name: str) -> bool:
        return self._read(name) is not None

    def rows(self, name: str) -> int:
        return self._read(name)["rows"]

    def faults(self, name: str) -> dict[str, int]:
        """How many rows of a finished step met each of its faults."""
        return self._read(name)["faults"]

    def present(self, name: str) -> bool:
        """Whether the step is done and its table has not been removed."""
        return self.done(name) and self._system.exists(self._path(f"{self.folder}/{name}"))

    def table(self, name: str) -> DataFrame:
        entry = self._read(name)
        if entry is None:
            raise ValueError(f"step {name} is not done")
        return self.spark.read.schema(T.StructType.fromJson(entry["schema"])).parquet(f"{self.folder}/{name}")

    # --- running -------------------------------------------------------------------------------

    def _missing(self, wanted: list[str]) -> list[str]:
        """Steps to run for the wanted tables, in the order in which they were given."""
        need, stack = set(), list(wanted)
        while stack:
            name = stack.pop()
            if name not in need and not self.present(name):
                need.add(name)
                stack.extend(self.steps[name].reads)
        return [name for name in self.steps if name in need]

    def _make(self, name: str) -> None:
        step = self.steps[name]
        self.spark.sparkContext.setJobGroup(f"{self.folder}:{name}", name, interruptOnCancel=True)
        made = step.make(*[self.table(r) for r in step.reads])
        seen = Observation(f"step {name}")
        counts = [F.count_if(fault).alias(f"f{i}") for i, fault in enumerate(step.faults.values())]
        made.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).write.mode("overwrite").parquet(f"{self.folder}/{name}")
        found = seen.get
        faults = {label: found[f"f{i}"] for i, label in enumerate(step.faults)}
        over = {label: n for label, n in faults.items() if n > step.limit * found["rows"]}
        if over:
            raise StepFault(f"step {name}, {found['rows']} rows: {over}")
        self._write(name, {"rows": found["rows"], "faults": faults, "schema": json.loads(made.schema.json())})

    def _drop_unread(self, wanted: list[str], pending: set[str]) -> None:
        read_later = {r for name in pending for r in self.steps[name].reads}
        for name in self.steps:
            if name not in wanted and name not in pending and name not in read_later and self.present(name):
                discard(self.spark, f"{self.folder}/{name}")

    def run(self, wanted: list[str], at_once: int = 2) -> dict[str, DataFrame]:
        """The wanted tables; ``at_once`` steps run at the same time."""
        order = self._missing(wanted)
        pending, running = set(order), {}
        with ThreadPoolExecutor(at_once) as pool:
            while pending:
                ready = [n for n in order if n in pending and n not in running.values() and not pending & set(self.steps[n].reads)]
                for name in ready[: at_once - len(running)]:
                    running[pool.submit(inheritable_thread_target(self.spark)(self._make), name)] = name
                finished: set[Future] = wait(running, return_when=FIRST_COMPLETED).done
                failed = [f for f in finished if f.exception() is not None]
                if failed:
                    others = {f: name for f, name in running.items() if f not in finished}
                    # Again and again: a step may be between two jobs, or before its first.
                    while not all(f.done() for f in others):
                        for name in others.values():
                            self.spark.sparkContext.cancelJobGroup(f"{self.folder}:{name}")
                        wait(others, timeout=0.5)
                    raise failed[0].exception()
                pending -= {running.pop(f) for f in finished}
                self._drop_unread(wanted, pending)
        return {name: self.table(name) for name in wanted}

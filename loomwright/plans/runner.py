"""A pipeline of named stages: its plan can be shown without running it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from loomwright.session import exists
from loomwright.sources.sinks import write_table

Stage = Callable[[SparkSession, dict[str, DataFrame]], DataFrame]


@dataclass
class Pipeline:
    """Stages in order; each sees the results of those before it and is written before the next begins."""

    folder: str
    stages: list[tuple[str, Stage]] = field(default_factory=list)
    tolerated: set[str] = field(default_factory=set)

    def stage(self, name: str, may_fail: bool = False) -> Callable[[Stage], Stage]:
        def add(f: Stage) -> Stage:
            self.stages.append((name, f))
            if may_fail:
                self.tolerated.add(name)
            return f

        return add

    def plan(self) -> list[str]:
        """What a run would do; nothing is read or written."""
        return [f"{name}: {f.__doc__ or f.__name__} -> {self.folder}/{name}" for name, f in self.stages]

    def run(self, spark: SparkSession, inputs: dict[str, DataFrame], only: str | None = None, rebuild: bool = False, smoke: dict[str, int] | None = None) -> dict[str, DataFrame]:
        """Results by name; a stage whose table is complete is not run again unless ``rebuild``.

        ``smoke`` limits inputs for a trial run.  A stage that may fail leaves no result, and the
        next ones go on without it; any other failure ends the run.
        """
        done = {k: v.limit(smoke[k]) if smoke and k in smoke else v for k, v in inputs.items()}
        for name, f in self.stages:
            path = f"{self.folder}/{name}"
            try:
                if rebuild or not exists(spark, f"{path}/_SUCCESS"):
                    write_table(f(spark, done), path)
                done[name] = spark.read.parquet(path)
            except Exception:
                if name not in self.tolerated:
                    raise
            if name == only:
                break
        return done

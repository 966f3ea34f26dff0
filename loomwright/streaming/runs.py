"""Tables kept as runs: what a batch brings is written once, and merged later with runs of its size.

A version is a document that names the runs of the table.  It is made once, whoever tries,
so a batch that is repeated after a crash counts once, and what was written without a
version counts never.  ``FAN`` runs of one level, the logarithm of their rows, are merged to
one: a row is written again as often as there are levels, and a large run is left alone by
small batches.
Readers of an older version keep it until ``vacuum``.
"""

from __future__ import annotations

import json
import math
import uuid
from collections import Counter
from collections.abc import Callable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.plans.leases import create_once
from loomwright.session import file_at
from loomwright.sources.sinks import read_json_document

FAN = 4


class Runs:
    """``merge`` makes one run of several; ``by`` are columns by which a run's files are parted."""

    def __init__(self, spark: SparkSession, path: str, schema, merge: Callable[[DataFrame], DataFrame] = lambda df: df, by: Sequence[str] = (), fan: int = FAN):
        self.spark, self.path, self.schema, self.merge, self.by, self.fan = spark, path.rstrip("/"), schema, merge, list(by), fan

    def _names(self, folder: str) -> list[str]:
        where, files = file_at(self.spark, f"{self.path}/{folder}")
        return [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []

    def numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names("versions") if n.endswith(".json") and n[:-5].isdigit())

    def newest(self) -> int:
        """The number of the last version, -1 if there is none."""
        return max(self.numbers(), default=-1)

    def runs(self, number: int | None = None) -> list[dict[str, Any]]:
        number = self.newest() if number is None else number
        return read_json_document(self.spark, f"{self.path}/versions/{number:08d}.json")["runs"] if number >= 0 else []

    def rows(self, number: int | None = None, runs: list[dict[str, Any]] | None = None) -> DataFrame:
        """Rows of all runs of a version, not merged."""
        runs = self.runs(number) if runs is None else runs
        parts = [self.spark.read.schema(self.schema).parquet(f"{self.path}/data/{r['run']}") for r in runs]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], self.schema)

    def table(self, number: int | None = None) -> DataFrame:
        """The table at a version, merged as it is read."""
        return self.merge(self.rows(number))

    def _write(self, rows: DataFrame) -> dict[str, Any]:
        name = f"run-{uuid.uuid4().hex}"
        # Each file of a run is written by one task.
        (rows.repartition(*self.by).write.partitionBy(*self.by) if self.by else rows.write).parquet(f"{self.path}/data/{name}")
        n = self.rows(runs=[{"run": name}]).count()
        return {"run": name, "rows": n, "level": int(math.log(max(n, 1), self.fan))}

    def add(self, batch: DataFrame, number: int | None = None) -> int:
        """The version that has the batch.  A number that there is already is a batch that came before."""
        done = self.newest()
        number = done + 1 if number is None else number
        if number <= done:
            return number
        runs = [*self.runs(done), self._write(self.merge(batch))]
        self._commit(number, self._settled(runs))
        return number

    def _settled(self, runs: list[dict[str, Any]]) -> list[dict[str, Any]]:
        """Runs after all merges that are due."""
        while crowded := [n for n, k in Counter(r["level"] for r in runs).items() if k >= self.fan]:
            same = [r for r in runs if r["level"] == min(crowded)]
            runs = [r for r in runs if r["level"] != min(crowded)] + [self._write(self.merge(self.rows(runs=same)))]
        return runs

    def _commit(self, number: int, runs: list[dict[str, Any]]) -> None:
        create_once(self.spark, f"{self.path}/versions/{number:08d}.json", json.dumps({"runs": runs}))

    def vacuum(self, keep: int = 1) -> int:
        """Remove versions but the last ``keep``, and all runs that none of these has; how many runs went.  No batch may be on its way."""
        numbers = self.numbers()
        used = {r["run"] for n in numbers[-keep:] for r in self.runs(n)}
        gone = [n for n in self._names("data") if n not in used]
        for path in [f"versions/{n:08d}.json" for n in numbers[:-keep]] + [f"data/{n}" for n in gone]:
            where, files = file_at(self.spark, f"{self.path}/{path}")
            files.delete(where, True)
        return len(gone)


def bucket(key, buckets: int):
    """Which of so many files of a run a key is in."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

"""Leases with fencing, by nothing but the making of files that must not be there yet.

Each key has numbered records, in one of ``BUCKETS`` folders.  Whoever makes the next number holds what it
says: a lease, its renewal, its release, or the completion that ends the key's story.  A
lease's number is its token.  Completing with a token means to make the number after it,
so a worker whose lease was taken over, which made that number, can no longer complete:
the check and the commit are one step.  The store must make a file only if there is none:
file systems do, object stores do with conditional writes.

Many keys are asked for at once.  Where the folder is in a file system, tasks make and read the
records; elsewhere threads of the driver do, by Spark's way to the store.
"""

from __future__ import annotations

import json
import os
import time
import urllib.parse
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.session import exists, file_at
from loomwright.sources.sinks import read_json_document

#: Seconds after which a lease may be taken over, and folders that records are dealt to.
CLAIM_SECONDS, BUCKETS = 1800, 64
#: Keys that threads ask for at once, and keys for which tasks are started; keys in a task.
ASKED, MANY, TASK_KEYS = 16, 64, 256
RECORD = "kind string, key string, token long, owner string, at double, value string"


class Fenced(RuntimeError):
    """A lease that another worker has taken over."""


def _create_local(target: str, text: str) -> bool:
    part = f"{target}.{uuid.uuid4().hex}.part"
    try:
        f = open(part, "w", encoding="utf-8")
    except FileNotFoundError:
        os.makedirs(os.path.dirname(target), exist_ok=True)
        f = open(part, "w", encoding="utf-8")
    with f:
        f.write(text)
    try:
        os.link(part, target)  # fails where the name is taken
        return True
    except FileExistsError:
        return False
    finally:
        os.unlink(part)


def _read_local(path: str) -> Any:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file with its whole text, unless there is one."""
    where, files = file_at(spark, path)
    if str(files.getUri().getScheme()) == "file":
        return _create_local(where.toUri().getPath(), text)
    try:
        out = files.create(where, False)
        out.write(bytearray(text.encode()))
        out.close()  # conditional stores decide here
        return True
    except Exception as e:
        if "exist" in str(e).lower() or "precondition" in str(e).lower():
            return False
        raise


@dataclass(frozen=True)
class _Records:
    """The records in a folder, by the three things that a store does; those of a file system can be sent to tasks."""

    folder: str
    owner: str
    exists: Callable[[str], bool]
    read: Callable[[str], Any]
    create: Callable[[str, str], bool]

    def of(self, key: str, number: int) -> str:
        return f"{self.folder}/{zlib.crc32(key.encode()) % BUCKETS:02d}/{urllib.parse.quote(key, safe='')}.{number:08d}.json"

    def last(self, key: str, now: float) -> tuple[int, dict[str, Any] | None]:
        number = 0
        while self.exists(self.of(key, number + 1)):  # numbers are made one after the other
            number += 1
        if not number:
            return 0, None
        try:
            return number, self.read(self.of(key, number))
        except ValueError:  # being written just now
            return number, {"kind": "lease", "at": now, "owner": ""}

    def make(self, kind: str, key: str, number: int, now: float, value: Any = None) -> bool:
        row = {"kind": kind, "key": key, "token": number, "owner": self.owner, "at": now, "value": None if value is None else json.dumps(value, sort_keys=True)}
        return self.create(self.of(key, number), json.dumps(row))

    def acquire(self, key: str, now: float, ttl: float, asked: str | None = None) -> int | None:
        number, last = self.last(key, now)
        if asked and last and last["kind"] == "lease" and last.get("value") == json.dumps(asked):
            return number  # a first try of the same task made it
        if last and (last["kind"] == "done" or last["kind"] == "lease" and now - last["at"] <= ttl):
            return None
        return number + 1 if self.make("lease", key, number + 1, now, asked) else None


def _completed_local(folder: str, bucket: str) -> Iterator[tuple[str, str]]:
    """(key, value) of what is completed in a bucket: a completion is the last record of its key, so no other is read."""
    last: dict[str, str] = {}
    try:
        names = os.listdir(f"{folder}/{bucket}")
    except FileNotFoundError:
        return
    for name in names:
        if name.endswith(".json"):
            key = name[:-14]
            last[key] = max(last.get(key, ""), name)
    for name in last.values():
        row = _read_local(f"{folder}/{bucket}/{name}")
        if row["kind"] == "done":
            yield row["key"], row["value"]


class Leases:
    def __init__(self, spark: SparkSession, folder: str, owner: str | None = None, ttl: float = CLAIM_SECONDS, now: Callable[[], float] = time.time):
        self.spark, self.folder, self.ttl, self.now = spark, folder.rstrip("/"), ttl, now
        self.owner = owner or uuid.uuid4().hex

        where, files = file_at(spark, self.folder)
        self.local = str(files.getUri().getScheme()) == "file"
        if self.local:
            self.records = _Records(where.toUri().getPath(), self.owner, os.path.exists, _read_local, _create_local)
        else:
            self.records = _Records(self.folder, self.owner, lambda p: exists(spark, p), lambda p: read_json_document(spark, p), lambda p, t: create_once(spark, p, t))

    def _make(self, kind: str, key: str, number: int, value: Any = None) -> bool:
        return self.records.make(kind, key, number, self.now(), value)

    def _each(self, do: Callable[[_Records, Any], Any], items: Iterable[Any]) -> list[Any]:
        """What ``do`` gives for each item, in their order: in tasks, if there are many and the records are in a file system."""
        items, records = list(items), self.records
        if not self.local or len(items) < MANY:
            with ThreadPoolExecutor(ASKED) as pool:
                return list(pool.map(lambda x: do(records, x), items))
        context = self.spark.sparkContext
        return context.parallelize(items, min(4 * context.defaultParallelism, -(-len(items) // TASK_KEYS))).map(lambda x: do(records, x)).collect()

    def acquire(self, key: str) -> int | None:
        """A token, or none while another one holds the key or the key is completed."""
        return self.records.acquire(key, self.now(), self.ttl)

    def acquire_all(self, keys: Iterable[str]) -> list[int | None]:
        """``acquire`` of many keys."""
        now, ttl, asked = self.now(), self.ttl, uuid.uuid4().hex
        return self._each(lambda records, key: records.acquire(key, now, ttl, asked), keys)

    def complete_all(self, done: Iterable[tuple[str, int, Any]]) -> list[bool]:
        """``complete`` of many (key, token, value): whether the lease was still one's own."""
        now = self.now()
        return self._each(lambda records, x: records.make("done", x[0], x[1] + 1, now, x[2]), done)

    def release_all(self, held: Iterable[tuple[str, int]]) -> None:
        """``release`` of many (key, token)."""
        now = self.now()
        self._each(lambda records, x: records.make("free", x[0], x[1] + 1, now), held)

    def renew(self, key: str, token: int) -> int:
        """A new token for a lease that is still one's own."""
        if not self._make("lease", key, token + 1):
            raise Fenced(key)
        return token + 1

    def release(self, key: str, token: int) -> None:
        self._make("free", key, token + 1)  # if it was taken over, there is nothing to give up

    def complete(self, key: str, token: int, value: Any) -> None:
        if not self._make("done", key, token + 1, value):
            raise Fenced(key)

    def completed(self, value: str) -> DataFrame:
        """(key, ...) of what is completed; ``value`` is the schema of what was left with it."""
        if not exists(self.spark, self.folder):
            rows = self.spark.createDataFrame([], RECORD)
        elif self.local:
            folder = self.records.folder

            def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for n in batch.column(0).to_pylist():
                        found = list(_completed_local(folder, f"{n:02d}"))
                        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.string()) for i in (0, 1)], ["key", "value"])

            # Each bucket is read by one task; Spark's reader would list all records of all keys on the driver, and read some to a task.
            rows = self.spark.range(0, BUCKETS, 1, BUCKETS).mapInArrow(read, "key string, value string").withColumn("kind", F.lit("done"))
        else:
            rows = self.spark.read.schema(RECORD).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(self.folder)
        return rows.filter("kind = 'done'").select("key", F.from_json("value", value).alias("v")).select("key", "v.*")

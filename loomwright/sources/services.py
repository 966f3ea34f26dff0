"""Sources behind a service: texts, packages and categories, asked for with patience, and files that are fetched once."""

from __future__ import annotations

import base64
import json
import time
import uuid
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.functions.latex import LEAST_BYTES
from loomwright.operators.relational import latest
from loomwright.session import dealt, exists, file_at, settled
from loomwright.sources.archives import located
from loomwright.streaming.runs import Runs

#: Seconds to wait for a busy service that does not say, the longest wait, and papers in one question.
BUSY_WAIT, LONGEST_WAIT, CATEGORY_BATCH = 5.0, 60.0, 50
ATOM = "{http://www.w3.org/2005/Atom}"
ANSWERS = "arxiv_id string, content binary, attempts int, error string"

#: What a service answers: status, headers and body.
Answer = tuple[int, dict[str, str], bytes]


def wait_before(attempt: int, status: int | None, headers: dict[str, str], delay: float) -> float:
    """Seconds to wait after the n-th attempt: what a busy service asks for, else longer each time."""
    if status == 429:
        asked = next((v for k, v in headers.items() if k.lower() == "retry-after"), "")
        return float(asked) if asked.isdigit() else BUSY_WAIT
    return min(LONGEST_WAIT, delay * 2 ** (attempt - 1))


def refusal(body: bytes) -> str | None:
    """Why a downloaded text is not taken: too few bytes, or a web page."""
    if len(body) < LEAST_BYTES:
        return f"response too small: {len(body)} bytes"
    head = body.decode("utf-8", "replace").strip()[:500].lower()
    return "received HTML instead of Markdown" if "<html" in head or "<!doctype html" in head else None


def asked(name: str, fetch: Callable[[str], Answer], retries: int, delay: float, refuse: Callable[[bytes], str | None] | None, only_busy: bool, sleep: Callable[[float], None]) -> tuple[bytes | None, int, str | None]:
    """(body, attempts, error) of one question; ``only_busy`` asks again only where the service was busy."""
    error = None
    for k in range(1, retries + 1):
        status, headers = None, {}
        try:
            status, headers, body = fetch(name)
            error = f"status {status}" if status != 200 else refuse(body) if refuse else None
            if error is None:
                return body, k, None
        except Exception as e:  # whatever a service does is an answer about one paper, never the end of the job
            error = f"{type(e).__name__}: {e}"[:300]
        if k == retries or only_busy and status != 429:
            break
        sleep(wait_before(k, status, headers, delay))
    return None, k, error


def fetched(pending: DataFrame, fetch: Callable[[str], Answer], retries: int = 3, delay: float = 2.0, refuse: Callable[[bytes], str | None] | None = refusal, only_busy: bool = False, sleep: Callable[[float], None] = time.sleep, rate: float | None = None, slots: int = 4, journal: str | None = None) -> DataFrame:
    """(arxiv_id, content, attempts, error) for ids: one row each, whether it came or not.

    With a ``rate``, all tasks together ask so many times a second at most: ids are dealt to
    ``slots`` tasks, and each waits its share before every question, repeated ones included.
    With a ``journal``, each answer is saved there before the next question.  Without a rate,
    ids are dealt to all cores.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pace = _Pace(rate, slots)

        def paced(name: str) -> Answer:
            pace.wait()
            return fetch(name)

        saved = _Journal(journal) if journal else None
        for batch in batches:
            for name in batch.column(0).to_pylist():
                content, attempts, error = asked(name, paced, retries, delay, refuse, only_busy, sleep)
                if saved:
                    saved.save(name, content, attempts, error)
                yield pa.RecordBatch.from_arrays([pa.array([name], pa.string()), pa.array([content], pa.binary()), pa.array([attempts], pa.int32()), pa.array([error], pa.string())], ["arxiv_id", "content", "attempts", "error"])

    ids = pending.select("arxiv_id")
    return (ids.repartition(slots, "arxiv_id") if rate else dealt(ids, "arxiv_id")).mapInArrow(run, ANSWERS)


class _Journal:
    """Answers of one task, each of which is there once it is saved.

    File systems show what is written at once, so there a task's answers are lines of one file.
    Elsewhere a file is seen when it is closed, so each answer is a file.  A line that was cut
    lacks its last value, ``whole``.
    """

    def __init__(self, journal: str):
        self.store, self.folder = located(journal)
        self.store.create_dir(self.folder)
        self.lines = self._open() if self.store.type_name in ("local", "hdfs") else None

    def _open(self):
        return self.store.open_output_stream(f"{self.folder}/{uuid.uuid4().hex}.json")

    def save(self, name: str, content: bytes | None, attempts: int, error: str | None) -> None:
        row = {"arxiv_id": name, "content": None if content is None else base64.b64encode(content).decode(), "attempts": attempts, "error": error, "whole": True}
        out = self.lines or self._open()
        out.write(json.dumps(row).encode() + b"\n")
        out.flush() if self.lines else out.close()


class Fetched:
    """Answers of a service that outlast the job: saved one by one in files of tasks, then kept in runs.

    A job that is killed leaves all answers that came; the next one asks only for what is
    not there.  ``again`` asks once more for papers whose last answer was an error.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.journal = spark, f"{folder.rstrip('/')}/journal"
        self.runs = Runs(spark, f"{folder.rstrip('/')}/answers", ANSWERS + ", batch int", lambda df: latest(df, "arxiv_id", ["batch"]))

    def answers(self) -> DataFrame:
        return self.runs.table().drop("batch")

    def _keep(self) -> None:
        """Move what is in the journal to a run."""
        if not exists(self.spark, self.journal):
            return
        number = self.runs.newest() + 1
        rows = self.spark.read.schema("arxiv_id string, content string, attempts int, error string, whole boolean").json(self.journal).filter("whole").drop("whole")
        self.runs.add(rows.withColumn("content", F.unbase64("content")).withColumn("batch", F.lit(number)), number)
        where, files = file_at(self.spark, self.journal)
        files.delete(where, True)

    def fetch(self, pending: DataFrame, fetch: Callable[[str], Answer], batch: int = 200_000, again: bool = False, **how) -> DataFrame:
        """Answers for the ids, asked for in batches of so many papers."""
        self._keep()  # of a job that ended before it could
        done = self.runs.table().filter("error is null") if again else self.runs.table()
        todo = pending.select("arxiv_id").distinct().join(done.select("arxiv_id"), "arxiv_id", "left_anti")
        todo = settled(todo, "todo")
        n = todo.count()
        parts = -(-n // batch)
        for b in range(parts):
            some = todo.filter(F.pmod(F.xxhash64("arxiv_id"), F.lit(parts)) == b)
            fetched(some, fetch, journal=self.journal, **how).write.format("noop").mode("overwrite").save()
            self._keep()
        return self.answers().join(pending.select("arxiv_id").distinct(), "arxiv_id", "left_semi")


def packages(pending: DataFrame, fetch: Callable[[str], Answer], sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Source packages: asked for once more after a wait, and only where the service was busy."""
    return fetched(pending, lambda n: (lambda a: (a[0], {}, a[2]))(fetch(n)), 2, BUSY_WAIT, None, True, sleep)


def read_feed(feed: bytes, ids: list[str]) -> list[tuple[str, list[str], str]]:
    """(arxiv_id, categories, title) of the entries of a feed that were asked for."""
    out = []
    for entry in ElementTree.fromstring(feed).findall(f"{ATOM}entry"):
        name = (entry.findtext(f"{ATOM}id") or "").rsplit("/", 1)[-1].split("v")[0]
        if name in ids:
            out.append((name, [c.get("term", "") for c in entry.findall(f"{ATOM}category")], " ".join((entry.findtext(f"{ATOM}title") or "").split())))
    return out


def categories(papers: DataFrame, cached: DataFrame, fetch: Callable[[list[str]], bytes], batch: int = CATEGORY_BATCH, retries: int = 3, delay: float = 2.0, sleep: Callable[[float], None] = time.sleep, rate: float | None = None, slots: int = 4) -> DataFrame:
    """The cache (arxiv_id, categories, title) with what it lacked of ``papers``, asked for many at a time; new answers win.

    A question that fails is put again after a wait; if it fails to the end, its papers are
    left out, so the next run asks for them.  With a ``rate``, all tasks together ask so many
    questions a second at most.
    """
    todo = papers.select("arxiv_id").distinct().join(cached.select("arxiv_id"), "arxiv_id", "left_anti")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[str] = []
        pace = _Pace(rate, slots)

        def answer(ids: list[str]) -> pa.RecordBatch:
            rows = []
            for k in range(1, retries + 1):
                try:
                    pace.wait()
                    rows = read_feed(fetch(ids), ids)
                    break
                except Exception:  # a service's fault costs its papers, not the job
                    if k < retries:
                        sleep(wait_before(k, None, {}, delay))
            columns = list(zip(*rows)) or [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.list_(pa.string())), pa.array(columns[2], pa.string())], ["arxiv_id", "categories", "title"])

        for some in batches:
            waiting += some.column(0).to_pylist()
            while len(waiting) >= batch:
                yield answer(waiting[:batch])
                waiting = waiting[batch:]
        if waiting:
            yield answer(waiting)

    dealt = todo.repartition(slots, "arxiv_id") if rate else todo
    new = dealt.mapInArrow(ask, "arxiv_id string, categories array<string>, title string")
    return cached.select("arxiv_id", "categories", "title").unionByName(new)


class _Pace:
    """A task's share of a rate that all ``slots`` tasks keep together."""

    def __init__(self, rate: float | None, slots: int):
        self.step, self.due = slots / rate if rate else 0.0, time.monotonic()

    def wait(self) -> None:
        if self.step:
            left = self.due - time.monotonic()
            if left > 0:
                time.sleep(left)
            self.due = max(self.due, time.monotonic()) + self.step


def merged_manifests(rows: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """One row for each output_key of many archives' manifests, the last by ``order``."""
    return latest(rows, "output_key", order)


def to_fetch(manifest: DataFrame, present: DataFrame) -> DataFrame:
    """Rows of a manifest (output_key, size, sha256, ...) that are not there with this size and checksum."""
    return manifest.join(present.select("output_key", "size", "sha256").distinct(), ["output_key", "size", "sha256"], "left_anti")


def verified(wanted: DataFrame, got: DataFrame) -> DataFrame:
    """Files (output_key, content) that came, with their rows; one that is missing or not as the manifest says is an error."""
    from loomwright.operators.states import required

    joined = wanted.join(got.select("output_key", "content"), "output_key", "left")
    same = (F.length("content") == F.col("size")) & (F.sha2("content", 256) == F.col("sha256"))
    required(joined.filter(~F.coalesce(same, F.lit(False))), "checksum mismatch", "output_key")
    return joined.orderBy("month", "arxiv_id")

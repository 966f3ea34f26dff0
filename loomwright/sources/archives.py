"""Archives as streams, and by an index of their members; no archive is ever held whole.

An archive is read in one of two ways.  As a stream: from its beginning, member after
member, compressed or not, with one member in memory at a time.  By its index: a table of
(archive, member, offset, size), made by hopping from header to header, through which
tasks read members by range, so that many of them share one archive.  An archive that
cannot be read to its end gives what was read of it and a row that says why it ended; so
does one without the block of zeros that ends an archive: it was cut between two members.
"""

from __future__ import annotations

import fnmatch
import hashlib
import lzma
import re
import tarfile
import zlib
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: What a stream gives: packages of papers, and a last row with an error where the archive ends too early.
PACKAGES = "package string, member string, content binary, error string"
#: What an index gives; the row of an archive's end has no member, and an error if the archive is broken.
INDEX = "archive string, member string, offset long, size long, regular boolean, error string"
#: Bytes that are read at once, and of the largest member that a row holds.
BLOCK, MOST_BYTES = 8 << 20, 1 << 30
#: Packages, and bytes of them, in one batch; bytes of archives in one task, and what opening one counts for.
ROWS, ROWS_BYTES, TASK_BYTES, OPENING = 1000, 4 << 20, 128 << 20, 64 << 10
#: Fixed value: names of packages that come from the days of digits.
DIGITS = r"(?:\A|/)\.*[0-9][0-9.]*\.gz\Z"
BROKEN = (tarfile.TarError, OSError, EOFError, zlib.error, lzma.LZMAError)


def located(path: str) -> tuple[fs.FileSystem, str]:
    """(store, path inside it) of a path as Spark names it."""
    if "://" not in path:
        path = f"file://{path.removeprefix('file:')}"
    return fs.FileSystem.from_uri(path)


def said(error: BaseException) -> str:
    return f"{type(error).__name__}: {error}"[:300]


def walk(path: str, most: int = MOST_BYTES) -> Iterator[tuple[str | None, bytes | None, str | None]]:
    """(name, content, error) of the packages in an archive, which is read once from its beginning."""
    try:
        store, inside = located(path)
        with store.open_input_stream(inside, buffer_size=BLOCK) as body, tarfile.open(fileobj=body, mode="r|*") as archive:
            for m in archive:
                archive.members = []  # the archive keeps every header otherwise
                if m.isfile() and m.name.lower().endswith(".gz"):
                    if m.size > most:
                        yield m.name, None, f"a member of {m.size} bytes"
                    else:
                        yield m.name, archive.extractfile(m).read(), None
            if archive.fileobj.tell() < archive.offset + 512:
                raise EOFError(f"no end of the archive after {archive.offset} bytes")
    except BROKEN as e:
        yield None, None, said(e)


def _read(paths: Iterable[str], wanted: Callable[[str], bool] = lambda name: True, most: int = MOST_BYTES) -> Iterator[pa.RecordBatch]:
    """PACKAGES of archives, one after the other; a batch is a large package or some small ones."""
    rows: list[tuple] = []
    size = 0
    for path in paths:
        for name, content, error in walk(path, most):
            if error or wanted(name):
                if rows and (len(rows) == ROWS or size + len(content or b"") > ROWS_BYTES):
                    yield _batch(rows)
                    rows, size = [], 0
                rows.append((path, name, content, error))
                size += len(content or b"")
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.string(), pa.binary(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["package", "member", "content", "error"])


def packages(archives: DataFrame) -> DataFrame:
    """PACKAGES of archives (path), each read as a stream by one task."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _read(batch.column(0).to_pylist())

    return archives.select("path").mapInArrow(read, PACKAGES)


class _Some(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.pattern = options["path"], options.get("pattern", "*.tar")
        self.digits, self.most = options.get("onlydigits", "false").lower() == "true", int(options.get("mostbytes", MOST_BYTES))
        self.tasks = int(options.get("tasks", 64))

    def partitions(self) -> list[_Some]:
        store, inside = located(self.path)
        info = store.get_file_info(inside)
        prefix = self.path[: len(self.path) - len(inside)] if self.path.endswith(inside) else ""
        if info.type == fs.FileType.File:
            return [_Some([self.path])]
        found = store.get_file_info(fs.FileSelector(inside, recursive=True))
        files = [f for f in sorted(found, key=lambda f: f.path) if f.type == fs.FileType.File and fnmatch.fnmatch(f.base_name, self.pattern)]
        most = min(TASK_BYTES, sum(f.size + OPENING for f in files) // self.tasks)
        out, size = [], 0
        for f in files:
            if not out or size + f.size + OPENING > most:
                out.append(_Some([]))
                size = 0
            out[-1].paths.append(prefix + f.path)
            size += f.size + OPENING
        return out

    def read(self, partition: _Some) -> Iterator[pa.RecordBatch]:
        return _read(partition.paths, lambda name: not self.digits or bool(re.search(DIGITS, name)), self.most)


class PaperArchives(DataSource):
    """Packages of papers in the archives of a folder; small archives share a partition.

    Options: path (a folder or one archive), pattern of names, onlyDigits, mostBytes of a member, tasks that share the archives if they are small.
    """

    @classmethod
    def name(cls) -> str:
        return "paper_archives"

    def schema(self) -> str:
        return PACKAGES

    def reader(self, schema: Any) -> _Reader:
        return _Reader({k.lower(): v for k, v in self.options.items()})


def read_packages(spark: SparkSession, path: str, **options: Any) -> DataFrame:
    """PACKAGES of the archives below a path."""
    spark.dataSource.register(PaperArchives)
    return spark.read.format("paper_archives").options(**{"tasks": 4 * spark.sparkContext.defaultParallelism} | options).load(path)


def index(archives: DataFrame) -> DataFrame:
    """INDEX of uncompressed archives (path); only headers are read.

    An archive has to end with a block of zeros: one that was cut between two members ends
    with an error as well.
    """

    def hop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows: list[tuple] = []
                error, end = None, 0
                try:
                    store, inside = located(path)
                    with store.open_input_file(inside) as body:
                        length = body.size()
                        with tarfile.open(fileobj=body, mode="r:") as archive:
                            for m in archive:
                                archive.members = []
                                end = m.offset_data + (m.size + 511) // 512 * 512
                                rows.append((path, m.name, m.offset_data, m.size, m.isfile(), None))
                                if end > length:
                                    raise EOFError(f"{m.name} ends at {end} of {length} bytes")
                                if len(rows) == 10_000:
                                    yield _table(rows)
                                    rows = []
                            body.seek(min(archive.offset, length))
                            if body.read(512) != bytes(512) and archive.offset + 512 > length:
                                body.seek(min(end, length))
                                if body.read(512) != bytes(512):
                                    raise EOFError(f"no end of the archive after {end} bytes")
                except BROKEN as e:
                    error = said(e)
                yield _table([*rows, (path, None, None, None, None, error)])

    return archives.select("path").mapInArrow(hop, INDEX)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["archive", "member", "offset", "size", "regular", "error"])


def _ranges(path: str, offset: int, size: int, body: Any) -> Iterator[bytes]:
    body.seek(offset)
    while size > 0:
        some = body.read(min(BLOCK, size))
        if not some:
            raise EOFError(f"{path} ends inside a member")
        yield some
        size -= len(some)


def _per_member(indexed: DataFrame, column: str, kind: str, make: Any) -> DataFrame:
    """``indexed`` with a value made from the ranges of each member; an archive is opened once for neighbouring rows."""
    names = ["archive", "member", "offset", "size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, body = None, None
        try:
            for batch in batches:
                for one, name, offset, size in zip(*(c.to_pylist() for c in batch.columns)):
                    if one != path:
                        if body is not None:
                            body.close()
                        store, inside = located(one)
                        path, body = one, store.open_input_file(inside)
                    value = make(_ranges(path, offset, size, body), size)
                    yield pa.RecordBatch.from_arrays([pa.array([one]), pa.array([name]), pa.array([offset]), pa.array([size]), pa.array([value], pa.string() if kind == "string" else pa.binary())], [*names, column])
        finally:
            if body is not None:
                body.close()

    return indexed.filter("regular").select(*names).mapInArrow(run, f"archive string, member string, offset long, size long, {column} {kind}")


def spread(indexed: DataFrame, bytes_each: int = 256 << 20) -> DataFrame:
    """``indexed`` dealt to tasks by ranges of about so many bytes of an archive, not by archives."""
    piece = F.floor(F.col("offset") / bytes_each)
    return indexed.filter("regular").repartition(F.col("archive"), piece).sortWithinPartitions("archive", "offset")


def member_digests(indexed: DataFrame) -> DataFrame:
    """(archive, member, offset, size, sha256) of regular members, whatever their size."""

    def digest(ranges: Iterator[bytes], size: int) -> str:
        h = hashlib.sha256()
        for some in ranges:
            h.update(some)
        return h.hexdigest()

    return _per_member(indexed, "sha256", "string", digest)


def member_contents(indexed: DataFrame, most: int = MOST_BYTES) -> DataFrame:
    """(archive, member, offset, size, content) of regular members; one that no row can hold is an error."""

    def whole(ranges: Iterator[bytes], size: int) -> bytes:
        if size > most:
            raise ValueError(f"a member of {size} bytes")
        return b"".join(ranges)

    return _per_member(indexed, "content", "binary", whole)


def archive_digests(archives: DataFrame) -> DataFrame:
    """(archive, bytes, sha256) of whole files, read as streams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, inside = located(path)
                h, size = hashlib.sha256(), 0
                with store.open_input_stream(inside) as body:
                    while some := body.read(BLOCK):
                        h.update(some)
                        size += len(some)
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size], pa.int64()), pa.array([h.hexdigest()])], ["archive", "bytes", "sha256"])

    return archives.select("path").mapInArrow(run, "archive string, bytes long, sha256 string")

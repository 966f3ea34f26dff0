"""Writers: tables, archives of bounded size, and reports."""

from __future__ import annotations

import hashlib
import io
import json
import os
import posixpath
import re
import tarfile
import uuid
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.schemas import SHARD_REPORT
from loomwright.session import exists, file_at, settled
from loomwright.sources import archives
from loomwright.sources.tables import PAPER_ID


def require_outside(source: str, target: str) -> None:
    """Refuse two folders of which one is the other or lies in it."""
    a, b = (posixpath.normpath(re.sub(r"\A[a-z0-9]+:/+", "/", p).rstrip("/")) + "/" for p in (source, target))
    if a.startswith(b) or b.startswith(a):
        raise ValueError("source, destination and audit directories must be separate")


def write_table(df: DataFrame, path: str, by: str | None = None) -> None:
    """All or nothing: Spark's commit protocol takes the place of a temporary file and a rename."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object a line, keys sorted, columns without a value left out."""
    df.select(*sorted(df.columns)).write.mode("overwrite").json(path)


def write_json_document(spark: SparkSession, value: Any, path: str) -> None:
    """One JSON document, keys in order; it is there whole or not at all."""
    data = (json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) + "\n").encode()
    where, files = file_at(spark, path)
    part = file_at(spark, f"{path}.{uuid.uuid4().hex}.part")[0]
    out = files.create(part, True)
    out.write(bytearray(data))
    out.close()
    files.delete(where, False)
    if not files.rename(part, where):
        raise OSError(f"cannot write {path}")


def read_json_document(spark: SparkSession, path: str) -> Any:
    """The document at a path, null if there is none."""
    where, files = file_at(spark, path)
    if not files.exists(where):
        return None
    stream = files.open(where)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


class _Hashed:
    """A stream that counts and hashes what is written to it."""

    def __init__(self, out):
        self.out, self.hash, self.size = out, hashlib.sha256(), 0

    def write(self, data: bytes) -> int:
        self.out.write(data)
        self.hash.update(data)
        self.size += len(data)
        return len(data)

    def tell(self) -> int:
        return self.size


def portable(name: Column) -> Column:
    """Whether a member of an archive is one that a release may hold."""
    return F.coalesce(name.rlike(rf"\A{PAPER_ID}/(paper\.md|drawio/[^/]+\.drawio|images/[^/]+\.png)\z"), F.lit(False))


def write_shards(files: DataFrame, folder: str, prefix: str = "papers", resume: bool = False, source: str | None = None) -> DataFrame:
    """Archives of the files (shard, arxiv_id, name, content) in a shared folder; a report of each.

    Files are streamed: a task holds one at a time, however large its archive.  An archive is
    written under a name of its attempt and then renamed, so a repeated task leaves one.  One
    that is there already is an error, or with ``resume`` kept if it has just these members.
    The folder must be apart from ``source``, where the files come from.
    """
    if source:
        require_outside(source, folder)
    if not re.fullmatch(r"[A-Za-z0-9_-]+", prefix):
        raise ValueError(f"invalid prefix: {prefix!r}")
    spark = files.sparkSession
    target = folder if "://" in folder else f"file://{os.path.abspath(folder)}"
    if exists(spark, target) and not resume and [s for s in _names(spark, target) if s.endswith(".tar")]:
        raise FileExistsError(f"archive output must be empty: {folder}")
    columns = ["filename", "bytes", "sha256", "papers"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(target)
        store.create_dir(base)
        current: dict[str, Any] = {}

        def close() -> pa.RecordBatch:
            name, part = current["name"], current["part"]
            if part is None:  # kept
                with store.open_input_stream(f"{base}/{name}") as old, tarfile.open(fileobj=old, mode="r|") as archive:
                    there = {m.name: m.size for m in archive if m.isfile()}
                if there != current["members"]:
                    raise ValueError(f"existing shard membership differs: {name}")
                digest, size = hashlib.sha256(), 0
                with store.open_input_stream(f"{base}/{name}") as old:
                    while block := old.read(8 << 20):
                        digest.update(block)
                        size += len(block)
                return row(name, size, digest.hexdigest())
            current["tar"].close()
            current["raw"].close()
            store.move(part, f"{base}/{name}")
            return row(name, current["out"].size, current["out"].hash.hexdigest())

        def row(name: str, size: int, digest: str) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size], pa.int64()), pa.array([digest]), pa.array([sorted(current["papers"])], pa.list_(pa.string()))], columns)

        for batch in batches:
            for shard, paper, member, content in zip(*(batch.column(i) for i in range(4))):
                name = f"{prefix}-{shard.as_py():05d}.tar"
                if current.get("name") != name:
                    if current:
                        yield close()
                    kept = resume and store.get_file_info(f"{base}/{name}").type != fs.FileType.NotFound
                    current = {"name": name, "part": None if kept else f"{base}/.{name}.{uuid.uuid4().hex}", "papers": set(), "members": {}}
                    if not kept:
                        current["raw"] = store.open_output_stream(current["part"])
                        current["out"] = _Hashed(current["raw"])
                        current["tar"] = tarfile.open(fileobj=current["out"], mode="w", format=tarfile.PAX_FORMAT)
                data = content.as_py() or b""
                current["papers"].add(paper.as_py())
                current["members"][member.as_py()] = len(data)
                if current["part"]:
                    info = tarfile.TarInfo(member.as_py())
                    info.size, info.mode, info.mtime = len(data), 0o644, 0
                    current["tar"].addfile(info, io.BytesIO(data))
        if current:
            yield close()

    rows = files.select("shard", "arxiv_id", "name", "content").repartition("shard").sortWithinPartitions("shard", "name")
    # The report is written, so archives are made once however often it is read.
    return settled(rows.mapInArrow(write, SHARD_REPORT), "shards")


def _names(spark: SparkSession, folder: str) -> list[str]:
    where, files = file_at(spark, folder)
    return [s.getPath().getName() for s in files.listStatus(where)]


def archive_members(spark: SparkSession, folder: str) -> DataFrame:
    """(filename, name, size, sha256, error) of what archives in a folder hold, by their index.

    ``sha256`` is the archive's; an archive has a row without a name as well, which says
    what is wrong with the archive, if anything is.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar").load(folder).select("path")
    # Each archive is walked and hashed in a task of its own.
    files = settled(files.repartition(F.col("path")), "archives")
    rows = archives.index(files).filter("regular or member is null").join(archives.archive_digests(files).drop("bytes"), "archive")
    return rows.select(F.regexp_extract("archive", r"[^/]*\z", 0).alias("filename"), F.col("member").alias("name"), "size", "sha256", "error")


def write_files(files: DataFrame, folder: str, source: str | None = None) -> DataFrame:
    """(path, size) of files (name, content), each written below a shared folder, apart from ``source``, under a name of its attempt and then renamed."""
    if source:
        require_outside(source, folder)
    target = folder if "://" in folder else f"file://{os.path.abspath(folder)}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(target)
        for batch in batches:
            names, sizes = batch.column(0).to_pylist(), []
            for name, content in zip(names, batch.column(1)):
                where = f"{base}/{name}"
                store.create_dir(os.path.dirname(where))
                part = f"{where}.{uuid.uuid4().hex}.part"
                with store.open_output_stream(part) as out:
                    sizes.append(out.write(content.as_py() or b"") or len(content.as_py() or b""))
                store.move(part, where)
            yield pa.RecordBatch.from_arrays([pa.array([f"{target}/{n}" for n in names]), pa.array(sizes, pa.int64())], ["path", "size"])

    return settled(files.select("name", "content").mapInArrow(write, "path string, size long"), "files")

"""Readers: JSON lines, JSON documents, listings, blobs and archives."""

from __future__ import annotations

import gzip
import io
import tarfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, StringType, StructField, StructType

from loomwright.functions.markers import guess_extension
from loomwright.schemas import RECOVERY_STATE

PAPER_ID = r"[0-9]{4}\.[0-9]{4,5}(v[0-9]+)?"


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON objects; blank lines are skipped, a malformed one is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def accepted(spark: SparkSession, manifest: str) -> DataFrame:
    return read_jsonl(spark, manifest, RECOVERY_STATE).filter("status = 'accepted'").orderBy("arxiv_id")


def read_blobs(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, length and content of files below a folder."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "length", "content")


def read_listing(spark: SparkSession, path: str, pattern: str = "*.tar") -> DataFrame:
    """Objects of a store by key, newest first; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    files = reader.load(path).select(F.col("path").alias("key"), F.col("length").alias("size"), F.col("modificationTime").alias("last_modified"))
    return files.withColumn("month", F.regexp_extract("key", r"_([0-9]{4})_[0-9]+\.tar\z", 1)).orderBy(F.desc("key"))


def read_archives(spark: SparkSession, path: str, pattern: str = "*.tar") -> DataFrame:
    """Outer archives (key, size, month); their contents are read as streams."""
    return read_listing(spark, path, pattern).select("key", "size", "month")


def paper_id(path: Column) -> Column:
    """The paper that a path belongs to, null outside of papers."""
    found = F.regexp_extract(path, rf"(?:\A|/)({PAPER_ID})(?:/|\z)", 1)
    return F.when(found != "", found)


def page_number(path: Column) -> Column:
    """Number of a page image in the old layout, null for other files."""
    found = F.regexp_extract(path, r"(?:\A|/)page_([0-9]+)\.png\z", 1)
    return F.when(found != "", found.cast("int"))


def safe_member(name: Column) -> Column:
    """Relative, without a way up."""
    parts = F.split(name, "/")
    return (name != "") & ~F.startswith(name, F.lit("/")) & ~F.exists(parts, lambda p: p == "..")


def asset_path(path: Column, prefix: str, parts: int | None = 2) -> Column:
    """Relative, without a way up, below ``prefix``, and as deep as ``parts`` says, if it does."""
    pieces = F.split(path, "/")
    inside = safe_member(path) & (F.element_at(pieces, 1) == prefix)
    return F.coalesce(inside & (F.size(pieces) == parts) if parts else inside, F.lit(False))


def paper_folders(paths: DataFrame, pattern: str = PAPER_ID) -> DataFrame:
    """(arxiv_id) of the folders of papers, which are named by a pattern, among relative paths: below ``papers`` if there is such a folder, else at the top; none is an error."""
    first, second = F.split_part("path", F.lit("/"), F.lit(1)), F.split_part("path", F.lit("/"), F.lit(2))
    below = paths.filter(first == "papers")
    name = first if below.isEmpty() else F.when(first == "papers", second)
    found = paths.select(name.alias("arxiv_id")).filter(F.col("arxiv_id").rlike(rf"\A(?:{pattern})\z")).distinct().orderBy("arxiv_id")
    if found.isEmpty():
        raise ValueError("no paper folders")
    return found


def inner_files(packages: DataFrame, carry: str | None = None) -> DataFrame:
    """Files inside papers' packages (path, content): a compressed archive, or one compressed file.

    Links and paths that lead out are left out; a package that cannot be read is one row that says so.
    With ``carry``, a column that is kept with each file, every package has a row without a member as well.
    """
    kept = [] if carry is None else [packages.schema[carry]]
    schema = StructType([StructField("package", StringType()), StructField("member", StringType()), StructField("content", BinaryType()), StructField("readable", BooleanType()), *kept])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (path, content) in enumerate(zip(batch.column(0), batch.column(1))):
                name, more = path.as_py(), batch.slice(i, 1).columns[2:]
                row = lambda *values: _member(name, *values, more, schema.names)  # noqa: B023, E731
                if carry is not None:
                    yield row("", b"", True)
                if carry is not None and not content.is_valid:
                    continue
                data = content.as_py() or b""
                try:
                    with tarfile.open(fileobj=io.BytesIO(data), mode="r:*") as archive:
                        for m in archive:
                            if m.isfile():
                                yield row(m.name, archive.extractfile(m).read(), True)
                except (tarfile.TarError, OSError, EOFError):
                    try:
                        yield row(None, gzip.decompress(data), True)
                    except (OSError, EOFError, zlib.error):
                        yield row("", b"", False)

    found = packages.select("path", "content", *([carry] if carry else [])).mapInArrow(unpack, schema)
    named = F.coalesce(F.col("member"), F.concat(F.lit("source"), guess_extension(F.col("content"))))
    whole = F.lit(carry is not None) & (F.col("member") == "")
    return found.withColumn("single", F.col("member").isNull()).withColumn("member", named).filter(~F.col("readable") | safe_member(F.col("member")) | whole)


def _member(package: str, member: str | None, content: bytes, readable: bool, more: list[pa.Array], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([package], pa.string()), pa.array([member], pa.string()), pa.array([content], pa.binary()), pa.array([readable]), *more], names)


def descending_months(spark: SparkSession, start: str, stop: str, most: int = 1200) -> DataFrame:
    """Months YYMM from start back to stop, both included."""
    for m in (start, stop):
        if len(m) != 4 or not m.isdigit() or not 1 <= int(m[2:]) <= 12:
            raise ValueError(f"not a month: {m!r}")
    first, last = (int(m[:2]) * 12 + int(m[2:]) - 1 for m in (start, stop))
    if last > first:
        raise ValueError(f"{stop} is newer than {start}")
    if first - last >= most:
        raise ValueError("too many months")
    n = F.col("id")
    return spark.range(last, first + 1).select(F.format_string("%02d%02d", F.floor(n / 12), n % 12 + 1).alias("month")).orderBy(F.desc("month"))

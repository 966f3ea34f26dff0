"""What a release holds: assets of papers, their export, bundles of selected figures and links of a gallery."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.functions.scalars import last_part, slug, strip_space
from loomwright.operators import folds
from loomwright.operators.states import required
from loomwright.plans import stages
from loomwright.session import file_at, settled
from loomwright.sources.sinks import archive_members, require_outside, write_shards
from loomwright.sources.tables import asset_path, read_blobs


def stem(path: Column) -> Column:
    return F.regexp_replace(last_part(path), r"(?<=.)\.[^.]*\z", "")


def assets(files: DataFrame, figures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(arxiv_id, path, name) of what is released of each paper, and (arxiv_id, reason) of papers that cannot be.

    files: arxiv_id, path, content; figures: arxiv_id, image_path, drawio_path, page_number of
    papers that have metadata.  Those papers' images get their names from diagram and page;
    the others' images keep theirs.
    """
    papers = files.select("arxiv_id").distinct()
    text = files.filter((F.col("path") == "paper.md") & (strip_space(F.make_valid_utf8(F.col("content").cast("string"))) != ""))
    drawn = files.filter(F.col("path").rlike(r"\Adrawio/[^/]*\.drawio\z"))
    have = files.select("arxiv_id", "path")
    named = figures.withColumn("name", F.concat(F.lit("images/"), stem(F.col("drawio_path")), F.format_string("_p%03d.png", "page_number")))
    named = named.join(have.select("arxiv_id", F.col("path").alias("image_path"), F.lit(True).alias("_image")), ["arxiv_id", "image_path"], "left")
    named = named.join(have.select("arxiv_id", F.col("path").alias("drawio_path"), F.lit(True).alias("_drawio")), ["arxiv_id", "drawio_path"], "left")
    told = figures.select("arxiv_id").distinct()
    mapped = named.select("arxiv_id", F.col("image_path").alias("path"), "name").distinct()
    found = files.join(told, "arxiv_id", "left_anti").filter(F.col("path").rlike(r"\Aimages/[^/]*\.png\z"))
    same = lambda df: df.select("arxiv_id", "path", F.col("path").alias("name"))
    out = same(text).unionByName(same(drawn)).unionByName(mapped).unionByName(same(found))
    lacking = lambda rows, why: papers.join(rows.select("arxiv_id").distinct(), "arxiv_id", "left_anti").select("arxiv_id", F.lit(why).alias("reason"))
    twice = mapped.groupBy("arxiv_id", "name").agg(F.count("*").alias("n")).filter("n > 1")
    wrong = lambda test, why: named.filter(test).select("arxiv_id", F.lit(why).alias("reason"))
    paths = ~asset_path(F.col("image_path"), "images") | ~asset_path(F.col("drawio_path"), "drawio")
    bad = [
        lacking(text, "missing or empty paper.md"),
        lacking(drawn, "no DrawIO"),
        lacking(mapped.select("arxiv_id").unionByName(found.select("arxiv_id")), "no PNG images"),
        wrong(paths, "invalid asset path"),
        wrong(~paths & (F.col("_image").isNull() | F.col("_drawio").isNull()), "missing asset"),
        wrong(F.col("page_number") < 1, "page numbers must be one-based"),
        twice.select("arxiv_id", F.lit("conflicting pair").alias("reason")),
    ]
    reasons = reduce(DataFrame.unionByName, bad).groupBy("arxiv_id").agg(F.min("reason").alias("reason"))
    return out.join(reasons, "arxiv_id", "left_anti"), reasons


def exported(chosen: DataFrame, excluded: DataFrame) -> DataFrame:
    """One row: papers, diagrams and images that are exported, and how many papers are not."""
    counts = chosen.agg(F.count_distinct("arxiv_id").alias("papers"), F.count_if(F.endswith("name", F.lit(".drawio"))).alias("drawio_files"), F.count_if(F.endswith("name", F.lit(".png"))).alias("png_images"))
    return counts.crossJoin(excluded.agg(F.count("*").alias("excluded")))  # one row each


def shard_plan(files: DataFrame, shard_bytes: int = 2 << 30, prefix: str = "dataset") -> DataFrame:
    """files (arxiv_id, name, size) with the archive that they go to: papers in order, next-fit by what they take there."""
    weights = files.groupBy("arxiv_id").agg(F.sum(folds.tar_size(F.col("size"))).alias("bytes"))
    plan = folds.pack_next_fit(weights, ["arxiv_id"], F.col("bytes"), shard_bytes, "shard")
    return files.join(plan.select("arxiv_id", "shard"), "arxiv_id").withColumn("filename", F.concat(F.lit(f"{prefix}-"), F.lpad(F.col("shard").cast("string"), 5, "0"), F.lit(".tar")))


def gallery_links(selected: DataFrame) -> DataFrame:
    """(link, target) for the image and the diagram of each selected page (final_rank, arxiv_id, diagram, page_number, png, source_drawio)."""
    name = F.concat(F.format_string("%05d_", F.col("final_rank").cast("long")), slug(F.col("arxiv_id"), 24), F.lit("_"), slug(F.col("diagram")), F.format_string("_p%02d", F.col("page_number").cast("int")))
    pair = lambda suffix, target: F.struct(F.concat(name, F.lit(suffix)).alias("link"), F.col(target).alias("target"))
    return selected.select(F.explode(F.array(pair(".png", "png"), pair(".drawio", "source_drawio"))).alias("l")).select("l.*")


def bundle_files(selected: DataFrame) -> DataFrame:
    """(arxiv_id, name, source) of the files of each paper's bundle; a name that stands for two sources is an error."""
    draw = F.concat(F.lit("drawio/"), last_part(F.col("source_drawio")))
    image = F.concat(F.lit("images/"), stem(F.col("source_drawio")), F.format_string("_p%03d.png", F.col("page_number").cast("int")))
    pair = lambda name, source: F.struct(name.alias("name"), F.col(source).alias("source"))
    every = selected.select("arxiv_id", F.explode(F.array(pair(draw, "source_drawio"), pair(image, "png"))).alias("f")).select("arxiv_id", "f.*")
    # One shuffle; written once, for the check and the result.
    seen = every.groupBy("arxiv_id", "name", F.col("source").isNull().alias("_none")).agg(F.min("source").alias("source"), F.max("source").alias("_other"))
    seen = settled(seen, "bundles")
    required(seen.filter(F.col("source") != F.col("_other")).select(F.concat_ws("/", "arxiv_id", "name").alias("_key")), "conflicting asset", "_key")
    return seen.drop("_none", "_other")


def write_bundles(selected: DataFrame, path: str, source: str | None = None) -> None:
    """The bundle's plan as a table apart from ``source``; an existing one is never overwritten."""
    if source:
        require_outside(source, path)
    bundle_files(selected).write.mode("errorifexists").parquet(path)


def dataset_files(spark: SparkSession, root: str) -> DataFrame:
    """(arxiv_id, path, content, link) of the files of a dataset's papers; links can be told where the folder is a local or mounted one."""
    files = read_blobs(spark, root).select("path", "content")
    where, store = file_at(spark, root)
    base = store.getFileStatus(where).getPath().toUri().getPath().rstrip("/") + "/"

    def linked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda p: p.startswith("file:") and os.path.islink(re.sub(r"\Afile:/*", "/", p)))

    inside = F.expr("substring(path, position('" + base.replace("'", "\\'") + f"' IN path) + {len(base)})")
    rows = files.select(inside.alias("inside"), "content", F.pandas_udf(linked, "boolean")("path").alias("link"))
    return rows.select(F.split_part("inside", F.lit("/"), F.lit(1)).alias("arxiv_id"), F.substr("inside", F.locate("/", F.col("inside")) + 1).alias("path"), "content", "link")


def packed(files: DataFrame, folder: str, prefix: str = "papers", shard_bytes: int = 2 << 30, resume: bool = False, source: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(report, problems) of archives made of papers' files (arxiv_id, path, content) and read again."""
    named = files.withColumn("name", F.concat_ws("/", "arxiv_id", "path"))
    report = write_shards(stages.shards(named, shard_bytes), folder, prefix, resume, source)
    members = settled(archive_members(files.sparkSession, folder), "members")
    return report, stages.check_archives(report, members)

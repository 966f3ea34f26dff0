"""Papers' texts: from a service, else from the paper's own source, with a state for each."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.functions import latex
from loomwright.operators import relational

#: How texts came, and how much of a converter's warnings is kept.
FROM_SERVICE = "full Markdown endpoint"
FROM_SCAN, FROM_CONVERTER, FALLBACK = "arXiv LaTeX source converted with lightweight parser", "arXiv LaTeX source converted with Pandoc", "arXiv LaTeX source fallback"
KEPT_WARNINGS, KEPT_ERROR = 2000, 1000
FORCED, TIMED_OUT, BROKEN = "Used forced lightweight recursive LaTeX conversion", "Pandoc timed out; used lightweight recursive LaTeX conversion", "Pandoc failed; used lightweight conversion: "


def pending_texts(papers: DataFrame, files: DataFrame) -> DataFrame:
    """Papers (paper_markdown_path) whose text is missing or empty; files: path, size."""
    there = files.filter("size > 0").select(F.col("path").alias("paper_markdown_path")).distinct()
    return papers.join(there, "paper_markdown_path", "left_anti")


def with_text(papers: DataFrame, texts: DataFrame) -> DataFrame:
    """Papers that have a text (arxiv_id, text) which is not blank."""
    return papers.join(texts.filter(F.col("text").rlike(r"(?U)\S")).select("arxiv_id").distinct(), "arxiv_id", "left_semi")


def main_files(files: DataFrame) -> DataFrame:
    """The main TeX file of each paper, of files (arxiv_id, path, text)."""
    scored = files.filter(F.endswith("path", F.lit(".tex"))).withColumn("_score", latex.main_file_score(F.col("path"), F.col("text")))
    return relational.first_wins(scored, ["arxiv_id"], [F.desc("_score"), F.col("path")]).drop("_score")


def documents(files: DataFrame) -> DataFrame:
    """(arxiv_id, main_tex, text): each paper's main file with what it includes; a paper is one archive, so its files are few."""
    main = main_files(files).select("arxiv_id", F.col("path").alias("main_tex"))

    def splice(group: pa.Table) -> pa.Table:
        path, text = group["path"].to_pylist(), group["text"].to_pylist()
        name = group["main_tex"][0].as_py()
        return pa.table({"arxiv_id": group["arxiv_id"][:1], "main_tex": [name], "text": [latex.expanded(name, {p: t or "" for p, t in zip(path, text)})]})

    return files.join(main, "arxiv_id").select("arxiv_id", "main_tex", "path", "text").groupBy("arxiv_id").applyInArrow(lambda t: splice(t), "arxiv_id string, main_tex string, text string")


#: A converter gives an exit code, a text and warnings, or raises TimeoutError.
Converter = Callable[[str], tuple[int, str, str]]


def converted_one(source: str, convert: Converter | None) -> tuple[str | None, str, str | None]:
    """(Markdown, warnings, error): the converter's text, or the scan's where there is no converter or it fails; a short text is an error."""

    def scan(why: str) -> tuple[str | None, str, str | None]:
        text = latex.markdown(source)
        return (text, why, None) if len(text) >= latex.LEAST_CHARS else (None, why, f"lightweight Markdown too short: {len(text)} characters")

    if convert is None:
        return scan(FORCED)
    try:
        code, text, warnings = convert(source)
    except TimeoutError:
        return scan(TIMED_OUT)
    if code:
        return scan(BROKEN + warnings.strip()[-KEPT_ERROR:])
    text = text.strip()
    return (text, warnings.strip(), None) if len(text) >= latex.LEAST_CHARS else (None, warnings.strip(), f"converted Markdown too short: {len(text)} characters")


def converted(docs: DataFrame, convert: Converter | None = None) -> DataFrame:
    """docs (text, ...) with markdown, warnings and error."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            yield pd.DataFrame([converted_one(x or "", convert) for x in s], columns=["markdown", "warnings", "error"])

    out = docs.withColumn("_c", F.pandas_udf(run, "struct<markdown: string, warnings: string, error: string>")("text"))
    return out.select(*docs.columns, "_c.*")


def conversion_states(rows: DataFrame) -> DataFrame:
    """rows (arxiv_id, main_tex, markdown, warnings, error) as states; of warnings the end is kept."""
    ok, c = F.col("error").isNull(), F.col
    source = F.when(F.contains(F.lower("warnings"), F.lit("lightweight")), FROM_SCAN).otherwise(FROM_CONVERTER)
    return rows.select(
        "arxiv_id",
        F.when(ok, "fetched").otherwise("failed").alias("status"),
        F.when(ok, source).otherwise(FALLBACK).alias("retrieval_source"),
        F.when(ok, c("main_tex")).alias("main_tex"),
        F.when(ok, F.length("markdown")).alias("characters"),
        F.when(ok, F.right(F.coalesce("warnings", F.lit("")), F.lit(KEPT_WARNINGS))).alias("pandoc_warnings"),
        "error",
    )


def fetch_states(rows: DataFrame) -> DataFrame:
    """Answers of a service (arxiv_id, content, attempts, error) as texts and states."""
    ok = F.col("error").isNull()
    text = F.when(ok, F.regexp_replace(F.make_valid_utf8(F.col("content").cast("string")), r"(?U)^\s+|\s+$", ""))
    out = rows.withColumn("text", text)
    return out.select("arxiv_id", F.when(ok, "fetched").otherwise("failed").alias("status"), F.when(ok, FROM_SERVICE).alias("retrieval_source"), F.length("text").alias("characters"), F.when(~ok, F.col("attempts")).alias("attempts"), "error", "text")


def text_summary(papers: DataFrame, files: DataFrame, states: DataFrame) -> DataFrame:
    """One row: papers, those tried in this run, and those with a text file, empty ones included."""
    there = papers.join(files.select(F.col("path").alias("paper_markdown_path")).distinct(), "paper_markdown_path", "left_semi")
    run = states.agg(F.count("*").alias("attempted_this_run"), F.count_if(F.col("status") == "fetched").alias("fetched_this_run"), F.count_if(F.col("status") != "fetched").alias("failed_this_run"))
    total = papers.agg(F.count("*").alias("papers")).crossJoin(there.agg(F.count("*").alias("fetched_total")))  # one row each
    return total.crossJoin(run).withColumn("remaining", F.col("papers") - F.col("fetched_total"))

"""States of papers: what is complete, what can be used again, what an import or a recovery came to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.functions.scalars import last_part
from loomwright.session import in_tasks

#: The least size of an image file, the name of the one source of imports, and of its folders.
LEAST_PNG = 100
SOURCE = "cloud_prefiltered_source_packages"
RAW = "drawio_raw"


def valid_png(size: Column, width: Column, height: Column) -> Column:
    return F.coalesce((size > LEAST_PNG) & (width > 0) & (height > 0), F.lit(False))


def _figures(statuses: DataFrame) -> DataFrame:
    return statuses.select("arxiv_id", F.explode("figures").alias("f")).select("arxiv_id", "f.*")


def _found(rows: DataFrame, state: DataFrame, wanted: DataFrame, files: DataFrame) -> DataFrame:
    """rows with state and (_good, _raw): whether all files that a paper's figures want (arxiv_id, path, image) are there, images being good ones, and how many raw diagrams are.

    files: arxiv_id, path, good.  All are counted and meet by paper, each in one shuffle; ``_good`` is null for papers without figures.
    """
    none, raw = F.lit(None).cast("boolean"), F.col("path").rlike(rf"\A{RAW}/[^/]*\.drawio\z")
    both = wanted.select("arxiv_id", "path", "image", none.alias("good")).unionByName(files.select("arxiv_id", "path", none.alias("image"), "good"))
    count = sum(t.count() for t in (rows, state, both))
    by = in_tasks(both, "arxiv_id", count).groupBy("arxiv_id", "path").agg(F.bool_or("image").alias("image"), F.bool_and("good").alias("good"), F.count("good").alias("n"))
    there = F.col("good").isNotNull() & F.col("path").isNotNull()
    fine = F.when(F.col("image").isNotNull(), there & (~F.col("image") | F.col("good")))
    found = by.groupBy("arxiv_id").agg(F.bool_and(fine).alias("_good"), F.sum(F.when(raw, F.col("n"))).alias("_raw"))
    return in_tasks(rows, "arxiv_id", count).join(in_tasks(state, "arxiv_id", count), "arxiv_id", "left").join(found, "arxiv_id", "left")


def valid_complete(rows: DataFrame, statuses: DataFrame, files: DataFrame) -> DataFrame:
    """rows (arxiv_id, drawio_files) with ``complete``: the render state is complete, its counts hold, and all its figures are images.

    statuses: arxiv_id, status, drawio_files, png_images, figures; files: arxiv_id, path, size, width, height.
    What is missing or null is not complete.
    """
    shown = _figures(statuses).select("arxiv_id", F.col("image_path").alias("path"), F.lit(True).alias("image"))
    good = files.select("arxiv_id", "path", valid_png(F.col("size"), F.col("width"), F.col("height")).alias("good"))
    state = statuses.select("arxiv_id", "status", F.col("drawio_files").alias("_drawio"), "png_images", F.size("figures").alias("_figures"))
    joined = _found(rows, state, shown, good).drop("_raw")
    whole = (F.col("status") == "complete") & (F.col("_drawio") == F.col("drawio_files")) & (F.col("png_images") == F.col("_figures")) & F.coalesce("_good", F.lit(True))
    return joined.select(*rows.columns, F.coalesce(whole, F.lit(False)).alias("complete"))


def valid_source(rows: DataFrame, statuses: DataFrame, files: DataFrame, include_partial: bool = False) -> DataFrame:
    """rows (arxiv_id, drawio_files) with ``ready``: as complete, but by files alone, with the diagrams counted; a failed state with figures may do."""
    ready = F.col("partial_ready" if include_partial else "ready")
    return valid_sources(rows, statuses, files).select(*rows.columns, ready.alias("ready"))


def valid_sources(rows: DataFrame, statuses: DataFrame, files: DataFrame) -> DataFrame:
    """rows with ``ready`` and ``partial_ready``, both answers of ``valid_source``."""
    want = lambda c, image: F.struct(F.col(c).alias("path"), F.lit(image).alias("image"))
    wanted = _figures(statuses).select("arxiv_id", F.explode(F.array(want("drawio_path", False), want("image_path", True))).alias("w")).select("arxiv_id", "w.*")
    good = files.select("arxiv_id", "path", F.coalesce(F.col("size") > LEAST_PNG, F.lit(False)).alias("good"))
    state = statuses.select("arxiv_id", "status", F.col("drawio_files").alias("_drawio"), "png_images", F.size("figures").alias("_figures"))
    joined = _found(rows, state, wanted, good)
    whole = F.col("status") == "complete"
    partial = whole | ((F.col("status") == "failed") & (F.col("_figures") > 0))
    counts = (F.col("_drawio") == F.col("drawio_files")) & (F.coalesce("_raw", F.lit(0)) == F.col("drawio_files")) & (F.col("png_images") == F.col("_figures"))
    answer = lambda fit: F.coalesce(fit & counts & F.coalesce("_good", F.lit(True)), F.lit(False))
    return joined.select(*rows.columns, answer(whole).alias("ready"), answer(partial).alias("partial_ready"))


def valid_destination(marks: DataFrame, files: DataFrame) -> DataFrame:
    """(arxiv_id, valid) of imported papers from their marks (arxiv_id, status, source, drawio_files, png_images, has_metadata)."""
    counts = files.groupBy("arxiv_id").agg(F.count_if(F.col("path").rlike(r"\Adrawio/[^/]*\.drawio\z")).alias("_drawio"), F.count_if(F.col("path").rlike(r"\Aimages/[^/]*\.png\z")).alias("_png"))
    joined = marks.join(counts, "arxiv_id", "left")
    valid = F.col("has_metadata") & (F.col("status") == "complete") & (F.col("source") == SOURCE)
    valid = valid & (F.coalesce("_drawio", F.lit(0)) == F.col("drawio_files")) & (F.coalesce("_png", F.lit(0)) == F.col("png_images"))
    return joined.select("arxiv_id", F.coalesce(valid, F.lit(False)).alias("valid"))


def imports(rows: DataFrame, ready: DataFrame, destinations: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """(arxiv_id, status) of an import: skipped, collision, not_ready, failed or imported.

    ready: (arxiv_id, ready); destinations: (arxiv_id, valid) of folders that exist; failures: arxiv_id of copies that broke off.
    """
    joined = rows.select("arxiv_id").join(ready.select("arxiv_id", "ready"), "arxiv_id", "left").join(destinations, "arxiv_id", "left")
    broken = F.lit(False)
    if failures is not None:
        joined = joined.join(failures.select("arxiv_id").distinct().withColumn("_broken", F.lit(True)), "arxiv_id", "left")
        broken = F.coalesce("_broken", F.lit(False))
    status = F.when(F.col("valid"), "skipped").when(F.col("valid").isNotNull(), "collision").when(~F.coalesce("ready", F.lit(False)), "not_ready").when(broken, "failed").otherwise("imported")
    return joined.select("arxiv_id", status.alias("status"))


def imported_figures(statuses: DataFrame) -> DataFrame:
    """(arxiv_id, drawio_path, image_path, page_number) as imported papers have them, with the paths that are copied."""
    f = _figures(statuses)
    to = lambda folder, c: F.concat(F.lit(folder + "/"), last_part(F.col(c)))
    return f.select("arxiv_id", F.col("drawio_path").alias("from_drawio"), F.col("image_path").alias("from_image"), to("drawio", "drawio_path").alias("drawio_path"), to("images", "image_path").alias("image_path"), "page_number")


def render_summary(rows: DataFrame, statuses: DataFrame) -> DataFrame:
    """One row of rows (arxiv_id, complete): sums are over complete papers.  The rows are worked out once."""
    names = ("drawio_files", "png_images")
    sums = in_tasks(statuses.select("arxiv_id", *names), "arxiv_id", statuses.count()).groupBy("arxiv_id").agg(*[F.sum(c).alias(c) for c in names])
    joined = rows.select("arxiv_id", "complete").join(sums, "arxiv_id", "left")
    counts = [F.count("*").alias("input_accepted_papers"), F.count_if("complete").alias("complete_papers"), F.count_if(~F.col("complete")).alias("failed_papers")]
    found = joined.agg(*counts, *[F.coalesce(F.sum(F.when(F.col("complete"), F.col(c))), F.lit(0)).alias(c) for c in names])
    return found.withColumn("complete", F.col("complete_papers") == F.col("input_accepted_papers"))


def import_summary(folders: DataFrame) -> DataFrame:
    """One row of imported folders (folder, has_marker, has_metadata, status, render_completeness, arxiv_id, source, drawio_files, png_images).

    A folder counts if it is complete and is named like its paper; one whose rendering failed is counted before its name is looked at.
    """
    marked = F.coalesce(F.col("has_marker") & F.col("has_metadata") & (F.col("status") == "complete"), F.lit(False))
    good = marked & F.coalesce(F.col("arxiv_id") == F.col("folder"), F.lit(False))
    rows = folders.withColumns({"_good": good, "_partial": marked & (F.col("render_completeness") == "failed"), "_source": F.coalesce("source", F.lit("unknown"))})
    by = rows.groupBy("_source").agg(
        F.count_if("_good").alias("n"), F.count_if(~F.col("_good")).alias("bad"), F.count_if("_partial").alias("partial"),
        F.sum(F.when(F.col("_good"), F.col("drawio_files")).otherwise(0)).alias("drawio"), F.sum(F.when(F.col("_good"), F.col("png_images")).otherwise(0)).alias("png"),
    )
    entries = F.sort_array(F.collect_list(F.when(F.col("n") > 0, F.struct("_source", "n"))))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return by.agg(total("n").alias("papers"), total("drawio").alias("drawio_files"), total("png").alias("png_images"), F.map_from_entries(entries).alias("sources"), total("bad").alias("incomplete_paper_dirs"), total("partial").alias("partially_rendered_papers"))


def import_manifest(folders: DataFrame) -> DataFrame:
    """Relative paths of every imported paper, by name."""
    good = F.col("has_marker") & F.col("has_metadata") & (F.col("status") == "complete") & (F.col("arxiv_id") == F.col("folder"))
    at = lambda *rest: F.concat_ws("/", F.lit("papers"), F.col("arxiv_id"), *map(F.lit, rest))
    return folders.filter(good).select("arxiv_id", at().alias("folder"), at("metadata.json").alias("metadata_path"), at("paper.md").alias("paper_markdown_path"), at("text_status.json").alias("text_status_path")).orderBy("arxiv_id")


def usable_states(rows: DataFrame, states: DataFrame, records: DataFrame, retry_failed: bool = False) -> DataFrame:
    """rows (arxiv_id) with ``usable``: an accepted state whose record exists, a rejected one, or a failed one that is not tried again; the others are pending."""
    joined = rows.join(states.select("arxiv_id", "status"), "arxiv_id", "left").join(records.select("arxiv_id").distinct().withColumn("_record", F.lit(True)), "arxiv_id", "left")
    usable = F.when(F.col("status") == "accepted", F.coalesce("_record", F.lit(False))).when(F.col("status") == "failed", not retry_failed).otherwise(F.coalesce(F.col("status") == "rejected", F.lit(False)))
    return joined.select(*rows.columns, "status", usable.alias("usable"))


def recovery_outcome(facts: DataFrame) -> DataFrame:
    """facts with status and reason: has_package, unpacked, crashed, diagrams, command_failed, output_exists, output_record."""
    c = F.col
    cases = [
        (~c("has_package"), "failed", "missing_source_package"),
        (~c("unpacked"), "failed", "unpack_failed"),
        (c("crashed"), "failed", "batch_exception"),
        ((c("diagrams") == 0) & c("command_failed"), "failed", "drawio_recovery_failed"),
        (c("diagrams") == 0, "rejected", "no_valid_drawio_recovered"),
        (c("output_exists") & c("output_record"), "accepted", "existing_output"),
        (c("output_exists"), "failed", "unexpected_existing_output"),
    ]
    status, reason = F.when(cases[0][0], cases[0][1]), F.when(cases[0][0], cases[0][2])
    for test, s, r in cases[1:]:
        status, reason = status.when(test, s), reason.when(test, r)
    return facts.withColumns({"status": status.otherwise("accepted"), "reason": reason.otherwise("valid_drawio_recovered")})


def overriding(base: DataFrame, values: DataFrame, key: str) -> DataFrame:
    """base with the columns of ``values`` in place of its own where a key has values, nulls included."""
    mine = values.select(F.col(key), F.struct(*[c for c in values.columns if c != key]).alias("_v"))
    joined = base.join(mine, key, "left")
    columns = [c for c in base.columns if c != key] + [c for c in values.columns if c not in base.columns]
    new = lambda c: F.when(F.col("_v").isNotNull(), F.col(f"_v.{c}")).otherwise(F.col(c) if c in base.columns else F.lit(None)) if c in values.columns else F.col(c)
    return joined.select(key, *[new(c).alias(c) for c in columns])


def required(bad: DataFrame, message: str, show: str) -> None:
    """Refuse to go on while there are bad rows; a few are named."""
    some = bad.select(show).limit(5).collect()
    if some:
        raise ValueError(f"{message}: {[r[0] for r in some]}")


def with_categories(papers: DataFrame, known: DataFrame, records: DataFrame, only: str | None = "cs.") -> DataFrame:
    """papers with categories (from the lookup, else from the paper's own record, else none) and ``is_cs``.

    With ``only`` every paper needs categories: those without are an error.
    """
    none = F.array().cast("array<string>")
    some = lambda c: F.when(F.size(c) > 0, F.col(c))
    a, b = known.select("arxiv_id", F.col("categories").alias("_a")), records.select("arxiv_id", F.col("categories").alias("_b"))
    out = papers.join(a, "arxiv_id", "left").join(b, "arxiv_id", "left").withColumn("categories", F.coalesce(some("_a"), some("_b"), none)).drop("_a", "_b")
    if only is None:
        return out.withColumn("is_cs", F.lit(True))
    required(out.filter(F.size("categories") == 0), "missing category metadata", "arxiv_id")
    return out.withColumn("is_cs", F.exists("categories", lambda c: F.startswith(c, F.lit(only))))

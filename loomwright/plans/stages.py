"""The curation stages as functions from relations to relations."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomwright.functions import images, markers, png_stream, scalars, xml_pages
from loomwright.operators import folds, quality, relational, states
from loomwright.session import dealt, exists
from loomwright.sources import tables

# Collect


def collect(packages: DataFrame, month: str) -> DataFrame:
    """Papers whose package holds a diagram (SELECTED_SOURCES) from papers' packages (path, content)."""
    return collected(packages).withColumn("month", F.lit(month)).select("arxiv_id", "month", "source_member", "size", "sha256", "reasons", "matched")


def collected(packages: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """arxiv_id, source_member (the path), size, sha256, reasons and matched of each package (path, content), and other columns of it.

    Packages are opened where they are read: only what their files tell about them is
    shuffled.  A package without content keeps its row.
    """
    of = F.struct(F.length("content").cast("long").alias("size"), F.sha2("content", 256).alias("sha256"), *carry)
    files = tables.inner_files(packages.withColumn("_of", of), "_of")
    alone = F.when(markers.has_marker(F.col("content")), "single_payload_drawio_marker")
    reason = F.when(~F.col("readable"), "invalid_source_package").when(F.col("single"), alone).when(F.col("member") != "", markers.reason(F.col("member"), F.col("content")))
    hits = files.select("package", "_of", reason.alias("reason")).groupBy("package", "_of").agg(F.sort_array(F.collect_set("reason")).alias("reasons"))
    name = F.regexp_extract("package", r"([^/]*?)(?:\.gz)?\z", 1)
    matched = (F.size("reasons") > 0) & ~F.array_contains("reasons", "invalid_source_package")
    return hits.select(name.alias("arxiv_id"), F.col("package").alias("source_member"), "_of.size", "_of.sha256", "reasons", matched.alias("matched"), *[F.col("_of")[c].alias(c) for c in carry])


def scan_counts(found: DataFrame) -> DataFrame:
    """papers_seen, invalid_packages and matches of each month."""
    invalid = F.array_contains("reasons", "invalid_source_package")
    return found.groupBy("month").agg(F.count("*").alias("papers_seen"), F.count_if(invalid).alias("invalid_packages"), F.count_if("matched").alias("matches"))


# Recover


def candidates(files: DataFrame, prefix: str = "source") -> DataFrame:
    """Files (package, member, content) that can give a diagram, named in the order of their paths."""
    kind = markers.suffix(F.col("member"))
    direct = (kind == "drawio") & markers.is_diagram_xml(F.col("content"))
    embedded = kind.isin(*markers.EMBEDDED) & markers.has_marker(F.col("content"))
    hits = files.filter(direct | embedded).withColumn("recovery", F.when(direct, "direct").otherwise("embedded_drawio_xml"))
    number = F.row_number().over(Window.partitionBy("package").orderBy("member"))
    return hits.withColumn("name", F.concat(F.lit(f"{prefix}_"), F.lpad(number.cast("string"), 4, "0")))


def recovered(found: DataFrame, extracted: DataFrame) -> DataFrame:
    """Diagrams of each paper: direct ones and those that an extractor gave (package, name, xml, failed), without copies."""
    joined = found.join(extracted, ["package", "name"], "left")
    xml = F.when(F.col("recovery") == "direct", F.col("content")).otherwise(F.col("xml"))
    usable = joined.withColumn("diagram", xml).filter("diagram is not null").withColumn("sha256", F.sha2("diagram", 256))
    return relational.first_wins(usable, ["package", "sha256"], [F.col("member")])


def diagram_files(diagrams: DataFrame) -> DataFrame:
    """(package, drawio_id, path, member, sha256, recovery) of each paper's diagrams, numbered from 1 in the order of their members."""
    number = F.row_number().over(Window.partitionBy("package").orderBy("member"))
    out = diagrams.withColumn("_n", number)
    return out.select("package", F.format_string("d%03d", "_n").alias("drawio_id"), F.concat(F.lit(states.RAW + "/"), scalars.ordinal_name(F.col("_n"), F.col("member"))).alias("path"), "member", "sha256", "recovery")


def recovery_states(selection: DataFrame, found: DataFrame, diagrams: DataFrame, unreadable: DataFrame, missing: DataFrame | None = None, failures: DataFrame | None = None, outputs: DataFrame | None = None, crashed: DataFrame | None = None) -> DataFrame:
    """status, reason and counts of every selected paper; all inputs are keyed by package.

    missing: packages that are not there; failures: candidates that an extractor broke off on
    (package, name, command_failed); outputs: papers that were there before (package, has_record);
    crashed: packages on which the work itself broke off.
    """
    flag = lambda df, name: df.select("package").distinct().withColumn(name, F.lit(True))
    none = selection.select("package").limit(0)
    n = found.groupBy("package").agg(F.count("*").alias("candidate_count"))
    kept = diagrams.groupBy("package").agg(F.count("*").alias("drawio_files"))
    broken = (failures if failures is not None else none.withColumn("command_failed", F.lit(True))).groupBy("package").agg(F.count("*").alias("failed_candidates"), F.bool_or("command_failed").alias("command_failed"))
    before = (outputs if outputs is not None else none.withColumn("has_record", F.lit(True))).select("package", "has_record")
    rows = selection.join(n, "package", "left").join(kept, "package", "left").join(broken, "package", "left").join(before, "package", "left")
    rows = rows.join(flag(unreadable, "_bad"), "package", "left").join(flag(missing if missing is not None else none, "_none"), "package", "left")
    rows = rows.join(flag(crashed if crashed is not None else none, "_crashed"), "package", "left")
    rows = rows.fillna(0, ["candidate_count", "drawio_files", "failed_candidates"])
    facts = rows.withColumns({
        "has_package": F.col("_none").isNull(), "unpacked": F.col("_bad").isNull(), "crashed": F.col("_crashed").isNotNull(), "diagrams": F.col("drawio_files"),
        "command_failed": F.coalesce("command_failed", F.lit(False)), "output_exists": F.col("has_record").isNotNull(), "output_record": F.coalesce("has_record", F.lit(False)),
    })
    return states.recovery_outcome(facts).select(*selection.columns, "candidate_count", "drawio_files", "failed_candidates", "status", "reason")


def rows_to_consolidate(spark: SparkSession, canonical: str, subset: DataFrame) -> DataFrame:
    """Accepted rows of the canonical manifest if there is one: a repeated subset never takes its place."""
    return tables.accepted(spark, canonical) if exists(spark, canonical) else subset


# Render


def render_tasks(documents: DataFrame, previous: DataFrame | None = None, force: float | None = None) -> DataFrame:
    """One task for each page (document: arxiv_id, drawio_path, content) with its scale; earlier outputs that are large enough are reused."""
    parsed = dealt(documents, "arxiv_id").withColumn("parsed", xml_pages.strict_pages(F.col("content")))
    pages = parsed.select("arxiv_id", "drawio_path", F.col("parsed.error").alias("error"), F.explode_outer("parsed.pages").alias("p"))
    pages = pages.select("arxiv_id", "drawio_path", "error", "p.page_number", "p.page_name", "p.body").withColumn("box", xml_pages.page_size(F.col("body")))
    scale = F.lit(force) if force else scalars.adaptive_scale(F.col("box.width"), F.col("box.height"))
    tasks = pages.select("*", scale.alias("scale"), scalars.task_key(F.col("arxiv_id"), F.col("drawio_path"), F.col("page_number")).alias("key"), F.lit(force or scalars.SCALES[0]).alias("min_scale")).drop("box")
    if previous is None:
        return tasks.withColumn("reused", F.lit(False))
    return relational.reuse(tasks, previous, ["drawio_path", "page_number"], "finished_at")


def scale_groups(tasks: DataFrame) -> DataFrame:
    """(scale, n, first_key) of what is to render, the largest scale first."""
    return tasks.groupBy("scale").agg(F.count("*").alias("n"), F.min("key").alias("first_key")).orderBy(F.desc("scale"))


#: Files that a renderer gets at once, its seconds for a call and for each file, how often a call's missing files are halved, and the least size of an image.
CHUNK, CALL_SECONDS, FILE_SECONDS, HALVINGS = 60, 180, 6, 8

#: A renderer makes images of (key, body, scale) within so many seconds; what it leaves out has failed.
Renderer = Callable[[list[tuple[str, str, float]], float], dict[str, bytes]]


def render_all(items: list[tuple[str, str, float]], render: Renderer, retry: bool = True, depth: int = 0) -> dict[str, tuple[bytes | None, str | None]]:
    """(image, error) of each item; what a call leaves out is tried again in halves, so one bad page does not take others with it."""
    out: dict[str, tuple[bytes | None, str | None]] = {}
    for low in range(0, len(items), CHUNK):
        some = items[low : low + CHUNK]
        try:
            got, error = render(some, CALL_SECONDS + FILE_SECONDS * len(some)), "no output"
        except Exception as e:  # the call fails, not the batch
            got, error = {}, f"{type(e).__name__}: {e}"[:300]
        got = {k: v for k, v in got.items() if v and len(v) > states.LEAST_PNG}
        left = [i for i in some if i[0] not in got]
        out |= {k: (v, None) for k, v in got.items()}
        if retry and left and depth < HALVINGS and len(some) > 1:
            half = (len(left) + 1) // 2
            for part in (left[:half], left[half:]):
                out |= render_all(part, render, retry, depth + 1)
        else:
            out |= {i[0]: (None, error) for i in left}
    return out


def rendered(tasks: DataFrame, render: Renderer, retry: bool = True) -> DataFrame:
    """(key, png, error): what a renderer makes of each page, in chunks of one scale after the other, the largest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            for scale in sorted({i[2] for i in items}, reverse=True):
                got = render_all([i for i in items if i[2] == scale], render, retry)
                yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.string()), pa.array([v[0] for v in got.values()], pa.binary()), pa.array([v[1] for v in got.values()], pa.string())], ["key", "png", "error"])

    todo = tasks.filter("body is not null and not reused").select("key", "body", "scale")
    return todo.sortWithinPartitions(F.desc("scale")).mapInArrow(run, "key string, png binary, error string")


def render_states(tasks: DataFrame, outputs: DataFrame) -> DataFrame:
    """complete or failed for each paper: every page has an image, there is one at least, and no error."""
    joined = tasks.join(outputs.select("key", "png", F.col("error").alias("render_error")), "key", "left")
    done = F.col("reused") | F.col("png").isNotNull()
    failed = F.col("error").isNotNull() | F.col("render_error").isNotNull()
    out = relational.complete(joined, "arxiv_id", F.col("body").isNotNull(), done, failed)
    return out.select("arxiv_id", F.when(F.col("complete"), "complete").otherwise("failed").alias("status"), F.col("done").alias("png_images"), F.col("failed").alias("errors"))


# Index


def figures_of(metadata: DataFrame) -> DataFrame:
    """Figures of papers with metadata (arxiv_id, paper_id, figures: array of drawio_path, image_path, page_number), numbered from 1.

    Metadata of another paper, or paths that lead elsewhere, are errors.
    """
    states.required(metadata.filter(~F.coalesce(F.col("paper_id") == F.col("arxiv_id"), F.lit(False))), "metadata of another paper", "arxiv_id")
    rows = metadata.select("arxiv_id", F.posexplode("figures").alias("i", "f")).select("arxiv_id", (F.col("i") + 1).alias("figure_index"), "f.*")
    wrong = ~tables.asset_path(F.col("drawio_path"), "drawio", None) | ~tables.asset_path(F.col("image_path"), "images", None)
    states.required(rows.filter(wrong), "invalid path", "drawio_path")
    at = lambda c: F.concat_ws("/", F.lit("papers"), "arxiv_id", c)
    stem = F.regexp_replace(scalars.last_part(F.col("drawio_path")), r"(?<=.)\.[^.]*\z", "")
    return rows.select("arxiv_id", "figure_index", F.concat_ws(":", "arxiv_id", "image_path").alias("figure_id"), stem.alias("diagram"), "page_number", at("drawio_path").alias("drawio_path"), at("image_path").alias("png"))


def legacy_figures(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Figures of the old layout: images page_N.png in a diagram's folder (arxiv_id, diagram, path), with the manifest's first row of each diagram."""
    first = relational.first_wins(manifest, ["arxiv_id", "diagram"], [F.col("position")]).select("arxiv_id", "diagram", "is_main", F.col("pass").alias("old_quality_pass"), F.col("score").alias("old_quality_score"))
    pages = files.withColumn("page_number", tables.page_number(F.col("path"))).filter("page_number is not null")
    return pages.join(first, ["arxiv_id", "diagram"]).select("arxiv_id", "diagram", "page_number", F.col("path").alias("png"), F.concat_ws("/", "arxiv_id", F.lit("diagrams"), "diagram", F.lit("source.drawio")).alias("drawio_path"), "is_main", "old_quality_pass", "old_quality_score")


def pages_of_figures(figures: DataFrame, pages: DataFrame, keys: list[str]) -> DataFrame:
    """figures (keys, page_number) with the page (keys, page_number, ...) of that number, ``source_pages`` and a ``mapping_error`` where there is none."""
    counts = pages.groupBy(*keys).agg(F.count("*").alias("source_pages"))
    out = figures.join(pages.withColumn("_found", F.lit(True)), [*keys, "page_number"], "left").join(counts, keys, "left")
    outside = F.format_string("page index %d outside source page count %d", F.col("page_number").cast("long"), F.coalesce("source_pages", F.lit(0)).cast("long"))
    return out.withColumn("mapping_error", F.when(F.col("_found").isNull(), outside).otherwise("")).drop("_found")


def index_pages(figures: DataFrame, documents: DataFrame, pictures: DataFrame, papers: DataFrame) -> DataFrame:
    """The page index: figures (arxiv_id, drawio_path, page_number, png) with metrics of their page and features of their image.

    Documents (drawio_path, content) are parsed once each, pictures (png, content) decoded once
    each; papers holds (arxiv_id, is_cs).  What cannot be read is a message in the row.
    """
    pages = documents.select("drawio_path", F.explode(xml_pages.lenient_pages(F.col("content"))).alias("p")).select("drawio_path", "p.*")
    metrics = pages.select("drawio_path", "page_number", "page_name", *[c.alias(k) for k, c in scalars.page_metrics(F.col("body")).items()])
    seen = pictures.withColumn("f", images.image_features(F.col("content"))).select("png", F.length("content").cast("long").alias("png_bytes"), F.sha2("content", 256).alias("sha256"), "f.*")
    out = pages_of_figures(figures, metrics, ["drawio_path"]).join(seen, "png", "left").join(papers, "arxiv_id", "left")
    missing = F.col("source_pages").isNull()
    out = out.withColumns({
        "source_error": F.when(missing, "missing document").otherwise(""),
        "mapping_error": F.when(missing, "").otherwise(F.col("mapping_error")),
        "image_error": F.when(F.col("sha256").isNull(), "missing image").otherwise(F.coalesce("image_error", F.lit(""))),
        "pixels": F.coalesce(F.col("png_w").cast("long") * F.col("png_h"), F.lit(0)),
        "aspect": scalars.aspect(F.coalesce("png_w", F.lit(0)), F.coalesce("png_h", F.lit(0))),
        "is_main": F.coalesce("is_main", F.lit(False)) if "is_main" in figures.columns else F.lit(False),
        "is_cs": F.coalesce("is_cs", F.lit(False)),
    })
    name = F.coalesce("page_name", F.format_string("Page-%d", F.col("page_number").cast("long")))
    out = out.fillna(0, ["verts", "edges", "elements", "boxes", "images", "texts"]).withColumn("page_name", name)
    return out.withColumn("valid", scalars.all_empty(F.col("source_error"), F.col("mapping_error"), F.col("image_error")))


# Model


#: What wanted and unwanted pages are described as.
WANTED = (
    "a polished scientific method diagram",
    "a clear system architecture diagram",
    "a complete technical workflow or flowchart",
    "a machine learning model architecture diagram",
    "a technical pipeline with connected components",
    "an algorithm process diagram",
    "a conceptual research framework diagram",
    "a technical scheduling or optimization diagram",
)
UNWANTED = (
    "a statistical bar chart",
    "a line plot or scatter plot",
    "a data table",
    "a screenshot of a software user interface",
    "a photograph or decorative illustration",
    "a mathematical plot or heatmap",
    "a repeated grid or pattern image",
    "a scientific results figure with multiple plots",
    "an ablation study or benchmark results figure",
    "a collage of disconnected figure panels",
    "a sparse unfinished or poorly formatted diagram",
)
SCORE_BATCH = 64


def model_scores(candidates_: DataFrame, score: Callable[[list[np.ndarray], tuple[str, ...]], np.ndarray], mode: str = "dual", wanted: tuple[str, ...] = WANTED, unwanted: tuple[str, ...] = UNWANTED) -> DataFrame:
    """MODEL_SCORES with prompt_logits from an injected scorer of candidates (png, content).

    The scorer gives logits (views x prompts) for views of images, many at a time; an image
    that cannot be read has none, and stops no other.
    """
    prompts = (*wanted, *unwanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, SCORE_BATCH):
                some = batch.slice(low, SCORE_BATCH)
                seen: list[list[np.ndarray]] = []
                errors: list[str | None] = []
                for content in some.column(1).to_pylist():
                    try:
                        seen.append(images.views(content, mode))
                        errors.append(None)
                    except Exception as e:  # this image has no logits
                        seen.append([])
                        errors.append(f"{type(e).__name__}: {e}"[:300])
                flat = [v for views in seen for v in views]
                logits = np.asarray(score(flat, prompts), float).reshape(len(flat), len(prompts)) if flat else np.zeros((0, len(prompts)))
                ends = np.cumsum([len(v) for v in seen])
                means = [logits[e - len(v) : e].mean(axis=0).tolist() if v else None for v, e in zip(seen, ends)]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(means, pa.list_(pa.float64())), pa.array(errors, pa.string())], ["png", "logits", "model_error"])

    raw = candidates_.select("png", "content").mapInArrow(run, "png string, logits array<double>, model_error string")
    side = lambda first, n: F.round(scalars.log_mean_exp(F.slice("logits", first, n)), 6)
    told = F.map_from_arrays(F.array(*map(F.lit, prompts)), F.transform("logits", lambda x: F.round(x, 6)))
    sides = raw.select("png", "model_error", side(1, len(wanted)).alias("positive_logit"), side(len(wanted) + 1, len(unwanted)).alias("negative_logit"), told.alias("prompt_logits"))
    return quality.with_margin(sides)


def finalized(chosen: DataFrame, scores: DataFrame, threshold: float | None = None, ranking: str = "structure", top: int = 0) -> tuple[DataFrame, DataFrame]:
    """(selected by rank, rejected): every candidate needs a score."""
    gaps = relational.missing(chosen, scores, "png").limit(5).collect()
    if gaps:
        raise ValueError(f"no scores for {[r['png'] for r in gaps]}")
    merged = relational.merge_scores(chosen, scores.withColumn("_at", F.monotonically_increasing_id()), "png", "_at")
    keep, why = quality.selection(threshold)
    merged = merged.withColumn("selection_keep", keep).withColumn("selection_reject_reason", why)
    return quality.final_rank(merged.filter("selection_keep"), ranking, top), merged.filter("not selection_keep")


# Export, validate, pack

#: What a paper's folder holds, and the root elements of diagrams.
LAYOUT = ("drawio", "images", "paper.md")
ROOTS = ("mxfile", "mxGraphModel", "diagram")


def validated(files: DataFrame) -> DataFrame:
    """errors and warnings of each paper from its files (arxiv_id, path, content, and link, if links can be told); path is relative to the paper.

    Checksums of pictures are tested, and their lines up to a number of pixels.
    """
    top = F.split_part("path", F.lit("/"), F.lit(1))
    stem, number = F.regexp_extract("path", r"\Aimages/(.+)_p([0-9]{3,})\.png\z", 1), F.regexp_extract("path", r"\Aimages/(.+)_p([0-9]{3,})\.png\z", 2)
    files = files.withColumn("kind", top)
    files = files if "link" in files.columns else files.withColumn("link", F.lit(False))
    drawn = files.filter("kind = 'drawio'").select("arxiv_id", F.regexp_extract("path", r"\Adrawio/(.+)\.drawio\z", 1).alias("stem"), xml_pages.document_outline(F.col("content")).alias("o")).select("arxiv_id", "stem", "o.pages", F.coalesce(F.col("o.root").isin(*ROOTS), F.lit(False)).alias("is_xml"))
    shown = files.filter("kind = 'images'").select("arxiv_id", "path", stem.alias("stem"), F.expr("try_cast(regexp_extract(path, '_p([0-9]{3,})[.]png', 1) as int)").alias("page"), png_stream.png_problem("content").alias("png"))
    pairs = shown.join(drawn, ["arxiv_id", "stem"], "left")
    broken = F.when(F.col("png.error") == "not a PNG", F.concat(F.lit("not a PNG: "), "path")).otherwise(F.concat(F.lit("broken PNG: "), "path", F.lit(": "), "png.error"))
    problem = F.when(F.col("png.error").isNotNull(), broken).when(F.col("pages").isNull() | F.coalesce(F.col("page") < 1, F.lit(True)), F.concat(F.lit("unmatched image: "), "path"))
    late = F.when(F.col("page") > F.col("pages"), F.concat(F.lit("page beyond document: "), "path"))
    large = F.when(F.col("png.warning").isNotNull(), F.concat("path", F.lit(": "), "png.warning"))
    of_images = pairs.select("arxiv_id", problem.alias("error"), F.explode(F.array(late, large)).alias("warning"))
    of_drawn = drawn.select("arxiv_id", F.when((F.col("stem") == "") | ~F.col("is_xml"), F.concat(F.lit("not a diagram: "), "stem")).alias("error"), F.lit(None).cast("string").alias("warning"))
    have = files.groupBy("arxiv_id").agg(
        F.collect_set("kind").alias("kinds"), F.bool_or("link").alias("links"), F.max(F.when(F.col("path") == "paper.md", F.length(scalars.strip_space(F.decode("content", "ISO-8859-1"))))).alias("text"), F.count_if(F.col("kind") == "drawio").alias("drawio_files"), F.count_if(F.col("kind") == "images").alias("png_images")
    )
    layout = have.select(
        "*",
        scalars.reasons(("unexpected layout", F.size(F.array_except("kinds", F.array(*map(F.lit, LAYOUT)))) > 0), ("symbolic links", F.col("links")), ("missing or empty text", F.coalesce("text", F.lit(0)) == 0), ("missing drawio", F.col("drawio_files") == 0), ("missing images", F.col("png_images") == 0)).alias("layout"),
    )
    found = of_images.unionByName(of_drawn).groupBy("arxiv_id").agg(F.sort_array(F.collect_set("error")).alias("errors"), F.sort_array(F.collect_set("warning")).alias("warnings"))
    empty = F.array().cast("array<string>")
    return layout.join(found, "arxiv_id", "left").select("arxiv_id", F.concat("layout", F.coalesce("errors", empty)).alias("errors"), F.coalesce("warnings", empty).alias("warnings"), "drawio_files", "png_images")


def audit(validation: DataFrame) -> DataFrame:
    """Totals over all papers, one row."""
    return validation.agg(F.count("*").alias("papers"), F.sum("drawio_files").alias("drawio_files"), F.sum("png_images").alias("png_images"), F.sum(F.size("errors")).alias("errors"), F.sum(F.size("warnings")).alias("warnings"))


def export(files: DataFrame, states: DataFrame, skip_incomplete: bool = False) -> tuple[DataFrame, DataFrame]:
    """(files of complete papers, excluded papers with a reason); papers without a state pass."""
    bad = states.filter("status != 'complete'").select("arxiv_id", F.concat(F.lit("render status "), "status").alias("reason"))
    if not skip_incomplete and not bad.isEmpty():
        raise ValueError(f"incomplete papers: {[r['arxiv_id'] for r in bad.limit(5).collect()]}")
    return files.join(bad, "arxiv_id", "left_anti"), bad


def shards(files: DataFrame, shard_bytes: int = 2 << 30) -> DataFrame:
    """files with the shard of their paper: papers in order, next-fit by what they take in an archive."""
    weights = files.groupBy("arxiv_id").agg(F.sum(folds.tar_size(F.length("content"))).alias("bytes"))
    return files.join(folds.pack_next_fit(weights, ["arxiv_id"], F.col("bytes"), shard_bytes, "shard").select("arxiv_id", "shard"), "arxiv_id")


def check_archives(report: DataFrame, members: DataFrame) -> DataFrame:
    """What is wrong with archives: ones that cannot be read to their end, members that are not reported or missing, repeated ones, other checksums."""
    broken = members.filter("name is null and error is not null").select("filename", F.concat_ws(" ", F.lit("unreadable"), F.split_part("error", F.lit(":"), F.lit(1))).alias("problem"))
    checksums, members = members.select("filename", F.col("sha256").alias("is")).distinct(), members.filter("name is not null")
    expected = report.select("filename", F.explode("papers").alias("paper"))
    actual = members.select("filename", F.split_part("name", F.lit("/"), F.lit(1)).alias("paper")).distinct()
    sets = relational.set_audit(expected, actual, ["filename", "paper"]).select("filename", F.concat_ws(" ", "problem", "paper").alias("problem"))
    spread = actual.groupBy("paper").agg(F.count("*").alias("n"), F.min("filename").alias("filename")).filter("n > 1").select("filename", F.concat_ws(" ", F.lit("in several archives"), "paper").alias("problem"))
    twice = members.groupBy("filename", "name").count().filter("count > 1").select("filename", F.concat_ws(" ", F.lit("repeated"), "name").alias("problem"))
    other = checksums.join(report.select("filename", "sha256"), "filename").filter("is != sha256").select("filename", F.lit("checksum").alias("problem"))
    return sets.unionByName(spread).unionByName(twice).unionByName(other).unionByName(broken)


def read_dataset(files: DataFrame, strict: bool = True) -> DataFrame:
    """Images of a packed dataset with their diagrams and the length of their text.

    An image without a diagram is an error, or has a null path where reading is not strict.
    """
    name = r"([^/]+)/images/(.+)_p([0-9]{3,})\.png\z"
    shown = files.filter(F.col("path").rlike(name)).select(F.regexp_extract("path", name, 1).alias("arxiv_id"), F.regexp_extract("path", name, 2).alias("stem"), F.regexp_extract("path", name, 3).cast("int").alias("page_number"), F.col("path").alias("png"))
    drawn = files.filter(F.col("path").rlike(r"/drawio/[^/]+\.drawio\z")).select(F.regexp_extract("path", r"([^/]+)/drawio/", 1).alias("arxiv_id"), F.regexp_extract("path", r"/drawio/(.+)\.drawio\z", 1).alias("stem"), F.col("path").alias("drawio"))
    text = files.filter(F.endswith("path", F.lit("/paper.md"))).select(F.regexp_extract("path", r"([^/]+)/paper\.md\z", 1).alias("arxiv_id"), F.length(F.decode("content", "UTF-8")).alias("n_chars"))
    out = shown.join(drawn, ["arxiv_id", "stem"], "left").join(text, "arxiv_id", "left")
    if strict:
        states.required(out.filter("drawio is null"), "images without a diagram", "png")
    return out

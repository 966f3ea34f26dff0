"""Policies, rules, scores and ranks of pages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.functions.scalars import level, reasons
from loomwright.operators.ordered import numbered, percentiles
from loomwright.session import settled

#: Fixed values, here and in Policy, hard_reasons, structure_score and selection: points of the profile, weights and
#: steps of the score, names of reasons, and bounds of the derived limits.
POINTS = (0, 1, 5, 10, 20, 25, 40, 50, 60, 75, 80, 90, 95, 99, 100)
WEIGHTS = {"elements": 0.52, "texts": 0.23, "edges": 0.17, "pixels": 0.08}
MARGIN_ABOVE = -2.3


@dataclass(frozen=True)
class Policy:
    """Caps, soft limits and hard limits of a selection."""

    cap_elements: float
    cap_texts: float
    cap_edges: float
    cap_pixels: float
    elements_p99: float
    aspect_p95: float
    min_elements: float = 6
    min_vertices: float = 3
    min_side: float = 80
    min_pixels: float = 20_000
    max_pixels: float = 100_000_000
    max_aspect: float = 12.0
    min_ink_ratio: float = 0.02
    max_ink_ratio: float = 0.995
    min_gray_std: float = 2.0
    extreme_edge_count: float = 250
    extreme_edge_vertex_ratio: float = 8.0

    def columns(self) -> dict[str, Column]:
        return {k: F.lit(float(v)) for k, v in asdict(self).items()}


def quantile_profile(df: DataFrame, names: Sequence[str], points: Sequence[int] = POINTS) -> DataFrame:
    """(field, point, value): exact percentiles of all fields."""
    return percentiles(df, dict.fromkeys(names, points)).select("field", F.col("point").cast("int").alias("point"), F.round("value", 6).alias("value"))


def derived_policy(pages: DataFrame) -> DataFrame:
    """One row with the columns of Policy, from the pages themselves."""
    wanted: dict[str, list[float]] = {}

    def p(field: str, point: float) -> Column:
        wanted.setdefault(field, []).append(point)
        return F.round(F.max(F.when((F.col("field") == field) & (F.col("point") == point), F.col("value"))), 6)

    whole = lambda x: F.when(x >= 0, F.floor(x)).otherwise(F.ceil(x)).cast("double")
    fixed = {f.name: F.lit(float(f.default)) for f in fields(Policy) if isinstance(f.default, (int, float))}
    found = {
        "cap_elements": p("elements", 95), "cap_texts": p("texts", 95), "cap_edges": p("edges", 95), "cap_pixels": p("pixels", 90),
        "elements_p99": p("elements", 99), "aspect_p95": p("aspect", 95),
        "min_elements": F.greatest(F.lit(6.0), whole(p("elements", 5))),
        "max_pixels": F.least(F.lit(100e6), F.greatest(F.lit(20e6), whole(p("pixels", 99.8)))),
        "max_aspect": F.least(F.lit(12.0), F.greatest(F.lit(8.0), p("aspect", 99.5))),
        "extreme_edge_count": F.greatest(F.lit(250.0), whole(p("edges", 99.5))),
    }
    return percentiles(pages, wanted).agg(*[(fixed | found)[f.name].alias(f.name) for f in fields(Policy)])


def recorded_or(policy: Policy | None, pages: DataFrame) -> DataFrame:
    """A recorded policy takes the place of a derived one as a whole."""
    return pages.sparkSession.range(1).select(*[c.alias(n) for n, c in policy.columns().items()]) if policy else derived_policy(pages)


def edge_ratio() -> Column:
    return F.col("edges") / F.greatest(F.col("verts"), F.lit(1))


def hard_reasons() -> Column:
    """Names of the limits that a page breaks; the page's row also holds the policy's columns."""
    c = F.col
    return reasons(
        ("too_few_elements", c("elements") < c("min_elements")),
        ("too_few_vertices", c("verts") < c("min_vertices")),
        ("side_too_short", F.least("png_w", "png_h") < c("min_side")),
        ("too_few_pixels", c("pixels") < c("min_pixels")),
        ("extreme_pixel_count", c("pixels") > c("max_pixels")),
        ("extreme_aspect_ratio", c("aspect") > c("max_aspect")),
        ("extreme_ink_ratio", ~c("ink_ratio").between(c("min_ink_ratio"), c("max_ink_ratio"))),
        ("near_blank_image", c("gray_std") < c("min_gray_std")),
        ("extreme_repeated_edges", (c("edges") > c("extreme_edge_count")) & (edge_ratio() > c("extreme_edge_vertex_ratio"))),
    )


def structure_score() -> Column:
    """How much a page shows, from its counts against the policy's caps, with bonus and deductions."""
    c = F.col
    minus = lambda test, by: F.when(test, by).otherwise(0.0)
    total = sum((w * level(c(n), c(f"cap_{n}")) for n, w in WEIGHTS.items()), F.lit(0.0))
    total = total + minus((c("texts") > 0) & (c("edges") > 0), F.lit(0.04)) - minus(c("elements") > c("elements_p99"), F.lit(0.10))
    total = total - minus(c("aspect") > c("aspect_p95"), F.lit(0.08)) - minus((c("ink_ratio") > 0.97) | (c("ink_ratio") < 0.05), F.lit(0.12))
    return F.round(total - minus(edge_ratio() > 5, F.least(F.lit(0.20), 0.02 * (edge_ratio() - 5))), 8)


def scored(pages: DataFrame, policy: DataFrame) -> DataFrame:
    """Pages with structure_score, edge_vertex_ratio and structural_reject_reasons; the policy is one row, so it is sent to all tasks."""
    names = policy.columns
    out = pages.crossJoin(F.broadcast(policy)).withColumns({"structure_score": structure_score(), "edge_vertex_ratio": F.round(edge_ratio(), 6), "structural_reject_reasons": hard_reasons()})
    return out.drop(*names)


def coarse_selection(scores: DataFrame, fraction: float, key: str = "png") -> tuple[DataFrame, DataFrame]:
    """(candidates, rejects): the best eligible pages, a fraction of all pages; ranks and percentiles are among the eligible."""
    if not 0 < fraction <= 1:
        raise ValueError("the fraction lies in (0, 1]")
    scores = settled(scores, "scores")  # counted, ranked and rejected from
    counts = scores.agg(F.count("*").alias("_all"), F.count_if(F.size("structural_reject_reasons") == 0).alias("_ok"))  # one row
    order = [F.desc("structure_score"), F.desc("elements"), F.desc(key)]
    ranked = numbered(scores.filter(F.size("structural_reject_reasons") == 0), order, "coarse_rank").crossJoin(F.broadcast(counts))
    target = F.least(F.col("_ok"), F.bround(F.col("_all") * F.lit(fraction), 0))
    share = F.round(1 - (F.col("coarse_rank") - 1) / F.greatest(F.col("_ok") - 1, F.lit(1)), 8)
    ranked = ranked.withColumn("structure_percentile", share).withColumn("_in", F.col("coarse_rank") <= target)
    chosen = ranked.filter("_in").drop("_in", "_all", "_ok", "structural_reject_reasons")
    tail = ranked.filter("not _in").select(*scores.columns).withColumn("structural_reject_reasons", F.array(F.lit("below_structure_cutoff")))
    return chosen, scores.filter(F.size("structural_reject_reasons") > 0).unionByName(tail)


def with_margin(scores: DataFrame, positive: str = "positive_logit", negative: str = "negative_logit") -> DataFrame:
    """A page without a margin, because its image could not be read, is kept at this point."""
    margin = F.col(positive) - F.col(negative)
    return scores.withColumn("model_margin", margin).withColumn("model_keep", F.coalesce(margin > MARGIN_ABOVE, F.lit(True)))


def selection(threshold: float | None = None) -> tuple[Column, Column]:
    """(keep, why not): the model's own decision, or a margin of at least ``threshold``."""
    if threshold is None:
        keep, why = F.col("model_keep"), "model_veto"
    else:
        keep, why = F.coalesce(F.col("model_margin") >= threshold, F.lit(False)), "siglip_margin_below_threshold"
    return keep, F.when(keep, F.lit("")).otherwise(F.lit(why))


def mean_views(logits: DataFrame, key: str, prompt: str, value: str) -> DataFrame:
    """The mean logit of each image and prompt over the image's views."""
    return logits.groupBy(key, prompt).agg(F.avg(F.col(value).cast("double")).alias(value))


def run_stats(pages: DataFrame, unique: DataFrame, zeros: Sequence[str]) -> DataFrame:
    """One row: pages of each kind, rows that duplicates took away, and pages where a count is zero."""
    kept = unique.agg(F.count("*").alias("unique_pages"))  # one row
    usable = F.col("is_cs") & F.col("valid")
    return pages.agg(
        F.count("*").alias("all_pages"), F.count_if("valid").alias("valid_pages"), F.count_if("is_cs").alias("cs_pages"), F.count_if(usable).alias("valid_cs_pages"), F.count_if("is_main").alias("main_pages"),
        *[F.count_if(F.col(z) == 0).alias(f"zero_{z}") for z in zeros],
    ).crossJoin(F.broadcast(kept)).withColumn("duplicates_removed", F.col("valid_cs_pages") - F.col("unique_pages"))


RANKINGS = {"structure": ("structure_score", "elements", "texts"), "model": ("model_margin", "structure_score", "elements")}


def final_rank(selected: DataFrame, ranking: str = "structure", top: int = 0, key: str = "png") -> DataFrame:
    """Ranks from 1, all orders descending, nulls last; ``top`` of 0 or less keeps all."""
    order = [F.col(c).desc_nulls_last() for c in (*RANKINGS[ranking], key)]
    if top > 0:
        selected = selected.orderBy(*order).limit(top)
    return numbered(selected, order, "final_rank")


def bundles(selected: DataFrame, threshold: float, expected: int | None = None) -> DataFrame:
    """(arxiv_id, figures by rank) of the pages that reach the threshold."""
    out = selected.filter(F.col("structure_score") >= threshold).groupBy("arxiv_id").agg(F.sort_array(F.collect_list(F.struct("final_rank", "png"))).alias("figures")).orderBy("arxiv_id")
    if expected is not None and (n := out.count()) != expected:
        raise ValueError(f"{n} papers, expected {expected}")
    return out

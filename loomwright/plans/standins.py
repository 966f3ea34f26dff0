"""The engine's relations, made from the driver's tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.functions.scalars import aspect, page_metrics
from loomwright.session import table

#: What plays the parts of vertices, edges, images and values in web pages.
MARKUP = {"vertex": r"<p>", "edge": r"<a ", "image": r"<h1", "value": r'href="([^"]*)"'}


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page index from web pages: markup metrics, and picture features from their sizes."""
    p = table(spark, sf_dir, "pages")
    n = F.length("html")
    w, h = (n % 1200 + 60).cast("int"), (n % 700 + 60).cast("int")
    out = p.select(
        F.format_string("p%08d", "page_id").alias("png"),
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("arxiv_id"),
        F.sha2("html", 256).alias("sha256"),
        *[c.alias(k) for k, c in page_metrics(F.col("html"), **MARKUP).items()],
        w.alias("png_w"), h.alias("png_h"), (w.cast("long") * h).alias("pixels"), aspect(w, h).alias("aspect"),
        F.octet_length("html").cast("long").alias("png_bytes"),
        F.round((n % 997) / 997.0, 6).alias("ink_ratio"), F.round((n % 83) / 4.0, 4).alias("gray_std"), F.round((n % 251).cast("double"), 4).alias("gray_mean"),
        (F.col("page_id") % 3 == 0).alias("is_main"),
    )
    return out


PAGES_SQL = r"""
page_index AS (
  SELECT *, greatest(verts - images, 0) AS boxes, verts + edges AS elements, CAST(png_w AS BIGINT) * png_h AS pixels,
    round(greatest(png_w, png_h) / greatest(least(png_w, png_h), 1), 6) AS aspect
  FROM (SELECT format('p{:08d}', page_id) AS png, regexp_extract(url, '^https?://([^/]+)', 1) AS arxiv_id, sha256(html) AS sha256,
    len(regexp_extract_all(html, '<p>')) AS verts, len(regexp_extract_all(html, '<a ')) AS edges, len(regexp_extract_all(html, '<h1')) AS images,
    len(list_filter(regexp_extract_all(html, 'href="([^"]*)"', 1), lambda v: trim(regexp_replace(v, '<[^>]+>', '', 'g')) <> '')) AS texts,
    CAST(length(html) % 1200 + 60 AS INT) AS png_w, CAST(length(html) % 700 + 60 AS INT) AS png_h, strlen(html) AS png_bytes,
    round((length(html) % 997) / 997.0, 6) AS ink_ratio, round((length(html) % 83) / 4.0, 4) AS gray_std, CAST(length(html) % 251 AS DOUBLE) AS gray_mean, page_id % 3 = 0 AS is_main
    FROM pages))"""

POLICY_SQL = """
policy AS (SELECT
  round(quantile_cont(elements::DOUBLE, 0.95), 6) AS cap_elements, round(quantile_cont(texts::DOUBLE, 0.95), 6) AS cap_texts,
  round(quantile_cont(edges::DOUBLE, 0.95), 6) AS cap_edges, round(quantile_cont(pixels::DOUBLE, 0.90), 6) AS cap_pixels,
  round(quantile_cont(elements::DOUBLE, 0.99), 6) AS elements_p99, round(quantile_cont(aspect, 0.95), 6) AS aspect_p95,
  greatest(6.0, trunc(round(quantile_cont(elements::DOUBLE, 0.05), 6)))::DOUBLE AS min_elements, 3.0::DOUBLE AS min_vertices, 80.0::DOUBLE AS min_side, 20000.0::DOUBLE AS min_pixels,
  least(100000000.0, greatest(20000000.0, trunc(round(quantile_cont(pixels::DOUBLE, 0.998), 6))))::DOUBLE AS max_pixels,
  least(12.0, greatest(8.0, round(quantile_cont(aspect, 0.995), 6)))::DOUBLE AS max_aspect, 0.02::DOUBLE AS min_ink_ratio, 0.995::DOUBLE AS max_ink_ratio, 2.0::DOUBLE AS min_gray_std,
  greatest(250.0, trunc(round(quantile_cont(edges::DOUBLE, 0.995), 6)))::DOUBLE AS extreme_edge_count, 8.0::DOUBLE AS extreme_edge_vertex_ratio
  FROM page_index)"""

_LEVEL = "ln(1 + least(greatest({0}::DOUBLE, 0), cap_{0})) / greatest(ln(1 + cap_{0}), 1e-9)"
SCORES_SQL = f"""
scores AS (SELECT page_index.*, round(edges / greatest(verts, 1), 6) AS edge_vertex_ratio,
  round(0.52 * {_LEVEL.format('elements')} + 0.23 * {_LEVEL.format('texts')} + 0.17 * {_LEVEL.format('edges')} + 0.08 * {_LEVEL.format('pixels')}
    + CASE WHEN texts > 0 AND edges > 0 THEN 0.04::DOUBLE ELSE 0 END - CASE WHEN elements > elements_p99 THEN 0.10::DOUBLE ELSE 0 END
    - CASE WHEN aspect > aspect_p95 THEN 0.08::DOUBLE ELSE 0 END - CASE WHEN ink_ratio > 0.97 OR ink_ratio < 0.05 THEN 0.12::DOUBLE ELSE 0 END
    - CASE WHEN edges / greatest(verts, 1) > 5 THEN least(0.20::DOUBLE, 0.02::DOUBLE * (edges / greatest(verts, 1) - 5)) ELSE 0 END, 8) AS structure_score,
  concat_ws(',', CASE WHEN elements < min_elements THEN 'too_few_elements' END, CASE WHEN verts < min_vertices THEN 'too_few_vertices' END,
    CASE WHEN least(png_w, png_h) < min_side THEN 'side_too_short' END, CASE WHEN pixels < min_pixels THEN 'too_few_pixels' END,
    CASE WHEN pixels > max_pixels THEN 'extreme_pixel_count' END, CASE WHEN aspect > max_aspect THEN 'extreme_aspect_ratio' END,
    CASE WHEN NOT ink_ratio BETWEEN min_ink_ratio AND max_ink_ratio THEN 'extreme_ink_ratio' END, CASE WHEN gray_std < min_gray_std THEN 'near_blank_image' END,
    CASE WHEN edges > extreme_edge_count AND edges / greatest(verts, 1) > extreme_edge_vertex_ratio THEN 'extreme_repeated_edges' END) AS reasons
  FROM page_index, policy)"""

RANKED_SQL = """
ranked AS (SELECT *, row_number() OVER (ORDER BY structure_score DESC, elements DESC, png DESC) AS coarse_rank, count(*) OVER () AS n_ok FROM scores WHERE reasons = ''),
chosen AS (SELECT *, round(1 - (coarse_rank - 1) / greatest(n_ok - 1, 1), 8) AS structure_percentile FROM ranked
  WHERE coarse_rank <= least(n_ok, round_even((SELECT count(*) FROM scores) * 0.6, 0)))"""


def bits_of_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64-bit codes of the vectors, by the rule of the perceptual hash."""
    from loomwright.functions.scalars import bits_above_median, hash_of_hex, hex_of_bits

    e = table(spark, sf_dir, "embeddings").filter("size(embedding) = 64")
    coded = e.select("vec_id", "label", hex_of_bits(bits_above_median(F.col("embedding").cast("array<double>"))).alias("phash"))
    return coded.withColumn("code", hash_of_hex(F.col("phash")))


BITS_SQL = """
bits AS (SELECT vec_id, label, list_transform(range(0, 64), lambda i: CASE WHEN i > 0 AND embedding[i + 1] > list_sort(embedding[2:64])[32] THEN 1 ELSE 0 END) AS b
  FROM embeddings WHERE len(embedding) = 64),
codes AS (SELECT vec_id, label, lower(list_aggregate(list_transform(range(0, 16), lambda j: substr('0123456789abcdef', CAST(b[4*j+1]*8 + b[4*j+2]*4 + b[4*j+3]*2 + b[4*j+4] + 1 AS INT), 1)), 'string_agg', '')) AS phash,
  list_sum(list_transform(range(0, 64), lambda i: b[i + 1]::HUGEINT << (63 - i)::INT)) AS wide FROM bits)"""


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, code): 64-bit codes in families of six, whose members differ from each other in none to six bits."""
    from loomwright.functions.scalars import hash_of_hex

    k = F.col("c_custkey")
    bit = lambda factor: F.expr(f"shiftleft(1L, cast(c_custkey * {factor} % 60 as int))")
    code = hash_of_hex(F.substring(F.sha1(F.floor(k / 6).cast("string")), 1, 16))
    for factor, least in ((7, 0), (11, 2), (13, 4)):
        code = F.when(k % 6 > least, code.bitwiseXOR(bit(factor))).otherwise(code)
    return table(spark, sf_dir, "customer").select(k.alias("k"), code.alias("code"))


_BIT = "(repeat('0', CAST(63 - k * {0} % 60 AS INT)) || '1' || repeat('0', CAST(k * {0} % 60 AS INT)))::BIT"
CODES_SQL = f"""
c0 AS (SELECT c_custkey AS k, from_hex(substr(sha1(CAST(floor(c_custkey / 6) AS BIGINT)::VARCHAR), 1, 16))::BIT AS code FROM customer),
c1 AS (SELECT k, CASE WHEN k % 6 > 0 THEN xor(code, {_BIT.format(7)}) ELSE code END AS code FROM c0),
c2 AS (SELECT k, CASE WHEN k % 6 > 2 THEN xor(code, {_BIT.format(11)}) ELSE code END AS code FROM c1),
codes AS (SELECT k, CASE WHEN k % 6 > 4 THEN xor(code, {_BIT.format(13)}) ELSE code END AS code FROM c2)"""

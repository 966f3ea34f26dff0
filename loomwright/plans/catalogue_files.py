"""Queries of files: manifests, archives, documents and pictures, made from the driver's rows so that SQL knows what must come out."""

from __future__ import annotations

import gzip
import io
import struct
import tarfile
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomwright.functions import images, markers, xml_pages
from loomwright.operators import relational
from loomwright.plans import jobs, releases, stages
from loomwright.plans.registry import query
from loomwright.plans.runner import Pipeline
from loomwright.session import dealt, settled, shared_folder, table
from loomwright.sources import archives, processes, services, sinks, tables


def _made(rows: DataFrame, make: Callable[[int], bytes], path: str) -> DataFrame:
    """(path, content) from whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([path.format(k) for k in keys]), pa.array([make(k) for k in keys], pa.binary())], ["path", "content"])

    return dealt(rows, rows.columns[0]).mapInArrow(run, "path string, content binary")


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def _tar(files: list[tuple[str, bytes]], mode: str = "w") -> bytes:
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode) as t:
        for name, body in files:
            info = tarfile.TarInfo(name)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))
    return out.getvalue()


# Manifests and documents of one value


@query("SELECT c_custkey::VARCHAR AS arxiv_id, c_custkey % 4 AS drawio_files FROM customer WHERE c_custkey % 3 = 0")
def manifest_round_trip(spark, d):
    k, path = F.col("c_custkey"), _folder(spark)
    sinks.write_jsonl(table(spark, d, "customer").select(k.cast("string").alias("arxiv_id"), F.when(k % 3 == 0, "accepted").otherwise("rejected").alias("status"), (k % 4).cast("int").alias("drawio_files")), path)
    return stages.rows_to_consolidate(spark, path, spark.range(0).select(F.lit("").alias("arxiv_id"))).select("arxiv_id", F.col("drawio_files").cast("long").alias("drawio_files"))


@query("SELECT 'a' AS name, 3::BIGINT AS n, (SELECT count(*) FROM nation) AS nations")
def json_document(spark, d):
    path = _folder(spark)
    sinks.write_json_document(spark, {"nations": table(spark, d, "nation").count(), "name": "a", "n": 3}, path)
    return tables.read_json(spark, path, "name STRING, n BIGINT, nations BIGINT").select("name", "n", "nations")


@query("SELECT c_custkey, '{\"a\":' || c_custkey || ',\"b\":\"' || c_name || '\"}' AS line FROM customer")
def sorted_json(spark, d):
    from loomwright.functions.scalars import sorted_json as to

    rows = table(spark, d, "customer").select("c_custkey", F.col("c_name").alias("b"), F.col("c_custkey").alias("a"), F.lit(None).cast("string").alias("c"))
    return rows.select("c_custkey", to("b", "c", "a").alias("line"))


# Archives


def _package(k: int) -> bytes:
    """Packages of four kinds: archive with a diagram and an image, archive without, one file, broken."""
    if k % 4 == 0:
        return _tar([(f"a/{k}.drawio", b"<mxfile/>"), ("b.svg", b"see diagrams.net")], "w:gz")
    if k % 4 == 1:
        return _tar([("c.tex", b"mxfile")], "w:gz")
    return gzip.compress(b"%PDF mxfile" if k % 4 == 2 else b"plain") if k % 8 != 7 else b"broken"


def _outer(k: int) -> bytes:
    """An archive of three packages, one of an old name, and two other files."""
    return _tar([(f"2401/2401.{3 * k + i:05d}.{'GZ' if i == 2 else 'gz'}", _package(3 * k + i)) for i in range(3)] + [(f"2401/math{k}.gz", _package(1)), ("2401/x.pdf", b"x")])


@query("SELECT s_suppkey, i, i < 2 AS digits FROM supplier, (SELECT unnest(range(4)) AS i)")
def outer_archives(spark, d):
    """Packages of paper archives in a folder, read as streams."""
    folder = _folder(spark)
    outer = _made(table(spark, d, "supplier").select("s_suppkey"), _outer, "a_{}.tar")
    sinks.write_files(outer.withColumnRenamed("path", "name"), folder)
    found, digits = (archives.read_packages(spark, folder, onlyDigits=only).filter("error is null") for only in (False, True))
    k = F.regexp_extract("package", "a_([0-9]+)", 1).cast("long")
    number = F.expr("try_cast(regexp_extract(member, '2401[.]([0-9]+)', 1) as bigint)")
    rows = found.select("package", "member").join(digits.select("package", "member", F.lit(True).alias("digits")), ["package", "member"], "left")
    return rows.select(k.alias("s_suppkey"), F.coalesce(number - 3 * k, F.lit(3)).alias("i"), F.coalesce("digits", F.lit(False)).alias("digits"))


def _broken_outer(k: int) -> bytes:
    """Every fifth archive is cut in its middle, every seventh is no archive."""
    whole = _outer(k)
    return b"no archive" if k % 7 == 0 else whole[: len(whole) // 2 + 100] if k % 5 == 0 else whole


@query("""WITH s AS (SELECT s_suppkey AS k FROM supplier), p AS (SELECT k, 3 * k + i AS n FROM s, (SELECT unnest(range(3)) AS i) UNION ALL SELECT k, 1 FROM s)
SELECT format('a_{:05d}_2401_{}.tar', k, k) AS source_key, '2401' AS month, count(*) AS papers_seen, count_if(n % 8 = 7)::BIGINT AS invalid_packages, count_if(n % 2 = 0)::BIGINT AS matches,
  CASE WHEN k % 7 = 0 OR k % 5 = 0 THEN 'later' ELSE 'first' END AS completed_by FROM p GROUP BY k""")
def archive_scan(spark, d):
    """A capped run, a run that fails for broken archives, and a run that finds them mended: none is lost."""
    folder, keys = _folder(spark), table(spark, d, "supplier").select("s_suppkey")

    def put(rows, make):
        made = _made(rows, make, "{}").withColumn("name", F.format_string("a_%05d_2401_%s.tar", F.col("path").cast("long"), F.col("path")))
        return sinks.write_files(made, f"{folder}/archives").select(F.regexp_extract("path", r"[^/]*\z", 0).alias("key"), F.lit("2401").alias("month"), "size", "path")

    outer, state = put(keys, _broken_outer), f"{folder}/state"
    for cap in (10, 0):
        try:
            jobs.scan(spark, outer, state, "2401", "2401", cap=cap, sleep=lambda s: None)
        except jobs.ScanFailed:
            pass  # what was read is completed
    first = settled(jobs.completions(spark, state).select("source_key"), "first")
    put(keys.filter("s_suppkey % 7 = 0 or s_suppkey % 5 = 0"), _outer)
    jobs.scan(spark, outer, state, "2401", "2401")
    done = jobs.completions(spark, state).drop("run")
    return done.join(first.withColumn("_f", F.lit(True)), "source_key", "left").withColumn("completed_by", F.when(F.col("_f"), "first").otherwise("later")).drop("_f")


@query("""SELECT doc_id::VARCHAR AS arxiv_id, strlen(text) AS size, sha256(text) AS sha256, CASE WHEN doc_id % 2 = 0 THEN 'invalid_source_package' WHEN contains(lower(text), 'mxfile') THEN 'single_payload_drawio_marker' ELSE '' END AS reasons FROM documents WHERE doc_id % 2 = 0 UNION ALL
SELECT doc_id::VARCHAR, -1, '', CASE WHEN contains(lower(text), 'mxfile') THEN 'single_payload_drawio_marker' ELSE '' END FROM documents WHERE doc_id % 2 = 1""")
def package_facts(spark, d):
    """Size and checksum of packages: texts as they are, which are no packages, and compressed ones, whose bytes SQL cannot know."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [gzip.compress(t.encode(), 1) if k % 2 else t.encode() for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), pa.array(rows, pa.binary())], ["path", "content"])

    packages = table(spark, d, "documents").select("doc_id", "text").mapInArrow(pack, "path string, content binary")
    even, found = F.col("arxiv_id").cast("long") % 2 == 0, stages.collect(packages, "")
    return found.select("arxiv_id", F.when(even, F.col("size")).otherwise(-1).alias("size"), F.when(even, F.col("sha256")).otherwise("").alias("sha256"), F.array_join("reasons", ",").alias("reasons"))


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'source_0001,source_0002' ELSE 'source_0001' END AS names, CASE WHEN s_suppkey % 4 = 0 THEN 'direct,embedded_drawio_xml' ELSE 'embedded_drawio_xml' END AS kinds FROM supplier WHERE s_suppkey % 2 = 0""")
def recovery_candidates(spark, d):
    packages = _made(table(spark, d, "supplier").select("s_suppkey"), _package, "p_{}")
    found = stages.candidates(tables.inner_files(packages)).groupBy("package").agg(F.sort_array(F.collect_list(F.struct("name", "recovery"))).alias("c"))
    k = F.regexp_extract("package", "p_([0-9]+)", 1).cast("long")
    return found.select(k.alias("s_suppkey"), F.array_join("c.name", ",").alias("names"), F.array_join("c.recovery", ",").alias("kinds"))


@query("SELECT s_suppkey, 1::BIGINT + (s_suppkey % 3 = 0)::BIGINT AS diagrams, CASE WHEN s_suppkey % 3 = 0 THEN 'a/d.drawio,b.svg' ELSE 'a/d.drawio' END AS members FROM supplier WHERE s_suppkey % 5 <> 0")
def recovered_diagrams(spark, d):
    """Of three candidates one is direct, one was extracted (a copy of it but for each third package), one was not."""
    k = F.col("package")
    papers = table(spark, d, "supplier").filter("s_suppkey % 5 != 0").select(F.col("s_suppkey").alias("package"))
    parts = [("a/d.drawio", "n1", "direct"), ("b.svg", "n2", "embedded_drawio_xml"), ("c.png", "n3", "embedded_drawio_xml")]
    found = papers.select("package", F.explode(F.array(*[F.struct(F.lit(m).alias("member"), F.lit(n).alias("name"), F.lit(r).alias("recovery")) for m, n, r in parts])).alias("c")).select("package", "c.*").withColumn("content", F.lit("<mxfile/>").cast("binary"))
    extracted = papers.select("package", F.lit("n2").alias("name"), F.when(k % 3 == 0, "<mxfile x='1'/>").otherwise("<mxfile/>").cast("binary").alias("xml"))
    return stages.recovered(found, extracted).groupBy(k.alias("s_suppkey")).agg(F.count("*").alias("diagrams"), F.array_join(F.sort_array(F.collect_list("member")), ",").alias("members"))


# Documents


@query("SELECT c_custkey, CASE WHEN c_custkey % 6 IN (0, 1) THEN 'mxfile' WHEN c_custkey % 6 = 2 THEN 'other' END AS root, c_custkey % 6 < 2 AS is_diagram, CASE WHEN c_custkey % 6 = 0 THEN c_custkey % 4 WHEN c_custkey % 6 IN (1, 2) THEN 1 ELSE 0 END AS pages FROM customer")
def well_formed(spark, d):
    k = F.col("c_custkey")
    whole = F.concat(F.lit("<mxfile>"), F.repeat(F.lit("<diagram/>"), (k % 4).cast("int")), F.lit("</mxfile>"))
    text = F.when(k % 6 == 0, whole).when(k % 6 == 1, "<mxfile><diagram/></mxfile>").when(k % 6 == 2, "<other/>").when(k % 6 == 3, "<mxfile>").when(k % 6 == 4, "<mxfile><diagram></mxfile>").otherwise("")
    rows = table(spark, d, "customer").select("c_custkey", text.cast("binary").alias("content"))
    seen = rows.select("c_custkey", markers.is_diagram_xml(F.col("content")).alias("is_diagram"), xml_pages.document_outline(F.col("content")).alias("o"))
    return seen.select("c_custkey", "o.root", "is_diagram", F.col("o.pages").cast("long").alias("pages"))


def _packed_page(k: int) -> bytes:
    """A document with a compressed page, compressed as a whole for odd numbers."""
    import base64
    import urllib.parse

    inner = "<mxGraphModel>" + f'<mxCell vertex="1" value="a+{k}%"/>' * (k % 5) + "</mxGraphModel>"
    packer = zlib.compressobj(9, zlib.DEFLATED, -15)
    body = base64.b64encode(packer.compress(urllib.parse.quote(inner).encode()) + packer.flush()).decode()
    data = f'<mxfile><diagram name="P{k}">{body}</diagram></mxfile>'.encode()
    return gzip.compress(data) if k % 2 else data


@query("SELECT s_suppkey, 'P' || s_suppkey AS page_name, (s_suppkey % 5)::INT AS verts, s_suppkey % 5 > 0 AS shows_value FROM supplier")
def compressed_pages(spark, d):
    from loomwright.functions import scalars

    docs = _made(table(spark, d, "supplier").select("s_suppkey"), _packed_page, "{}")
    pages = docs.select(F.col("path").cast("long").alias("s_suppkey"), F.explode(xml_pages.lenient_pages("content")).alias("p"))
    shows = F.contains("p.body", F.concat(F.lit('value="a+'), F.col("s_suppkey").cast("string"), F.lit('%"')))
    return pages.select("s_suppkey", "p.page_name", scalars.page_metrics(F.col("p.body"))["verts"].alias("verts"), shows.alias("shows_value"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '<mxGraphModel/>' WHEN c_custkey % 3 = 1 THEN '<mxfile><diagram name=\"b\" /></mxfile>' END AS page FROM customer")
def single_pages(spark, d):
    """The second page of documents; a bare model is its own page, and a document without a second one is an error."""

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k in batch.column(0).to_pylist():
                try:
                    source = "<mxGraphModel/>" if k % 3 == 0 else '<mxfile><diagram name="a"/>' + ('<diagram name="b"/>' if k % 3 == 1 else "") + "</mxfile>"
                    out.append(xml_pages.single_page(source, 2))
                except IndexError:
                    out.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["c_custkey", "page"])

    return table(spark, d, "customer").select("c_custkey").mapInArrow(second, "c_custkey long, page string")


def _renderer(items, seconds):
    """Fails on every call with a page of the sixth kind; a call of one page is let through unless it is that page."""
    if seconds < stages.CALL_SECONDS:
        raise TimeoutError
    if any('vertex="1"' not in body for _, body, _ in items):
        raise RuntimeError("bad page")
    return {key: b"x" * 200 for key, _, _ in items}


@query("""SELECT c_custkey AS arxiv_id, CASE WHEN c_custkey % 7 = 0 OR c_custkey % 7 = 6 THEN 'failed' ELSE 'complete' END AS status, CASE WHEN c_custkey % 7 = 0 THEN 0 WHEN c_custkey % 7 = 6 THEN 1 ELSE c_custkey % 7 % 3 + 1 END::BIGINT AS png_images FROM customer""")
def render_run(spark, d):
    """Documents that cannot be parsed, and documents with a page that no renderer makes an image of."""
    k = F.col("arxiv_id")
    good, bad = '<diagram><mxGraphModel><mxCell vertex="1"/></mxGraphModel></diagram>', '<diagram><mxGraphModel><mxCell edge="1"/></mxGraphModel></diagram>'
    body = F.when(k % 7 == 0, "<mxfile").when(k % 7 == 6, f"<mxfile>{good}{bad}</mxfile>").otherwise(F.concat(F.lit("<mxfile>"), F.repeat(F.lit(good), (k % 7 % 3 + 1).cast("int")), F.lit("</mxfile>")))
    docs = table(spark, d, "customer").select(F.col("c_custkey").alias("arxiv_id"), F.col("c_custkey").cast("string").alias("drawio_path"), body.alias("content").cast("binary").alias("content"))
    tasks = stages.render_tasks(docs)
    return stages.render_states(tasks, stages.rendered(tasks, _renderer)).select("arxiv_id", "status", "png_images")


@query("""SELECT arxiv_id, 'fig ' || n AS diagram, n AS figure_index, arxiv_id || ':images/' || n || '.png' AS figure_id, 'papers/' || arxiv_id || '/images/' || n || '.png' AS png FROM (SELECT l_orderkey::VARCHAR AS arxiv_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber)::INT AS n FROM lineitem)""")
def metadata_figures(spark, d):
    i = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber"))
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("arxiv_id"), i.alias("n"))
    figure = F.struct(F.format_string("drawio/fig %d.drawio", F.col("n")).alias("drawio_path"), F.format_string("images/%d.png", F.col("n")).alias("image_path"), F.col("n").alias("page_number"))
    metadata = lines.groupBy("arxiv_id").agg(F.sort_array(F.collect_list(F.struct("n", figure.alias("f")))).alias("f")).select("arxiv_id", F.col("arxiv_id").alias("paper_id"), F.col("f.f").alias("figures"))
    return stages.figures_of(metadata).select("arxiv_id", "diagram", "figure_index", "figure_id", "png")


@query("""SELECT l_orderkey::VARCHAR AS arxiv_id, 'd' || l_linenumber AS diagram, i AS page_number, l_linenumber = 1 AS is_main, (l_linenumber % 2)::BIGINT AS old_quality_score FROM lineitem, (SELECT unnest([1, 12]) AS i)""")
def legacy_figures(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("arxiv_id"), F.concat(F.lit("d"), F.col("l_linenumber").cast("string")).alias("diagram"), F.col("l_linenumber").cast("long").alias("n"))
    files = lines.select("arxiv_id", "diagram", F.explode(F.array(*map(F.lit, ("page_001.png", "page_12.png", "page_x.png", "source.drawio")))).alias("path"))
    first = lines.select("arxiv_id", "diagram", F.col("n").alias("position"), (F.col("n") == 1).alias("is_main"), F.lit(True).alias("pass"), (F.col("n") % 2).alias("score"))
    later = first.select("arxiv_id", "diagram", (F.col("position") + 100).alias("position"), (~F.col("is_main")).alias("is_main"), "pass", (F.col("score") + 5).alias("score"))
    return stages.legacy_figures(files, first.unionByName(later)).select("arxiv_id", "diagram", "page_number", "is_main", "old_quality_score")


# Pictures


def _grey(k: int) -> bytes:
    """A grey picture with a black square; the sixth kind is no picture."""
    if k % 6 == 5:
        return b"no picture"
    chunk = lambda n, b: struct.pack(">I", len(b)) + n + b + struct.pack(">I", zlib.crc32(n + b))
    size = 64 * (k % 3 + 1)
    pixels = np.full((size, size), 250, np.uint8)
    pixels[: size // 2, : size // 2] = k % 200
    raw = b"".join(b"\0" + r.tobytes() for r in pixels)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", size, size, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


@query("""SELECT s_suppkey, CASE WHEN k = 5 THEN 0 ELSE size END AS png_w, k = 5 AS failed, CASE WHEN k = 5 THEN 0 ELSE 0.25 END::DOUBLE AS ink_ratio, CASE WHEN k = 5 THEN 0 ELSE (3 * 250 + g) / 4.0 END::DOUBLE AS gray_mean, CASE WHEN k = 5 THEN 0 ELSE round((250 - g) * sqrt(3) / 4, 4) END::DOUBLE AS gray_std
FROM (SELECT s_suppkey, s_suppkey % 6 AS k, 64 * (s_suppkey % 3 + 1) AS size, s_suppkey % 200 AS g FROM supplier WHERE s_suppkey % 3 = 0 OR s_suppkey % 6 = 5)""")
def image_moments(spark, d):
    """Pictures of 64 pixels keep their values, whatever the resampling."""
    pictures = _made(table(spark, d, "supplier").filter("s_suppkey % 3 = 0 or s_suppkey % 6 = 5").select("s_suppkey"), _grey, "{}")
    f = pictures.select(F.col("path").cast("long").alias("s_suppkey"), images.image_features("content").alias("f")).select("s_suppkey", "f.*")
    return f.select("s_suppkey", F.col("png_w").cast("long").alias("png_w"), (F.col("image_error") != "").alias("failed"), "ink_ratio", "gray_mean", "gray_std")


def _pattern(k: int) -> bytes:
    """A picture of 64 x 64 grey values that look like noise."""
    y, x = np.arange(64)[:, None], np.arange(64)[None, :]
    pixels = ((k * 7919 + y * y * 31 + x * x * 17 + x * y * 13) % 251).astype(np.uint8)
    chunk = lambda n, b: struct.pack(">I", len(b)) + n + b + struct.pack(">I", zlib.crc32(n + b))
    raw = b"".join(b"\0" + r.tobytes() for r in pixels)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 64, 64, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


#: The hashes by sums over pixels: Lanczos weights for 32, 9 and 8 places, the cosine transform, its median, and neighbours' order.
_HASHES_SQL = """
WITH n64 AS (SELECT unnest(range(64)) AS i), px AS (SELECT s_suppkey AS k, a.i AS y, b.i AS x, (s_suppkey * 7919 + a.i * a.i * 31 + b.i * b.i * 17 + a.i * b.i * 13) % 251 AS v FROM supplier, n64 a, n64 b),
t AS (SELECT n, a.i AS i, b.i AS j, (b.i + 0.5 - (a.i + 0.5) * 64 / n) * n / 64 AS t FROM (SELECT unnest([32, 9, 8])::DOUBLE AS n) s, n64 a, n64 b WHERE a.i < n),
raw AS (SELECT n, i, j, CASE WHEN abs(t) >= 3 THEN 0 WHEN t = 0 THEN 1 ELSE sin(pi() * t) / (pi() * t) * sin(pi() * t / 3) / (pi() * t / 3) END AS r FROM t),
w AS (SELECT n, i, j, r / sum(r) OVER (PARTITION BY n, i) AS w FROM raw),
down AS (SELECT k, n, i AS y, x, sum(w * v) AS v FROM px JOIN w ON j = y WHERE n <> 9 GROUP BY ALL),
small AS (SELECT k, d.n, y, i AS x, least(255, greatest(0, round_even(sum(w * v), 0))) AS v FROM down d JOIN w ON j = x AND w.n = CASE WHEN d.n = 32 THEN 32 ELSE 9 END GROUP BY ALL),
c AS (SELECT a.i AS u, b.i AS j, cos(pi() * (2 * b.i + 1) * a.i / 64) * sqrt(CASE WHEN a.i = 0 THEN 1 ELSE 2 END / 32.0) AS c FROM n64 a, n64 b WHERE a.i < 8 AND b.i < 32),
rows_ AS (SELECT k, u, x, sum(c * v) AS v FROM small JOIN c ON j = y WHERE n = 32 GROUP BY ALL),
low AS (SELECT k, rows_.u, c.u AS v, sum(c * rows_.v) AS s FROM rows_ JOIN c ON j = x GROUP BY ALL),
high AS (SELECT k, u, v, u + v > 0 AND s > median(s) FILTER (u + v > 0) OVER (PARTITION BY k) AS bit FROM low),
bits AS (SELECT k, 'p' AS kind, u AS y, v AS x, bit FROM high UNION ALL
  SELECT k, 'd', y, x - 1, v > lag(v) OVER (PARTITION BY k, y ORDER BY x) FROM small WHERE n = 8 QUALIFY x > 0),
digits AS (SELECT k, kind, y, x // 4 AS half, sum(CASE WHEN bit THEN 8 >> (x % 4)::INT ELSE 0 END)::INT AS d FROM bits GROUP BY ALL),
hex_ AS (SELECT k, kind, string_agg(substr('0123456789abcdef', d + 1, 1), '' ORDER BY y, half) AS h FROM digits GROUP BY ALL),
thumbs AS (SELECT k, sha256(from_hex(string_agg(format('{:02x}', v), '' ORDER BY y, x))) AS thumbnail FROM px GROUP BY k)
SELECT p.k AS s_suppkey, p.h AS phash, d.h AS dhash, thumbnail FROM hex_ p JOIN hex_ d ON d.k = p.k AND d.kind = 'd' JOIN thumbs ON thumbs.k = p.k WHERE p.kind = 'p'"""


@query(_HASHES_SQL)
def picture_hashes(spark, d):
    """Both hashes of pictures, and their thumbnails, which for these are the pictures themselves."""
    pictures = _made(table(spark, d, "supplier").select("s_suppkey"), _pattern, "{}")
    f = pictures.select(F.col("path").cast("long").alias("s_suppkey"), images.image_features("content").alias("f"))
    return f.select("s_suppkey", "f.phash", "f.dhash", F.sha2("f.thumbnail", 256).alias("thumbnail"))


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 6 = 5 THEN '' ELSE size || ',' || (size // 2 + greatest(4, round_even(0.02 * (size // 2), 0)::INT)) END AS sides FROM (SELECT s_suppkey, 64 * (s_suppkey % 3 + 1) AS size FROM supplier)""")
def model_views(spark, d):
    pictures = _made(table(spark, d, "supplier").select("s_suppkey"), _grey, "{}")
    v = pictures.select(F.col("path").cast("long").alias("s_suppkey"), images.picture_views("content").alias("v"))
    return v.select("s_suppkey", F.array_join(F.transform("v.sizes", lambda s: F.element_at(s, 1).cast("string")), ",").alias("sides"))


def _scorer(views: list[np.ndarray], prompts: tuple[str, ...]) -> np.ndarray:
    """Every wanted prompt gets the side of the view by 64, every unwanted one 2."""
    return np.array([[v.shape[0] / 64 if p in stages.WANTED else 2.0 for p in prompts] for v in views])


@query("""SELECT s_suppkey, CASE WHEN k = 5 THEN NULL ELSE round(side, 6) END AS positive_logit, CASE WHEN k = 5 THEN NULL ELSE 2.0::DOUBLE END AS negative_logit, CASE WHEN k = 5 THEN NULL ELSE round(round(side, 6) - 2, 6) END AS model_margin, true AS model_keep, k <> 5 AS seen
FROM (SELECT s_suppkey, s_suppkey % 6 AS k, (size + size // 2 + greatest(4, round_even(0.02 * (size // 2), 0)::INT))::DOUBLE / 128 AS side FROM (SELECT s_suppkey, 64 * (s_suppkey % 3 + 1) AS size FROM supplier))""")
def model_scores(spark, d):
    pictures = _made(table(spark, d, "supplier").select("s_suppkey"), _grey, "{}").withColumnRenamed("path", "png")
    scores = stages.model_scores(pictures, _scorer)
    return scores.select(F.col("png").cast("long").alias("s_suppkey"), "positive_logit", "negative_logit", F.round("model_margin", 6).alias("model_margin"), "model_keep", F.col("model_error").isNull().alias("seen"))


@query("""WITH c AS (SELECT s_suppkey AS k, s_suppkey % 7 AS elements, CASE WHEN s_suppkey % 5 > 0 THEN s_suppkey % 5 - 1.0 END AS m FROM supplier)
SELECT k::VARCHAR AS png, CASE WHEN m >= 2 THEN row_number() OVER (PARTITION BY coalesce(m >= 2, false) ORDER BY m DESC NULLS LAST, elements / 7.0 DESC, elements DESC, k::VARCHAR DESC) END AS final_rank, CASE WHEN coalesce(m >= 2, false) THEN '' ELSE 'siglip_margin_below_threshold' END AS selection_reject_reason FROM c""")
def finalized_selection(spark, d):
    k = F.col("s_suppkey")
    chosen = table(spark, d, "supplier").select(k.cast("string").alias("png"), (k % 7 / 7.0).alias("structure_score"), (k % 7).alias("elements"), (k % 3).alias("texts"))
    scores = table(spark, d, "supplier").select(k.cast("string").alias("png"), F.when(k % 5 > 0, k % 5 - 1.0).alias("model_margin"), F.lit(True).alias("model_keep"))
    kept, rejected = stages.finalized(chosen, scores, threshold=2.0, ranking="model")
    rows = kept.select("png", F.col("final_rank").cast("long").alias("final_rank"), "selection_reject_reason")
    return rows.unionByName(rejected.select("png", F.lit(None).cast("long").alias("final_rank"), "selection_reject_reason"))


# Releases as files


_PNG = _grey(0)


def _release(spark: SparkSession, d: str) -> DataFrame:
    """(arxiv_id, path, content) of papers of five kinds: good, page beyond the document, malformed diagram, no picture, a file too many."""
    k = F.col("s_suppkey")
    xml = F.when(k % 5 == 2, "<mxfile>").otherwise("<mxfile><diagram/></mxfile>")
    name = F.when(k % 5 == 1, "images/d_p003.png").otherwise("images/d_p001.png")
    file = lambda path, content: F.struct(path.alias("path"), content.alias("content"))
    files = [file(F.lit("paper.md"), F.lit("text").cast("binary")), file(F.lit("drawio/d.drawio"), xml.cast("binary")), file(name, F.when(k % 5 == 3, F.lit("x").cast("binary")).otherwise(F.lit(bytearray(_PNG))))]
    more = F.when(k % 5 == 4, F.array(file(F.lit("notes.txt"), F.lit("n").cast("binary")))).otherwise(F.array().cast("array<struct<path: string, content: binary>>"))
    return table(spark, d, "supplier").select(F.format_string("2401.%05d", k).alias("arxiv_id"), F.explode(F.concat(F.array(*files), more)).alias("f")).select("arxiv_id", "f.*")


@query("""SELECT format('2401.{:05d}', s_suppkey) AS arxiv_id, CASE s_suppkey % 5 WHEN 2 THEN 'not a diagram: d' WHEN 3 THEN 'not a PNG: images/d_p001.png' WHEN 4 THEN 'unexpected layout' ELSE '' END AS errors, CASE WHEN s_suppkey % 5 = 1 THEN 'page beyond document: images/d_p003.png' WHEN s_suppkey % 5 = 2 THEN 'page beyond document: images/d_p001.png' ELSE '' END AS warnings FROM supplier""")
def validate_rules(spark, d):
    return stages.validated(_release(spark, d)).select("arxiv_id", F.array_join("errors", ",").alias("errors"), F.array_join("warnings", ",").alias("warnings"))


@query("SELECT count(*) AS papers, count(*)::BIGINT AS drawio_files, count(*)::BIGINT AS png_images, count_if(s_suppkey % 5 IN (2, 3, 4))::BIGINT AS errors, count_if(s_suppkey % 5 IN (1, 2))::BIGINT AS warnings FROM supplier")
def validate_audit(spark, d):
    return stages.audit(stages.validated(_release(spark, d)))


@query("SELECT format('2401.{:05d}', s_suppkey) AS arxiv_id, (CASE WHEN s_suppkey % 5 = 1 THEN 3 ELSE 1 END)::INT AS page_number, 4 AS n_chars FROM supplier")
def dataset_reader(spark, d):
    files = _release(spark, d).withColumn("path", F.concat_ws("/", F.lit("papers"), "arxiv_id", "path"))
    return stages.read_dataset(files).select("arxiv_id", "page_number", "n_chars")


@query("""WITH p AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS i FROM supplier) SELECT format('set-{:05d}.tar', i // 4) AS filename, format('2401.{:05d}', s_suppkey) AS paper, 3 + (s_suppkey % 5 = 4)::INT AS members, '' AS problems FROM p""")
def packed_archives(spark, d):
    """Papers of 4,096 bytes at most, four to an archive, written, read again and checked."""
    files = _release(spark, d).withColumn("name", F.concat_ws("/", "arxiv_id", "path"))
    plan = releases.shard_plan(files.select("arxiv_id", "path", F.lit(100).alias("size")), 4 * 4 * 1024, "set").select("arxiv_id", "shard").distinct()
    four = table(spark, d, "supplier").select(F.format_string("2401.%05d", "s_suppkey").alias("arxiv_id"))
    from loomwright.operators.ordered import numbered

    plan = plan.drop("shard").join(numbered(four, ["arxiv_id"], "shard", 0).withColumn("shard", F.floor(F.col("shard") / 4).cast("long")), "arxiv_id")
    folder = _folder(spark)
    report = sinks.write_shards(files.join(plan, "arxiv_id"), folder, "set")
    members = sinks.archive_members(spark, folder)
    problems = stages.check_archives(report, members).groupBy("filename").agg(F.array_join(F.sort_array(F.collect_list("problem")), ",").alias("problems"))
    rows = members.filter("name is not null").groupBy("filename", F.split_part("name", F.lit("/"), F.lit(1)).alias("paper")).agg(F.count("*").cast("int").alias("members"))
    return rows.join(problems, "filename", "left").withColumn("problems", F.coalesce("problems", F.lit("")))


@query("""SELECT s_suppkey, i::INT AS i, 512 + 1024 * i AS "offset", 10 + i + length(s_suppkey::VARCHAR) AS size, sha256(s_suppkey || ':' || repeat('x', (9 + i)::INT)) AS sha256 FROM supplier, (SELECT unnest(range(5)) AS i) WHERE s_suppkey % 4 <> 3""")
def member_index(spark, d):
    """Members of archives by the index of their places, read by range; every fourth archive is empty."""
    folder = _folder(spark)
    make = lambda k: _tar([(f"{k}/{i}.txt", f"{k}:{'x' * (9 + i)}".encode()) for i in range(5 * (k % 4 != 3))])
    put = sinks.write_files(_made(table(spark, d, "supplier").select("s_suppkey"), make, "m_{}.tar").withColumnRenamed("path", "name"), folder)
    found = archives.member_digests(archives.spread(archives.index(put), 2048))
    name = F.split("member", "[/.]")
    return found.select(name[0].cast("long").alias("s_suppkey"), name[1].cast("int").alias("i"), "offset", "size", "sha256")


@query("SELECT s_suppkey, CASE s_suppkey % 5 WHEN 3 THEN 3 WHEN 4 THEN -6 ELSE 0 END AS code, CASE WHEN s_suppkey % 5 = 4 THEN '' ELSE upper(s_name) END AS output FROM supplier")
def supervised_programs(spark, d):
    """A program for each supplier, which may fail or crash, and leaves a helper behind."""
    # A shell starts six times as fast as Python; Spark's own scripts need this one.
    code = r"""IFS= read -r -d '' row
k=${row%%|*} name=${row#*|}
sleep 60 &
if ((k % 5 == 4)); then kill -ABRT $$; fi
printf %s "${name^^}"
exit $((k % 5 == 3 ? 3 : 0))"""
    rows = table(spark, d, "supplier").select("s_suppkey", F.concat_ws("|", F.col("s_suppkey").cast("string"), "s_name").cast("binary").alias("content"))
    ended = processes.run_programs(rows, "s_suppkey", "content", ["bash", "-c", code], seconds=60)
    return ended.select("s_suppkey", F.col("returncode").alias("code"), F.col("output").cast("string").alias("output"))


@query("SELECT c_custkey::VARCHAR AS arxiv_id, CASE WHEN c_custkey % 7 = 3 THEN 2 ELSE 1 END AS attempts, CASE WHEN c_custkey % 7 = 3 THEN 'KeyError' ELSE '' END AS error, CASE WHEN c_custkey % 7 = 3 THEN 0 ELSE 1000 + c_custkey % 9 END AS size FROM customer WHERE c_custkey % 2 = 0")
def lasting_fetches(spark, d):
    """Answers for a part of the papers, then for all of them: the second run asks only for what is not there."""

    def fetch(name: str) -> services.Answer:
        if int(name) % 7 == 3:
            raise KeyError(name)
        return 200, {}, b"x" * (1000 + int(name) % 9)

    papers = table(spark, d, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").cast("string").alias("arxiv_id"))
    store = services.Fetched(spark, _folder(spark))
    for some in (papers.filter("cast(arxiv_id as long) % 6 = 0"), papers):
        answers = store.fetch(some, fetch, retries=2, delay=0.0)
    error = F.coalesce(F.split_part("error", F.lit(":"), F.lit(1)), F.lit(""))
    return answers.select("arxiv_id", "attempts", error.alias("error"), F.coalesce(F.length("content"), F.lit(0)).cast("long").alias("size"))


@query("""WITH p AS (SELECT s_suppkey AS k, (s_suppkey % 8) AS kind, format('set-{:05d}.tar', s_suppkey) AS filename, format('2401.{:05d}', s_suppkey) AS paper FROM supplier)
SELECT filename, CASE kind WHEN 1 THEN 'checksum' WHEN 2 THEN 'missing 2402.00001' WHEN 3 THEN 'repeated ' || paper || '/paper.md' WHEN 4 THEN 'unexpected ' || paper || 'x' WHEN 5 THEN 'missing ' || paper END AS problem FROM p WHERE kind BETWEEN 1 AND 5
UNION ALL SELECT filename, unnest(['checksum', 'unreadable ReadError', 'missing ' || paper]) FROM p WHERE kind = 6
UNION ALL SELECT filename, unnest(['checksum', 'unreadable EOFError']) FROM p WHERE kind = 7""")
def archive_problems(spark, d):
    """An archive for each supplier, of eight kinds: right, or wrong in one way or another."""
    folder, k = _folder(spark), F.col("s_suppkey")

    def make(n: int) -> bytes:
        paper, kind = f"2401.{n:05d}", n % 8
        files = [] if kind == 5 else [(f"{paper}/paper.md", b"text" * 300)] * (1 + (kind == 3)) + [(f"{paper}x/paper.md", b"t")] * (kind == 4)
        whole = _tar(files)
        # cut inside of the first header, or of the first member
        return whole[:300] if kind == 6 else whole[:700] if kind == 7 else whole

    made = _made(table(spark, d, "supplier").select("s_suppkey"), make, "{}").withColumn("name", F.format_string("set-%05d.tar", F.col("path").cast("long")))
    sinks.write_files(made, folder)
    members = settled(sinks.archive_members(spark, folder), "members")
    kind = F.regexp_extract("filename", "([0-9]+)", 1).cast("long") % 8
    paper = F.concat(F.lit("2401."), F.regexp_extract("filename", "([0-9]+)", 1))
    sums = members.select("filename", "sha256").distinct()
    told = F.when(kind == 2, F.array(paper, F.lit("2402.00001"))).otherwise(F.array(paper))
    report = sums.select("filename", F.when(kind.isin(1, 6, 7), "other").otherwise(F.col("sha256")).alias("sha256"), told.alias("papers"))
    return stages.check_archives(report, members)


@query("""SELECT format('2401.{:05d}', s_suppkey) AS arxiv_id, CASE WHEN s_suppkey % 3 = 1 THEN 'render status partial' ELSE '' END AS reason, CASE WHEN s_suppkey % 3 = 1 THEN 0 ELSE 3 + (s_suppkey % 5 = 4)::INT END::BIGINT AS files FROM supplier""")
def export_skipping(spark, d):
    """Papers that are not complete are told and left out of an export that may skip them."""
    k = F.col("s_suppkey")
    states = table(spark, d, "supplier").filter(k % 3 != 2).select(F.format_string("2401.%05d", k).alias("arxiv_id"), F.when(k % 3 == 1, "partial").otherwise("complete").alias("status"))
    chosen, bad = stages.export(_release(spark, d), states, skip_incomplete=True)
    counts = chosen.groupBy("arxiv_id").agg(F.count("*").alias("files"))
    papers = table(spark, d, "supplier").select(F.format_string("2401.%05d", k).alias("arxiv_id"))
    return papers.join(counts, "arxiv_id", "left").join(bad, "arxiv_id", "left").select("arxiv_id", F.coalesce("reason", F.lit("")).alias("reason"), F.coalesce("files", F.lit(0)).cast("long").alias("files"))


@query("SELECT o_custkey, count(*) AS n FROM orders WHERE o_totalprice > 1000 GROUP BY 1")
def stage_runner(spark, d):
    """Two stages, run twice: the second run finds both done; a stage that may fail is left out."""
    p = Pipeline(_folder(spark))
    p.stage("large")(lambda spark, done: done["orders"].filter("o_totalprice > 1000"))
    p.stage("broken", may_fail=True)(lambda spark, done: done["nothing"])
    p.stage("counts")(lambda spark, done: done["large"].groupBy("o_custkey").agg(F.count("*").alias("n")))
    p.run(spark, {"orders": table(spark, d, "orders")})
    return p.run(spark, {"orders": spark.range(0)})["counts"]


@query("SELECT c_custkey::VARCHAR AS key, c_custkey % 3 <> 0 AND CASE WHEN c_custkey % 4 = 0 THEN 1.5 WHEN c_custkey % 2 = 0 THEN 2.0 ELSE 1.25 END >= (CASE WHEN c_acctbal > 0 THEN 2.0 ELSE 1.5 END) AS reused FROM customer")
def previous_figures(spark, d):
    """A figure for each customer; two thirds have two earlier ones, of which the later counts."""
    c, k = table(spark, d, "customer"), F.col("c_custkey")
    tasks = c.select(k.cast("string").alias("key"), F.when(F.col("c_acctbal") > 0, 2.0).otherwise(1.5).alias("min_scale"))
    later = F.when(k % 4 == 0, 1.5).when(k % 2 == 0, 2.0).otherwise(1.25)
    old = c.filter(k % 3 != 0).select(k.cast("string").alias("key"), F.explode(F.array(F.struct(F.lit(2.0).alias("scale"), F.lit(0).alias("at")), F.struct(later.alias("scale"), F.lit(1).alias("at")))).alias("o")).select("key", "o.*")
    return relational.reuse(tasks, old, ["key"], "at").select("key", "reused")

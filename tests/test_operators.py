import io
import struct
import zlib
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomwright.functions import images, xml_pages
from loomwright.operators import dedup, folds, quality, relational
from loomwright.plans import stages
from loomwright.plans.runner import Pipeline
from loomwright.sources import sinks, tables
from loomwright.streaming.incremental import latest_by_stream


def png(pixels: np.ndarray) -> bytes:
    """An 8-bit grey PNG."""
    def chunk(name, body):
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    h, w = pixels.shape
    raw = b"".join(b"\0" + row.tobytes() for row in pixels.astype(np.uint8))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def drawing(seed: int, size: int = 120) -> np.ndarray:
    out = np.full((size, size), 255)
    rng = np.random.default_rng(seed)
    for _ in range(12):
        x, y, w, h = rng.integers(5, size - 50, 2).tolist() + rng.integers(10, 45, 2).tolist()
        out[y : y + h, x : x + w] = rng.integers(0, 200)
    return out


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=80), st.integers(10, 50))
def test_next_fit_fills_in_order(weights, cap):
    bins, _ = folds.next_fit(np.array(weights, float), cap)
    for b in set(bins.tolist()):
        inside = [w for w, x in zip(weights, bins) if x == b]
        assert sum(inside) <= cap or len(inside) == 1
    assert sorted(set(bins.tolist())) == list(range(len(set(bins.tolist()))))
    for i in range(1, len(weights)):
        if bins[i] != bins[i - 1]:
            assert bins[i] == bins[i - 1] + 1 and sum(w for w, x in zip(weights[:i], bins) if x == bins[i - 1]) + weights[i] > cap


def test_next_fit_in_blocks_is_the_same(spark):
    rows = [(i, (i * 37) % 23 + 1) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, w long")
    one = {r.k: r.bin for r in folds.pack_next_fit(df, ["k"], F.col("w"), 40).collect()}
    many = {r.k: r.bin for r in folds.pack_next_fit(df.repartition(7), ["k"], F.col("w"), 40, block=60).collect()}
    assert one == many and len(one) == 500
    assert folds.pack_next_fit(df.limit(0), ["k"], F.col("w"), 40).count() == 0


@pytest.mark.parametrize("radius", [0, 3, 7])
def test_band_join_is_exact(spark, radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(-(2**63), 2**63 - 1, 12, dtype=np.int64)
    codes = [int(b) ^ sum(1 << int(x) for x in rng.choice(63, rng.integers(0, 6), replace=False)) for b in base for _ in range(6)]
    rows = [(i, c) for i, c in enumerate(codes)] + [(99, None)]
    got = {(r.left_k, r.right_k, r.distance) for r in dedup.hamming_pairs(spark.createDataFrame(rows, "k long, c long"), "k", "c", radius).collect()}
    far = lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1")
    assert got == {(i, j, far(a, b)) for (i, a), (j, b) in combinations(rows[:-1], 2) if far(a, b) <= radius}


def test_components_and_cliques(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 6), (3, 9), (9, 1)], "left_k long, right_k long")
    label = {r.node: r.component for r in dedup.connected(edges, "left_k", "right_k").collect()}
    assert label == {1: 1, 2: 1, 3: 1, 9: 1, 5: 5, 6: 5}
    rows = spark.createDataFrame([(k, c, -k) for k, c in label.items()], "k long, component long, place long")
    clique = {r.k: r.clique for r in dedup.cliques(rows, edges, "component", "k", "place").collect()}
    assert clique == {9: 0, 3: 0, 2: 1, 1: 1, 6: 0, 5: 0}
    assert dedup.connected(edges.limit(0), "left_k", "right_k").count() == 0


def test_upserts_and_audits(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, at long, v string")
    new = spark.createDataFrame([("b", 1, "z"), ("b", 0, "w"), ("c", 5, "q")], "k string, at long, v string")
    assert {(r.k, r.v) for r in relational.upsert(old, new, "k", "at").collect()} == {("a", "x"), ("b", "z"), ("c", "q")}
    got = relational.set_audit(old.select("k"), new.select("k"), ["k"]).collect()
    assert {(r.k, r.problem) for r in got} == {("a", "missing"), ("b", "repeated"), ("c", "unexpected")}
    states = relational.consolidated(old.select("k"), spark.createDataFrame([("a", "done")], "k string, status string"), "k")
    assert {(r.k, r.status) for r in states.collect()} == {("a", "done"), ("b", "pending")}


def test_months(spark):
    assert [r.month for r in tables.descending_months(spark, "2502", "2411").collect()] == ["2502", "2501", "2412", "2411"]
    for start, stop in (("2413", "2401"), ("2401", "2402"), ("x", "2401")):
        with pytest.raises(ValueError):
            tables.descending_months(spark, start, stop)


CELLS = '<mxGraphModel><root><mxCell vertex="1" value="A"><mxGeometry x="10" y="0" width="80" height="40"/></mxCell><mxCell vertex="1" value=" "/><mxCell edge="1"/></root></mxGraphModel>'


def test_page_readers():
    two = f'<mxfile><diagram name="One">{CELLS}</diagram><diagram/></mxfile>'
    assert [(p["page_number"], p["page_name"]) for p in xml_pages.lenient(two)] == [(1, "One"), (2, "Page-2")]
    assert [p["page_number"] for p in xml_pages.strict(two)["pages"]] == [1]
    assert xml_pages.lenient("<a")[0]["body"] == "<a" and "ParseError" in xml_pages.strict("<a")["error"]
    packer = zlib.compressobj(9, zlib.DEFLATED, -15)
    import base64
    import urllib.parse

    body = base64.b64encode(packer.compress(urllib.parse.quote(CELLS).encode()) + packer.flush()).decode()
    assert "mxCell" in xml_pages.lenient(f"<mxfile><diagram>{body}</diagram></mxfile>")[0]["body"]
    assert xml_pages.inflate("!!") == "" and xml_pages.bounding_box(CELLS) == {"width": 100.0, "height": 60.0}
    assert xml_pages.bounding_box("<x") == {"width": 1000.0, "height": 800.0}
    with pytest.raises(IndexError):
        xml_pages.single_page(two, 3)


def test_png_features():
    row = images.features(png(drawing(1)))
    assert (row["png_w"], row["png_h"], row["image_error"], len(row["phash"])) == (120, 120, "", 16)
    near, far = drawing(1), drawing(2)
    near[0, 0] = 250
    a, b, c = (int(images.features(png(x))["phash"], 16) for x in (drawing(1), near, far))
    assert bin(a ^ b).count("1") <= 4 < bin(a ^ c).count("1")
    assert "not a PNG" in images.features(b"zz")["image_error"] and images.features(None)["image_error"]
    rgb = images.decode_png(png(drawing(3)))
    assert (rgb[..., 0] == drawing(3)).all() and (rgb[..., 3] == 255).all()


def test_curation_from_documents_to_archives(spark, tmp_path):
    doc = lambda i: f'<mxfile><diagram name="P">{CELLS.replace("A", f"A{i}")}</diagram></mxfile>'.encode()
    papers = [f"2401.{i:05d}" for i in range(6)]
    documents = spark.createDataFrame([(f"{p}/drawio/d.drawio", doc(i)) for i, p in enumerate(papers)] + [("x.drawio", b"<a")], "drawio_path string, content binary")
    pictures = spark.createDataFrame([(f"{p}/images/d_p001.png", png(drawing(i % 4))) for i, p in enumerate(papers)], "png string, content binary")
    figures = spark.createDataFrame([(p, f"{p}/drawio/d.drawio", 1, f"{p}/images/d_p001.png") for p in papers] + [("z", papers[0] + "/drawio/d.drawio", 9, "none.png")], "arxiv_id string, drawio_path string, page_number int, png string")
    known = spark.createDataFrame([(p, True) for p in papers], "arxiv_id string, is_cs boolean")
    index = stages.index_pages(figures, documents, pictures, known).cache()
    rows = {r.png: r for r in index.collect()}
    assert rows["none.png"].mapping_error == "page index 9 outside source page count 1" and not rows["none.png"].valid
    first = rows[papers[0] + "/images/d_p001.png"]
    assert (first.verts, first.edges, first.elements, first.texts, first.valid) == (2, 1, 3, 1, True)

    unique, clusters = dedup.unique_pages(index)
    assert unique.count() == 4 and {(r.size, r.exact_variants) for r in clusters.collect()} == {(2, 1)}
    policy = quality.Policy(10, 10, 10, 1e6, 20, 4.0, min_elements=1, min_vertices=1, min_pixels=1)
    chosen, rejects = quality.coarse_selection(quality.scored(unique, quality.recorded_or(policy, unique)), 0.6)
    assert chosen.count() == 2 and {tuple(r.structural_reject_reasons) for r in rejects.collect()} == {("below_structure_cutoff",)}
    scores = stages.model_scores(chosen.join(pictures, "png"), lambda views, prompts: [[1.0, 2.0, 0.5] for _ in views], "dual", ("a", "b"), ("c",))
    selected, vetoed = stages.finalized(chosen, scores, threshold=0.5)
    assert selected.count() == 2 and vetoed.count() == 0 and sorted(r.final_rank for r in selected.collect()) == [1, 2]
    assert quality.bundles(selected, 0.0, expected=2).count() == 2
    with pytest.raises(ValueError):
        stages.finalized(chosen, scores.limit(0))

    files = [(p, f, c) for i, p in enumerate(papers) for f, c in ((f"drawio/d.drawio", doc(i)), ("images/d_p001.png", png(drawing(i))), ("paper.md", b"text"))] + [("bad", "images/e_p001.png", b"zz")]
    files = spark.createDataFrame(files, "arxiv_id string, path string, content binary")
    checked = {r.arxiv_id: (r.errors, r.warnings) for r in stages.validated(files).collect()}
    assert checked[papers[0]] == ([], []) and len(checked["bad"][0]) == 3
    out, excluded = stages.export(files, spark.createDataFrame([("bad", "failed")], "arxiv_id string, status string"), skip_incomplete=True)
    sharded = stages.shards(out, 6000).withColumn("name", F.concat_ws("/", "arxiv_id", "path"))
    report = sinks.write_shards(sharded.select("shard", "arxiv_id", "name", "content"), str(tmp_path / "tar")).cache()
    assert report.count() > 1 and excluded.count() == 1
    members = sinks.archive_members(spark, str(tmp_path / "tar"))
    assert stages.check_archives(report, members).count() == 0
    assert {r.problem for r in stages.check_archives(report.withColumn("sha256", F.lit("x")), members).collect()} == {"checksum"}


def test_packages_and_recovery(spark):
    import gzip
    import tarfile

    def package(files):
        out = io.BytesIO()
        with tarfile.open(fileobj=out, mode="w:gz") as t:
            for name, body in files.items():
                info = tarfile.TarInfo(name)
                info.size = len(body)
                t.addfile(info, io.BytesIO(body))
        return out.getvalue()

    rows = [
        ("2401.00001.gz", package({"a.drawio": b"<mxfile/>", "z.drawio": b"<mxfile>", "b.svg": b"x mxgraph y", "../up.svg": b"mxfile", "c.txt": b"mxfile"})),
        ("2401.00002.gz", package({"a.tex": b"\\documentclass"})),
        ("2401.00003.gz", b"broken"),
        ("2401.00004.gz", gzip.compress(b"%PDF mxfile")),
    ]
    df = spark.createDataFrame(rows, "path string, content binary")
    got = {r.arxiv_id: (r.reasons, r.matched) for r in stages.collect(df, "2401").collect()}
    assert got == {
        "2401.00001": (["direct_drawio_xml", "embedded_marker_svg"], True), "2401.00002": ([], False),
        "2401.00003": (["invalid_source_package"], False), "2401.00004": (["single_payload_drawio_marker"], True),
    }
    files = tables.inner_files(df)
    found = stages.candidates(files).cache()
    assert {(r.package, r.name, r.recovery) for r in found.collect()} >= {("2401.00001.gz", "source_0001", "direct"), ("2401.00001.gz", "source_0002", "embedded_drawio_xml")}
    extracted = spark.createDataFrame([("2401.00001.gz", "source_0002", b"<mxfile/>")], "package string, name string, xml binary")
    diagrams = stages.recovered(found, extracted)
    states = stages.recovery_states(df.select(F.col("path").alias("package")), found, diagrams, files.filter("not readable"))
    assert {(r.package[:10], r.status, r.drawio_files) for r in states.collect()} == {("2401.00001", "accepted", 1), ("2401.00002", "rejected", 0), ("2401.00003", "failed", 0), ("2401.00004", "rejected", 0)}


def test_render(spark):
    docs = spark.createDataFrame([("p", "d", f"<mxfile><diagram>{CELLS}</diagram></mxfile>".encode()), ("q", "e", b"<a")], "arxiv_id string, drawio_path string, content binary")
    tasks = stages.render_tasks(docs).cache()
    good = stages.rendered(tasks, lambda items, seconds: {k: b"x" * 200 for k, _, _ in items})
    assert {(r.arxiv_id, r.status) for r in stages.render_states(tasks, good).collect()} == {("p", "complete"), ("q", "failed")}
    bad = stages.rendered(tasks, lambda items, seconds: 1 / 0)
    assert {r.status for r in stages.render_states(tasks, bad).collect()} == {"failed"}


def test_stream_goes_on(spark, tmp_path):
    rows = lambda n: spark.createDataFrame([(i % 3, i) for i in range(n)], "k long, at long")
    rows(6).coalesce(1).write.parquet(str(tmp_path / "in"))
    run = lambda: {(r.k, r.at) for r in latest_by_stream(spark, str(tmp_path / "in"), "k", ["at"], str(tmp_path / "out")).collect()}
    assert run() == {(0, 3), (1, 4), (2, 5)} and run() == {(0, 3), (1, 4), (2, 5)}
    rows(8).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert run() == {(0, 6), (1, 7), (2, 5)}


def test_runner_resumes(spark, tmp_path):
    ran = []
    p = Pipeline(str(tmp_path))

    @p.stage("one")
    def one(spark, done):
        """First."""
        ran.append("one")
        return done["in"].filter("id > 2")

    @p.stage("two")
    def two(spark, done):
        ran.append("two")
        return done["one"].selectExpr("sum(id) as s")

    assert len(p.plan()) == 2 and "First." in p.plan()[0]
    for _ in range(2):
        assert p.run(spark, {"in": spark.range(5)})["two"].first().s == 7
    assert ran == ["one", "two"]

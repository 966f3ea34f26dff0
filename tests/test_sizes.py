"""Queries on tables with larger keys, and work that is dealt to all cores."""

import io
import re
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomwright import session
from loomwright.functions import images, scalars
from loomwright.operators import states
from loomwright.plans import catalogue, releases
from loomwright.sources import archives, processes, services
from tests.test_operators import drawing, png


def test_papers_of_large_keys_are_folders(spark, tmp_path):
    spark.range(99_990, 100_020).select(F.col("id").alias("c_custkey")).write.parquet(str(tmp_path / "customer.parquet"))
    got = [r.arxiv_id for r in catalogue.QUERIES["paper_folders"](spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(f"2401.{k:05d}" for k in range(99_990, 100_020) if k % 3 == 0)


def test_programs_are_dealt_to_all_cores(spark):
    rows = spark.range(40).select("id", F.lit(b"").alias("content")).coalesce(1)
    ended = processes.run_programs(rows, "id", "content", ["/bin/true"]).withColumn("task", F.spark_partition_id())
    assert ended.select("task").distinct().count() > 4 and ended.filter("returncode = 0").count() == 40


def test_small_archives_share_partitions(spark, tmp_path):
    for i in range(300):
        with tarfile.open(tmp_path / f"a_{i:03d}.tar", "w") as t:
            info = tarfile.TarInfo(f"2401/2401.{i:05d}.gz")
            info.size = 1
            t.addfile(info, io.BytesIO(b"x"))
    found = archives.read_packages(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() <= 40 and found.select("package", "member").distinct().count() == 300


def test_answers_of_a_task_are_one_file(spark, tmp_path):
    """The journal has a file for a task, not for an answer; a line that was cut is asked for again."""
    ids = spark.range(3000).select(F.col("id").cast("string").alias("arxiv_id"))
    services.fetched(ids, lambda name: (200, {}, b"x"), refuse=None, journal=f"file://{tmp_path}/store/journal").count()
    files = [f for f in (tmp_path / "store" / "journal").iterdir() if f.suffix == ".json"]
    assert len(files) <= 40
    (tmp_path / "store" / "journal" / "cut.json").write_text('{"arxiv_id": "3000", "content": "eA==", "attempts": 1, "error": nu')
    store = services.Fetched(spark, f"file://{tmp_path}/store")
    asked = spark.sparkContext.accumulator(0)

    def fetch(name):
        asked.add(1)
        return 200, {}, b"y"

    more = spark.range(3002).select(F.col("id").cast("string").alias("arxiv_id"))
    got = {r.arxiv_id: bytes(r.content) for r in store.fetch(more, fetch, refuse=None).collect()}
    assert asked.value == 2 and len(got) == 3002 and got["3000"] == got["3001"] == b"y" and got["7"] == b"x"


def test_small_tables_are_dealt_to_all_cores(spark, sf):
    for name in ("render_run", "xml_pages_strict", "model_views"):
        rows = catalogue.QUERIES[name](spark, sf)
        assert "REPARTITION_BY_NUM" in rows._jdf.queryExecution().executedPlan().toString(), name


def test_names_are_made_of_what_they_hold(spark):
    texts = ["", "__..", "a", "..a..", "a b__", "é a.b_-é", "x" * 200, "-._-", "a" + "." * 50 + "b", "a" + "._ " * 50, "\n a\n\nb\n", "a😀b", "_" * 5000 + "q", None]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", scalars.slug(F.col("t"), 24).alias("s")).collect()

    def plain(t):
        c = re.sub(r"^[._]+|[._]+$", "", re.sub(r"[^A-Za-z0-9._-]+", "_", t))
        return (c or "diagram")[:24]

    assert {r.i: r.s for r in got} == {i: None if t is None else plain(t) for i, t in enumerate(texts)}


def test_a_bundle_is_worked_out_once(spark):
    """The check for conflicts and the result read one table, which is grouped once."""
    rows = [(f"p{i}", f"a/{i}.drawio", f"{i}.png", 1) for i in range(9)] * 2
    out = releases.bundle_files(spark.createDataFrame(rows, "arxiv_id string, source_drawio string, png string, page_number int"))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, out.collect())) == sorted([(f"p{i}", f"drawio/{i}.drawio", f"a/{i}.drawio") for i in range(9)] + [(f"p{i}", f"images/{i}_p001.png", f"{i}.png") for i in range(9)])


def test_files_meet_their_figures_in_one_shuffle(spark):
    figures = [("d/1", "i/1", 1), ("d/2", "i/2", 2)]
    statuses = spark.createDataFrame([(p, s, 2, 2, figures) for p, s in (("a", "complete"), ("b", "failed"), ("c", "complete"))], "arxiv_id string, status string, drawio_files int, png_images int, figures array<struct<drawio_path: string, image_path: string, page_number: int>>")
    files = spark.createDataFrame([(p, f, 500) for p in "ab" for f in ("d/1", "d/2", "i/1", "i/2", "drawio_raw/1.drawio", "drawio_raw/2.drawio")] + [("c", f, 500 if f != "i/2" else None) for f in ("d/1", "d/2", "i/1", "i/2")], "arxiv_id string, path string, size long")
    out = states.valid_sources(spark.createDataFrame([("a", 2), ("b", 2), ("c", 2), ("d", 0)], "arxiv_id string, drawio_files int"), statuses, files)
    assert {r.arxiv_id: (r.ready, r.partial_ready) for r in out.collect()} == {"a": (True, True), "b": (False, True), "c": (False, False), "d": (False, False)}
    assert "hashpartitioning(arxiv_id#" in (plan := out._jdf.queryExecution().executedPlan().toString()) and ", path#" not in "".join(x for x in plan.splitlines() if "hashpartitioning" in x)


def test_tasks_of_a_summary_grow_with_its_tables(spark, sf, monkeypatch):
    """A task groups a fixed number of rows, not all that fit into the bytes of a stored partition; figures and files are numbered once, before."""
    monkeypatch.setattr(session, "TASK_ROWS", 1000)
    plan = catalogue.QUERIES["render_summary"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert max(int(n) for n in re.findall(r"hashpartitioning\(arxiv_id#\d+L?, (\d+)\), REPARTITION_BY_NUM", plan)) > 15
    assert "Window" not in plan and plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin") == 3


def test_summaries_count_repeated_rows_and_states(spark):
    """As a join of complete rows with states has it: every row with every state of its paper."""
    rows = spark.createDataFrame([("a", True), ("a", True), ("a", False), ("b", True), ("c", False), ("d", None), (None, True)], "arxiv_id string, complete boolean")
    statuses = spark.createDataFrame([("a", 1, 10), ("a", 2, None), ("b", None, 5), ("c", 100, 100), ("d", 100, 100), (None, 100, 100)], "arxiv_id string, drawio_files long, png_images long")
    assert states.render_summary(rows, statuses).collect() == [(7, 4, 2, 6, 25, False)]
    assert states.render_summary(rows.filter("arxiv_id is null"), statuses).collect() == [(1, 1, 0, 0, 0, True)]


def test_sizes_of_views_need_no_drawing(monkeypatch):
    long = np.full((90, 1500), 255)
    long[20:40, 100:1400] = 7
    pictures = [png(x) for x in (drawing(1), long, long.T, np.full((30, 50), 255), np.zeros((3, 1)))]
    drawn = {m: [[list(v.shape[1::-1]) for v in images.views(p, m)] for p in pictures] for m in images.VIEW_MODES}
    for name in ("letterboxed", "resize"):
        monkeypatch.setattr(images, name, lambda *a: pytest.fail("drawn"))
    for m in images.VIEW_MODES:
        assert [images.view_sizes(p, m) for p in pictures] == [{"sizes": s, "error": ""} for s in drawn[m]]
    assert images.view_sizes(b"x")["sizes"] == [] and images.view_sizes(b"x")["error"]

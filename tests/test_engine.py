"""Parts that the queries do not show: claims, budgets, waits, ordered sums, covers and the command line."""

import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomwright import cli
from loomwright.functions import latex, xml_pages
from loomwright.operators import dedup, folds, ordered, states
from loomwright.plans.leases import CLAIM_SECONDS, Fenced, Leases, create_once
from loomwright.plans import jobs, releases, stages
from loomwright.sources import services, sinks, tables


def plain_next_fit(weights, cap, held):
    out, number = [], 0
    for w in weights:
        if held is not None and held + w > cap:
            number, held = number + 1, 0
        held = (held or 0) + w
        out.append(number)
    return out, held


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=60), st.integers(10, 50), st.one_of(st.none(), st.integers(1, 70)))
def test_next_fit_and_transitions(weights, cap, held):
    w = np.array(weights, float)
    want, last = plain_next_fit(weights, cap, held)
    bins, got = folds.next_fit(w, cap, held)
    assert bins.tolist() == want and (not weights or got == last)
    t = folds.transitions(w, cap)
    assert len(t["room"]) <= cap + 1 and t["total"] == sum(weights)
    if weights and held is not None:
        k = int(np.searchsorted(np.array(t["room"]), cap - held, "right"))
        if k >= len(t["room"]) and held + t["total"] <= cap:
            assert want[-1] == 0
        else:
            k = min(k, len(t["count"]) - 1)
            assert (t["count"][k], t["held"][k]) == (want[-1], last)


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 12), st.sets(st.tuples(st.integers(0, 11), st.integers(0, 11)), max_size=40))
def test_cover_is_greedy(n, pairs):
    pairs = {(a, b) for a, b in pairs if a < n and b < n}
    linked = lambda a, b: (a, b) in pairs or (b, a) in pairs
    want, groups = [], []
    for k in range(n):
        fit = [i for i, g in enumerate(groups) if all(linked(k, x) for x in g)]
        if fit:
            groups[fit[0]].append(k)
        else:
            groups.append([k])
        want.append(fit[0] if fit else len(groups) - 1)
    left, right = (np.array([p[i] for p in pairs], np.int64) for i in (0, 1))
    assert dedup.cover(np.arange(n), left, right).tolist() == want


def test_numbers_sums_and_percentiles(spark):
    rows = [(i, (i * 37) % 101, None if i % 9 == 0 else float((i * 7) % 50)) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, v long, x double").repartition(5)
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    assert {r.k: r.at for r in ordered.numbered(df, ["v", "k"], "at").collect()} == {r[0]: i + 1 for i, r in enumerate(order)}
    before = dict(zip([r[0] for r in order], itertools.accumulate([0] + [r[1] for r in order])))
    assert {r.k: r.s for r in ordered.running_sum(df, ["v", "k"], F.col("v"), "s").collect()} == before
    got = {(r.field, r.point): r.value for r in ordered.percentiles(df, {"v": [0, 12.5, 50, 99.8, 100], "x": [5, 50]}).collect()}
    x = [r[2] for r in rows if r[2] is not None]
    assert got == pytest.approx({("v", p): np.percentile([r[1] for r in rows], p) for p in (0, 12.5, 50, 99.8, 100)} | {("x", p): np.percentile(x, p) for p in (5, 50)})
    assert ordered.percentiles(df.limit(0), {"v": [50]}).count() == 0 and ordered.numbered(df.limit(0), ["k"], "at").count() == 0


def test_brackets_give_exact_percentiles(spark):
    rng = np.random.default_rng(9)
    rows = [(float(a), float(b), float(c)) for a, b, c in zip(rng.lognormal(0, 8, 6000), rng.integers(0, 40, 6000), np.where(rng.random(6000) < 0.01, 1e300, rng.normal(size=6000)))]
    rows += [(float("inf"), 1.0, -1e308), (0.0, -5.0, 1e308), (-0.0, 7.0, 5e-324)]
    df, points = spark.createDataFrame(rows, "a double, b double, c double"), [0, 1, 5, 33.3, 50, 90, 99.9, 100]
    few = {(r.field, r.point): r.value for r in ordered.percentiles(df, dict.fromkeys("abc", points)).collect()}
    many = {(r.field, r.point): r.value for r in ordered.percentiles(df, dict.fromkeys("abc", points), at_once=100, narrow=20).collect()}
    assert many == few
    for i, name in enumerate("abc"):
        ranked = sorted(r[i] for r in rows)
        for p in points:
            at = p / 100 * (len(ranked) - 1)
            low, high, share = ranked[int(at)], ranked[min(int(at) + 1, len(ranked) - 1)], at - int(at)
            assert few[name, p] == (low if share == 0 or low == high else (1 - share) * low + share * high)


def test_hot_bands_lose_no_pair(spark):
    rng = np.random.default_rng(1)
    codes = [int(sum(1 << int(b) for b in rng.choice(62, 3, replace=False))) for _ in range(120)]  # all share most bands
    df = spark.createDataFrame(list(enumerate(codes)), "k long, c long")
    want = {(i, j) for i in range(120) for j in range(i + 1, 120) if bin(codes[i] ^ codes[j]).count("1") <= 4}
    for hot in (2, 1000):
        got = [(r.left_k, r.right_k) for r in dedup.hamming_pairs(df, "k", "c", 4, hot=hot).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_many_leases_are_made_in_tasks(spark, tmp_path):
    """The driver asked Spark's file system some times for each key, and all records of all keys were read to tell what is completed."""
    now, keys = [1000.0], [f"a/{i}.tar" for i in range(150)]
    a, b = (Leases(spark, f"file://{tmp_path}/leases", n, now=lambda: now[0]) for n in "ab")
    assert a.acquire_all(keys) == [1] * 150 and b.acquire_all(keys) == [None] * 150
    a.release_all([(keys[0], 1)])
    now[0] += CLAIM_SECONDS + 1
    assert b.acquire_all(keys[:100]) == [3] + [2] * 99  # the others ran out
    assert a.complete_all((k, 1, {"n": 1}) for k in keys) == [False] * 100 + [True] * 50
    assert b.complete_all((k, 2 + (k == keys[0]), {"n": 2}) for k in keys[:99]) == [True] * 99
    done = b.completed("n long")
    assert sorted((r.key, r.n) for r in done.collect()) == sorted([(k, 2) for k in keys[:99]] + [(k, 1) for k in keys[100:]])
    assert done.rdd.getNumPartitions() == 64 and not done.inputFiles()
    assert a.acquire_all(keys[:99] + keys[100:]) == [None] * 149
    # A task that is tried again finds the lease that its first try made.
    again = [b.records.acquire("new", 1.0, 10.0, "asked") for _ in range(2)]
    assert again == [1, 1] and b.records.acquire("new", 1.0, 10.0, "other") is None


def test_leases_and_budget(spark, tmp_path):
    now = [1000.0]
    a, b = (Leases(spark, f"file://{tmp_path}/leases", n, now=lambda: now[0]) for n in "ab")
    held = a.acquire("x/k.tar")
    assert held and not b.acquire("x/k.tar") and b.acquire("y/k.tar") and b.acquire("other")
    held = a.renew("x/k.tar", held)
    now[0] += CLAIM_SECONDS + 1
    taken = b.acquire("x/k.tar")
    assert taken == held + 1 and not a.acquire("x/k.tar")
    for late in (lambda: a.renew("x/k.tar", held), lambda: a.complete("x/k.tar", held, {"n": 1})):
        with pytest.raises(Fenced):  # a paused owner neither goes on nor completes
            late()
    a.release("x/k.tar", held)
    assert not a.acquire("x/k.tar")
    b.release("x/k.tar", taken)
    again = a.acquire("x/k.tar")
    a.complete("x/k.tar", again, {"n": 2})
    now[0] += CLAIM_SECONDS + 1
    assert not b.acquire("x/k.tar")
    assert [tuple(r) for r in b.completed("n long").collect()] == [("x/k.tar", 2)]
    path = f"file://{tmp_path}/state"
    assert jobs.within_budget(spark, path, 1, lambda: 0.0) and jobs.within_budget(spark, path, 1, lambda: 3599.0) and not jobs.within_budget(spark, path, 1, lambda: 3600.0)


def test_many_make_one_file(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(16) as pool:
        made = list(pool.map(lambda i: create_once(spark, f"file://{tmp_path}/f/one.json", str(i)), range(64)))
    assert sum(made) == 1 and (tmp_path / "f" / "one.json").read_text() == str(made.index(True))
    assert len(list((tmp_path / "f").glob("*"))) <= 2  # the file, and Spark's checksum of it if any


def test_waits_and_refusals():
    assert services.wait_before(1, 429, {"retry-after": "12"}, 2) == 12 and services.wait_before(1, 429, {"Retry-After": "soon"}, 2) == services.BUSY_WAIT
    assert [services.wait_before(k, 500, {}, 2.0) for k in (1, 2, 3, 9)] == [2, 4, 8, 60]
    assert services.refusal(b"x" * 999) and services.refusal(b"<HTML>" + b"x" * 2000) and not services.refusal(b"x" * 1000)
    waited, answers = [], iter([(429, {"Retry-After": "3"}, b""), (200, {}, b"y" * 5), (200, {}, b"y" * 2000)])
    assert services.asked("n", lambda n: next(answers), 3, 1.0, services.refusal, False, waited.append) == (b"y" * 2000, 3, None) and waited == [3.0, 2.0]

    def broken(n):
        raise OSError("down")

    assert services.asked("n", broken, 2, 1.0, None, True, waited.append)[1:] == (1, "OSError: down")


def test_refusals_of_operators(spark):
    for a, b in (("/a", "/a/"), ("/a/b", "/a"), ("/a", "/a/b/c")):
        with pytest.raises(ValueError):
            releases.require_outside(a, b)
    releases.require_outside("/a", "/ab")
    papers = spark.createDataFrame([("p",), ("q",)], "arxiv_id string")
    known = spark.createDataFrame([("p", ["cs.AI"])], "arxiv_id string, categories array<string>")
    with pytest.raises(ValueError, match="q"):
        states.with_categories(papers, known, known)
    assert states.with_categories(papers, known, known, only=None).filter("is_cs").count() == 2
    with pytest.raises(ValueError):
        tables.paper_folders(spark.createDataFrame([("x/y",)], "path string"))
    shown = spark.createDataFrame([("2401.00001/images/a_p001.png", b"x")], "path string, content binary")
    with pytest.raises(ValueError):
        stages.read_dataset(shown)
    assert stages.read_dataset(shown, strict=False).first().drawio is None
    twice = spark.createDataFrame([("p", "a/x.drawio", "i.png", 1), ("p", "b/x.drawio", "j.png", 2)], "arxiv_id string, source_drawio string, png string, page_number int")
    with pytest.raises(ValueError, match="conflicting"):
        releases.bundle_files(twice)


def test_archives_are_resumed_or_refused(spark, tmp_path):
    files = spark.createDataFrame([(i % 2, f"2401.{i:05d}", f"2401.{i:05d}/paper.md", b"x" * i) for i in range(6)], "shard long, arxiv_id string, name string, content binary")
    folder = str(tmp_path / "tar")
    first = {r.filename: r.sha256 for r in sinks.write_shards(files, folder).collect()}
    with pytest.raises(FileExistsError):
        sinks.write_shards(files, folder)
    (tmp_path / "tar" / "papers-00001.tar").unlink()
    assert {r.filename: r.sha256 for r in sinks.write_shards(files, folder, resume=True).collect()} == first
    with pytest.raises(Exception, match="membership differs"):
        sinks.write_shards(files.withColumn("content", F.lit(b"other")), folder, resume=True).collect()
    with pytest.raises(ValueError):
        sinks.write_shards(files, folder, prefix="a/b")
    for write in (lambda: sinks.write_shards(files, folder, source=f"file://{tmp_path}"), lambda: sinks.write_files(files, folder, source=folder), lambda: releases.write_bundles(files, f"{folder}/b", source=folder)):
        with pytest.raises(ValueError, match="separate"):
            write()


def test_latex_odd_inputs():
    assert latex.markdown("\\a{" * 10 + "deep" + "}" * 10) == "{{deep}}"
    assert latex.markdown(r"\textbf{x {y} z} \label{a{b}} } {") == "{x {y} z} {a{b}} } {"
    assert latex.markdown(r"\section{A \textbf{b}} \emph {c} \itemsep 50\% of % gone") == "A b {c} \n- sep 50% of".replace(" \n", " \n")
    assert latex.markdown("") == "" and len(latex.markdown("\\textbf{" * 50_000)) >= 0 and latex.markdown("%x\n" * 20_000) == ""
    loop = {"a.tex": r"A\input{b}", "b.tex": r"B\input{a}"}
    assert latex.expanded("a.tex", loop) == "AB" and latex.expanded("none.tex", loop) == ""


def test_negative_sizes():
    assert xml_pages.bounding_box('<a><mxGeometry x="0" width="-50"/><mxGeometry x="5" width="-1"/><mxGeometry x="900" width="inf"/></a>') == {"width": 25.0, "height": 20.0}
    assert xml_pages.bounding_box('<a><mxGraphModel pageWidth="3"/></a>') == {"width": 1000.0, "height": 800.0}


def test_command_line(capsys):
    assert cli.main(["queries"]) == 0 and "exact_dedup_argmax" in capsys.readouterr().out
    assert cli.main(["scan", "a", "b", "--from-month", "2401", "--to-month", "2401", "--limit", "0"]) == jobs.EXIT_FAILED
    with pytest.raises(SystemExit):
        cli.main(["nothing"])

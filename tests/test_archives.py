"""Archives as streams, their index, and scans that lose nothing."""

import gzip
import io
import tarfile
import threading

import pytest

from loomwright.plans import jobs
from loomwright.plans.leases import Leases
from loomwright.sources import archives


def tar(files, mode="w"):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode) as t:
        for name, body in files:
            info = tarfile.TarInfo(name)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))
    return out.getvalue()


def papers(k, n=3):
    return [(f"2401/2401.{k}{i:04d}.gz", gzip.compress(b"<mxfile/>" if i % 2 else b"plain", mtime=0)) for i in range(n)]


def sparse(path, hole, files):
    """An archive with a member of ``hole`` zero bytes, which take no room on disk, before the others."""
    with open(path, "wb") as f:
        info = tarfile.TarInfo("2401/large.pdf")
        info.size = hole
        f.write(info.tobuf(tarfile.GNU_FORMAT))
        f.seek((hole + 511) // 512 * 512, 1)
        f.write(tar(files))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("archives")
    whole = tar(papers(7))
    (path / "good.tar").write_bytes(whole)
    (path / "packed.tar").write_bytes(gzip.compress(tar(papers(8))))
    (path / "empty.tar").write_bytes(tar([]))
    (path / "cut.tar").write_bytes(whole[:1740])
    (path / "between.tar").write_bytes(whole[:1024])
    (path / "garbage.tar").write_bytes(b"x" * 3000)
    (path / "nothing.tar").write_bytes(b"")
    (path / "skipped.txt").write_bytes(b"x")
    sparse(path / "sparse.tar", 3 << 30, papers(9))
    return path


def test_streams_end_with_an_error_or_whole(spark, folder):
    rows = archives.read_packages(spark, f"file://{folder}").selectExpr("regexp_extract(package, '[^/]*$', 0) as a", "member", "length(content) > 0 as some", "error is not null as broken").collect()
    by = {}
    for r in rows:
        by.setdefault(r.a, []).append((r.member, r.some, r.broken))
    assert set(by) == {"good.tar", "packed.tar", "cut.tar", "between.tar", "garbage.tar", "nothing.tar", "sparse.tar"}
    for name, k in (("good.tar", 7), ("packed.tar", 8), ("sparse.tar", 9)):
        assert by[name] == [(n, True, False) for n, _ in papers(k)]
    assert by["between.tar"] == [(papers(7)[0][0], True, False), (None, None, True)]
    assert by["cut.tar"][-1] == (None, None, True) and by["garbage.tar"] == by["nothing.tar"] == [(None, None, True)]
    assert archives.read_packages(spark, f"file://{folder}", mostBytes=10, pattern="good.tar").filter("error is not null").count() == 3


def test_a_large_archive_takes_little_memory(folder):
    import resource

    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert [n for n, _, _ in archives.walk(f"file://{folder}/sparse.tar")] == [n for n, _ in papers(9)]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 200_000  # KB, of 3 GiB


def test_index_reads_members_by_range(spark, folder):
    paths = spark.createDataFrame([(f"file://{folder}/{n}.tar",) for n in ("good", "empty", "cut", "between", "garbage", "nothing", "sparse")], "path string")
    rows = archives.index(paths).selectExpr("regexp_extract(archive, '[^/]*$', 0) as a", "*").collect()
    ends = {r.a: r.error for r in rows if r.member is None}
    assert {a for a, e in ends.items() if e is None} == {"good.tar", "empty.tar", "sparse.tar"} and len(ends) == 7
    at = {(r.a, r.member): (r.offset, r.size) for r in rows if r.member}
    assert at["sparse.tar", "2401/large.pdf"] == (512, 3 << 30)
    some = archives.spread(archives.index(paths.filter("path rlike 'good|sparse'")).filter("member like '%.gz'"), 1 << 20)
    got = {r.member: bytes(r.content) for r in archives.member_contents(some).collect()}
    assert got == dict(papers(7) + papers(9))
    import hashlib

    sums = {r.member: r.sha256 for r in archives.member_digests(some).collect()}
    assert sums == {n: hashlib.sha256(c).hexdigest() for n, c in papers(7) + papers(9)}


def listing(spark, folder, names):
    return spark.createDataFrame([(f"a_2401_{i}.tar", "2401", 1, f"file://{folder}/{n}.tar") for i, n in enumerate(names)], "key string, month string, size long, path string")


def test_broken_archives_are_not_completed(spark, folder, tmp_path):
    state, tries = f"file://{tmp_path}/state", []
    objects = listing(spark, folder, ["good", "cut", "garbage", "empty"])
    with pytest.raises(jobs.ScanFailed, match="2 archives failed after 3"):
        jobs.scan(spark, objects, state, "2401", "2401", sleep=tries.append)
    assert tries == [2, 4]
    done = {r.source_key: (r.papers_seen, r.matches) for r in jobs.completions(spark, state).collect()}
    assert done == {"a_2401_0.tar": (3, 1), "a_2401_3.tar": (0, 0)}
    assert not (tmp_path / "state" / "ALL_DONE.json").exists()
    assert [r.arxiv_id for r in jobs.selected_sources(spark, state).collect()] == ["2401.70001"]
    mended = listing(spark, folder, ["good", "packed", "sparse", "empty"])
    assert jobs.scan(spark, mended, state, "2401", "2401")["completed_seen"] == 4
    assert jobs.selected_sources(spark, state).count() == 3 and (tmp_path / "state" / "ALL_DONE.json").exists()


def test_two_scans_share_archives(spark, folder, tmp_path):
    state, objects = f"file://{tmp_path}/state", listing(spark, folder, ["good", "packed"] * 3)
    ends = []
    both = [threading.Thread(target=lambda n=n: ends.append(jobs.scan(spark, objects, state, "2401", "2401", owner=n, sleep=lambda s: threading.Event().wait(0.2)))) for n in "ab"]
    [t.start() for t in both], [t.join(120) for t in both]
    assert [e["completed_seen"] for e in ends] == [6, 6]
    assert jobs.completions(spark, state).count() == 6
    # Each archive was read by one of them.
    assert spark.read.parquet(f"{state}/manifests").select("source_key", "run").distinct().count() == 6


def test_a_paused_owner_cannot_complete(spark, folder, tmp_path):
    """While one run waits to try a broken archive again, its lease runs out, and another run completes the archive."""
    state, now = f"file://{tmp_path}/state", [0.0]

    def pause(seconds):
        now[0] += 10_000
        other = listing(spark, folder, ["good"])
        jobs.scan(spark, other, state, "2401", "2401", owner="b", now=lambda: now[0])
        import shutil

        shutil.copy(folder / "good.tar", tmp_path / "late.tar")

    (tmp_path / "late.tar").write_bytes(b"broken")
    objects = spark.createDataFrame([("a_2401_0.tar", "2401", 1, f"file://{tmp_path}/late.tar")], "key string, month string, size long, path string")
    jobs.scan(spark, objects, state, "2401", "2401", owner="a", now=lambda: now[0], sleep=pause)
    done = jobs.completions(spark, state).collect()
    owners = {r.owner for r in spark.read.json(f"{state}/leases/*/*.json").filter("kind = 'done'").collect()}
    assert len(done) == 1 and owners == {"b"}
    assert jobs.selected_sources(spark, state).count() == 1
    assert Leases(spark, f"{state}/leases").acquire("a_2401_0.tar") is None


def test_a_scan_ends_with_its_budget(spark, folder, tmp_path):
    state, objects, left = f"file://{tmp_path}/state", listing(spark, folder, ["good", "packed"]), [True, False]
    jobs.ROUND, old = 1, jobs.ROUND
    try:
        with pytest.raises(jobs.BudgetUsed):
            jobs.scan(spark, objects, state, "2401", "2401", go_on=lambda: left.pop(0))
    finally:
        jobs.ROUND = old
    assert jobs.completions(spark, state).count() == 1  # what was done stays done
    assert jobs.scan(spark, objects, state, "2401", "2401")["completed_seen"] == 2


def test_many_small_archives_are_few_rounds(spark, folder, tmp_path):
    """Rounds, tasks and folders of leases do not grow with the number of archives, only with their bytes."""
    state, objects = f"file://{tmp_path}/state", listing(spark, folder, ["good"] * 150)
    assert jobs.scan(spark, objects, state, "2401", "2401")["completed_seen"] == 150
    assert len(list((tmp_path / "state" / "manifests").glob("run=*"))) == 1
    assert len(list((tmp_path / "state" / "leases").iterdir())) <= 64

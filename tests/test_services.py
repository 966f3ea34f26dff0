"""External programs, fetches that last, pictures that are looked through, and events that come late."""

import http.client
import os
import struct
import subprocess
import sys
import time
import zlib

import pytest
from pyspark.sql import functions as F

from loomwright.functions import png_stream
from loomwright.plans import stages
from loomwright.sources import processes, services
from loomwright.streaming.incremental import hourly_by_stream


def python(code):
    return [sys.executable, "-c", code]


HANGS = "import time, signal; signal.signal(signal.SIGTERM, signal.SIG_IGN); time.sleep(600)"
FORKS = "import os, time\nfor i in range(3):\n  if os.fork() == 0:\n    os.setsid(); os.fork(); time.sleep(601)\nprint('done')"
CRASHES = "import os, sys; sys.stderr.write('bad'); sys.stderr.flush(); os.abort()"
ECHOES = "import sys; sys.stdout.write(sys.stdin.read().upper())"


def sleepers():
    out = []
    for p in os.listdir("/proc"):
        if p.isdigit():
            try:
                with open(f"/proc/{p}/cmdline", "rb") as f:
                    line = f.read()
                if b"sleep(60" in line and b"pytest" not in line:
                    out.append(p)
            except OSError:
                pass
    return out


@pytest.mark.parametrize("code, code_is, timed_out, output", [(HANGS, -9, True, b""), (FORKS, 0, False, b"done\n"), (CRASHES, -6, False, b""), (ECHOES, 0, False, b"ABC")])
def test_programs_end_as_rows(spark, code, code_is, timed_out, output):
    rows = spark.createDataFrame([(i, b"abc") for i in range(2)], "k long, content binary").coalesce(1)
    got = processes.run_programs(rows, "k", "content", python(code), seconds=1.5 if timed_out else 30, grace=0.5).collect()
    assert [(r.k, r.returncode, r.timed_out, bytes(r.output), r.error) for r in got] == [(k, code_is, timed_out, output, None) for k in range(2)]
    assert ("bad" in got[0].messages) == (code is CRASHES)
    assert not sleepers()


LOOKS = """
import sys
from loomwright.sources import processes
looks, parents = [], processes._parents
processes._parents = lambda: looks.append(1) or parents()
ends = [processes.supervised(["bash", "-c", "cat; sleep 602 & exit 3"], b"abc") for _ in range(5)]
assert {(e.returncode, e.output) for e in ends} == {(3, b"abc")} and not processes._has_children()
assert len(looks) < 5, looks
# What has left the group is found all the same.
e = processes.supervised([sys.executable, "-c", sys.argv[1]], grace=0.5)
assert (e.returncode, e.output) == (0, b"done\\n") and looks and not processes._has_children()
"""


def test_helpers_in_the_group_need_no_look_at_all_processes():
    """A look at every process of the machine, three times for each program, cost more than the program; run apart, since this process may have children."""
    ended = subprocess.run([sys.executable, "-c", LOOKS, FORKS], capture_output=True, text=True, timeout=60)
    assert ended.returncode == 0, ended.stderr
    assert not sleepers()


def test_outputs_of_programs_travel_together(spark):
    """One batch for each program; a large output has one of its own."""
    rows = spark.createDataFrame([(i, b"a" * (5 << 20 if i == 3 else i)) for i in range(8)], "k long, content binary").coalesce(1)
    got = processes.run_programs(rows, "k", "content", ["cat"]).select("k", F.length("output").alias("n"), "returncode").collect()
    assert {(r.k, r.n, r.returncode) for r in got} == {(i, 5 << 20 if i == 3 else i, 0) for i in range(8)}


def test_programs_that_are_not_there(spark):
    got = processes.run_programs(spark.createDataFrame([(1, None)], "k long, content binary"), "k", "content", ["/no/such/program"]).first()
    assert got.returncode is None and "FileNotFoundError" in got.error
    with pytest.raises(TimeoutError):
        processes.converter(python(HANGS), 0.5)("x") if processes.GRACE < 1 else _short(HANGS)
    assert processes.converter(python(ECHOES), 30)("straße")[1] == "STRASSE"
    assert processes.converter(["/no/such/program"], 1)("x")[0] == 127


def _short(code):
    before, processes.GRACE = processes.GRACE, 0.3
    try:
        return processes.converter(python("import time; time.sleep(600)"), 0.5)("x")
    finally:
        processes.GRACE = before


RENDERS = """
import base64, json, sys, time
for line in sys.stdin:
    r = json.loads(line)
    if r["body"] == "hang": time.sleep(600)
    if r["body"] == "crash": sys.exit(3)
    print(json.dumps({"key": r["key"], "image": base64.b64encode(r["body"].encode() * 300).decode()}), flush=True)
print('{"key": "x", "ima')
"""


def test_pages_are_rendered_by_a_program(monkeypatch):
    monkeypatch.setattr(processes, "GRACE", 0.3)
    monkeypatch.setattr(stages, "CALL_SECONDS", 1.0)
    monkeypatch.setattr(stages, "FILE_SECONDS", 0.2)
    items = [(f"k{i}", b, 2.0) for i, b in enumerate(["one", "two", "crash", "three", "hang", "four"])]
    got = stages.render_all(items, processes.renderer(python(RENDERS)))
    assert {k: bool(image) for k, (image, _) in got.items()} == {f"k{i}": i not in (2, 4) for i in range(6)}
    assert got["k2"][1] and got["k4"][1] and not sleepers()
    assert all(e and "FileNotFoundError" in e for _, e in stages.render_all(items[:2], processes.renderer(["/no/such/program"])).values())


def noted(folder, kill=None):
    """A service that notes each question; at one name the first worker dies."""

    def fetch(name):
        if name == kill and not os.path.exists(f"{folder}/killed"):
            open(f"{folder}/killed", "w").close()
            os._exit(1)
        with open(f"{folder}/asked", "a") as f:
            f.write(f"{name} {time.time()}\n")
        if name.endswith("3"):
            raise http.client.IncompleteRead(b"x")
        if name.endswith("4"):
            raise KeyError(name)
        return 200, {}, (name * 1000).encode()

    return fetch


def test_any_exception_is_a_row(spark, tmp_path):
    ids = spark.createDataFrame([(f"p{i}",) for i in range(6)], "arxiv_id string")
    got = {r.arxiv_id: r.error for r in services.fetched(ids, noted(tmp_path), retries=1).collect()}
    assert "IncompleteRead" in got["p3"] and "KeyError" in got["p4"] and sum(v is None for v in got.values()) == 4


def test_a_killed_job_asks_for_nothing_twice(spark, tmp_path):
    ids = spark.createDataFrame([(f"p{i:03d}",) for i in range(40)], "arxiv_id string").coalesce(2)
    store = services.Fetched(spark, f"file://{tmp_path}/store")
    how = {"batch": 15, "retries": 1}
    with pytest.raises(Exception, match="(?i)worker|exit|crash|EOF"):
        store.fetch(ids, noted(tmp_path, kill="p021"), **how).collect()
    there = services.Fetched(spark, f"file://{tmp_path}/store")
    rows = {r.arxiv_id: r for r in there.fetch(ids, noted(tmp_path, kill="p021"), **how).collect()}
    assert len(rows) == 40 and bytes(rows["p000"].content) == b"p000" * 1000 and rows["p003"].content is None
    asked = [line.split()[0] for line in open(tmp_path / "asked")]
    assert sorted(asked) == sorted(rows)
    there.fetch(ids, noted(tmp_path), **how).count()
    assert len(open(tmp_path / "asked").readlines()) == 40
    there.fetch(ids, noted(tmp_path), again=True, **how).count()  # only what failed is asked once more
    assert sorted(line.split()[0] for line in open(tmp_path / "asked").readlines()[40:]) == sorted(k for k in rows if k[-1] in "34")
    assert not (tmp_path / "store" / "journal").exists()


def test_the_rate_holds_over_all_tasks(spark, tmp_path):
    ids = spark.createDataFrame([(f"q{i}0",) for i in range(60)], "arxiv_id string").repartition(7)
    began = time.time()
    assert services.fetched(ids, noted(tmp_path), retries=1, rate=20, slots=4).count() == 60
    at = sorted(float(line.split()[1]) for line in open(tmp_path / "asked"))
    for i, t in enumerate(at):
        assert sum(t <= u < t + 1 for u in at[i:]) <= 20 + 4 + 1  # one of each slot may fall on the border
    assert time.time() - began > 60 / 20 - 1


def test_feeds_that_fail_cost_only_their_papers(spark, tmp_path):
    def feed(ids):
        with open(f"{tmp_path}/asked", "a") as f:
            f.write(",".join(ids) + "\n")
        n = len(open(f"{tmp_path}/asked").readlines())
        if n == 1:
            raise http.client.IncompleteRead(b"")
        if "p05" in ids:
            return b"<feed"  # broken to the end
        return ("<feed xmlns='http://www.w3.org/2005/Atom'>" + "".join(f"<entry><id>http://x/abs/{i}v1</id><title>T</title><category term='cs.AI'/></entry>" for i in ids) + "</feed>").encode()

    papers = spark.createDataFrame([(f"p{i:02d}",) for i in range(9)], "arxiv_id string").coalesce(1)
    none = spark.createDataFrame([], "arxiv_id string, categories array<string>, title string")
    waits = str(tmp_path / "waits")
    got = services.categories(papers, none, feed, batch=1, retries=2, sleep=lambda s: open(waits, "a").write(f"{s}\n")).collect()
    assert {r.arxiv_id for r in got} == {f"p{i:02d}" for i in range(9)} - {"p05"}
    assert len(open(f"{tmp_path}/asked").readlines()) == 9 + 2 and len(open(waits).readlines()) == 2
    again = services.categories(papers, spark.createDataFrame(got), lambda ids: feed(["fine", *ids]) if ids != ["p05"] else b"<feed/>", batch=5, rate=50.0)
    assert again.count() == 8


def chunk(name, body, crc=None):
    return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body) if crc is None else crc)


def png(w=5, h=4, kind=0, depth=8, laced=0, lines=None, palette=b"", crc=None, end=True, packed=None):
    stride = list(png_stream.strides(w, h, png_stream.CHANNELS[kind] * depth, laced))
    raw = b"".join((b"\x04" + b"x" * (s - 1)) * n for n, s in stride) if lines is None else lines
    packed = zlib.compress(raw) if packed is None else packed
    half = len(packed) // 2
    out = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, depth, kind, 0, 0, laced)) + palette
    return out + chunk(b"IDAT", packed[:half]) + chunk(b"IDAT", packed[half:], crc) + (chunk(b"IEND", b"") if end else b"")


def test_pictures_are_looked_through():
    for kind, depths in png_stream.DEPTHS.items():
        for depth in depths:
            for laced in (0, 1):
                assert png_stream.problem(png(7, 9, kind, depth, laced, palette=chunk(b"PLTE", b"abc") if kind == 3 else b"")) == (None, None)
    wrong = {
        "wrong checksum": png(crc=1), "image data ends early": png(lines=b"\x00abcde" * 3 + b"\x00abcd"), "no such filter": png(lines=b"\x05abcde" * 4), "no end": png(end=False), "no palette": png(kind=3),
        "not a PNG": b"GIF89a", "a chunk is cut": png(end=False)[:-3], "incorrect": png(packed=b"not packed at all"), "empty dimensions": png(0, 4, lines=b""), "unknown kind": png(kind=2, depth=8).replace(b"\x08\x02\x00", b"\x04\x02\x00", 1),
    }
    for text, data in wrong.items():
        error, warning = png_stream.problem(data)
        assert warning is None and (text in error or text == "unknown kind" and "checksum" in error), (text, error)
    assert png_stream.problem(None)[0] == "not a PNG"
    # A picture of 400 million pixels: checksums only, and hardly any memory.
    large = png(20_000, 20_000, lines=b"", packed=b"")
    assert png_stream.problem(large) == (None, "pixels are not decoded above 16000000")
    assert "wrong checksum" in png_stream.problem(png(20_000, 20_000, lines=b"", packed=zlib.compress(b"x"), crc=5))[0]
    import tracemalloc

    bomb = png(16_000, 1_000, lines=(b"\x00" + bytes(16_000)) * 1_000)
    tracemalloc.start()
    assert png_stream.problem(bomb) == (None, None)
    assert tracemalloc.get_traced_memory()[1] < 1_000_000  # of 16 MB
    tracemalloc.stop()


def test_validation_of_papers(spark):
    good, xml = png(), "<mxfile><diagram/></mxfile>"
    paper = lambda name, image=good, drawio=xml.encode(), text=b"text", link=False: [(name, "paper.md", text, link), (name, "drawio/d.drawio", drawio, False), (name, "images/d_p001.png", image, False)]
    rows = paper("good") + paper("crc", png(crc=3)) + paper("short", png(lines=b"\x00abcde")) + paper("large", png(20_000, 20_000, lines=b"", packed=b"")) + paper("link", link=True)
    rows += paper("wide", drawio=("<?xml version='1.0' encoding='UTF-16'?>" + xml).encode("utf-16")) + paper("bad", drawio=b"\xff<mxfile>")
    got = {r.arxiv_id: (r.errors, r.warnings) for r in stages.validated(spark.createDataFrame(rows, "arxiv_id string, path string, content binary, link boolean")).collect()}
    image = "images/d_p001.png"
    assert got == {
        "good": ([], []), "wide": ([], []), "crc": ([f"broken PNG: {image}: wrong checksum: IDAT"], []), "short": ([f"broken PNG: {image}: image data ends early"], []),
        "large": ([], [f"{image}: pixels are not decoded above 16000000"]), "link": (["symbolic links"], []), "bad": (["not a diagram: d"], [f"page beyond document: {image}"]),
    }


def test_command_line_validates_and_packs(spark, tmp_path, capsys):
    import json

    from loomwright import cli
    from loomwright.plans import jobs

    for k in range(5):
        paper = tmp_path / "set" / f"2401.{k:05d}"
        for kind, name, data in (("drawio", "d.drawio", b"<mxfile><diagram/></mxfile>"), ("images", "d_p001.png", png())):
            (paper / kind).mkdir(parents=True)
            (paper / kind / name).write_bytes(data)
        (paper / "paper.md").write_text("text")
    said = lambda: json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert cli.main(["pack", str(tmp_path / "set"), str(tmp_path / "set" / "out")]) == jobs.EXIT_FAILED  # inside of the dataset
    assert cli.main(["pack", str(tmp_path / "set"), str(tmp_path / "out"), "--shard-bytes", "7000"]) == jobs.EXIT_DONE
    first = said()
    assert first["archives"] == 3 and first["papers"] == 5 and first["problems"] == []
    assert cli.main(["pack", str(tmp_path / "set"), str(tmp_path / "out"), "--shard-bytes", "7000"]) == jobs.EXIT_FAILED  # not empty
    assert cli.main(["pack", str(tmp_path / "set"), str(tmp_path / "out"), "--shard-bytes", "7000", "--resume"]) == jobs.EXIT_DONE
    os.symlink(tmp_path / "set" / "2401.00000" / "paper.md", tmp_path / "linked.md")
    (tmp_path / "set" / "2401.00001" / "paper.md").unlink()
    os.symlink(tmp_path / "linked.md", tmp_path / "set" / "2401.00001" / "paper.md")
    (tmp_path / "set" / "2401.00002" / "images" / "d_p001.png").write_bytes(png(crc=7))
    capsys.readouterr()
    assert cli.main(["validate", str(tmp_path / "set")]) == jobs.EXIT_FAILED
    assert said()["problems"] == {"2401.00001": ["symbolic links"], "2401.00002": ["broken PNG: images/d_p001.png: wrong checksum: IDAT"]}
    assert cli.main(["validate", str(tmp_path / "set"), "--allow-links"]) == jobs.EXIT_FAILED and set(said()["problems"]) == {"2401.00002"}


def test_late_events_are_left_out_and_counted(spark, tmp_path):
    files = [[(1, "a", "2024-01-01 10:05:00", 1.0), (2, "a", "2024-01-02 12:00:00", 2.0)], [(4, None, "2024-01-02 11:59:00", 8.0)], [(3, "a", "2024-01-01 10:30:00", 4.0), (5, "a", "2024-01-02 12:30:00", 16.0), (6, "b", None, 1.0)]]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, "event_id long, event_type string, ts string, value double").coalesce(1).write.mode("append").parquet(f"{tmp_path}/events")
        time.sleep(1.1)  # files are taken by their times
    for late, lost in (("30 days", 0), ("2 hours", 1)):
        hours, n = hourly_by_stream(spark, f"{tmp_path}/events", f"file://{tmp_path}/{lost}", late, files_per_batch=1)
        got = {(r.hour_start % 86400 // 3600, r.event_type): (r.n, r.total) for r in hours.collect()}
        assert n == lost and got == {(10, "a"): (2 - lost, 5.0 - 4 * lost), (12, "a"): (2, 18.0), (11, None): (1, 8.0)}
    again, n = hourly_by_stream(spark, f"{tmp_path}/events", f"file://{tmp_path}/1", "2 hours", files_per_batch=1)
    assert n == 1 and again.count() == 3

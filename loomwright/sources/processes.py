"""External programs inside workers: with a deadline, without leftovers, and never the end of a task.

A program gets its input and gives its output through files in memory, so a helper that it
leaves behind cannot keep anyone waiting at a pipe.  It runs in a session of its own; when it
ends, or its time is over, all that it started is ended with it, also what left the session:
the worker adopts orphans, so descendants can be told by their parents.  Parents are looked up,
which takes a look at every process of the machine, only where the end of the program's group leaves some.
"""

from __future__ import annotations

import base64
import ctypes
import json
import os
import select
import signal
import subprocess
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from loomwright.session import dealt

#: Seconds that a program has to end by itself once it is asked to, and bytes of its messages that are kept.
GRACE, KEPT = 10.0, 4000
#: Seconds in which helpers that stayed in the group are gone as a rule; rows, and bytes of output, in one batch.
SOON, ROWS, ROWS_BYTES = 0.03, 256, 4 << 20
RESULT = "returncode int, timed_out boolean, output binary, messages string, error string"
_ADOPT = 36  # PR_SET_CHILD_SUBREAPER


@dataclass(frozen=True)
class Ended:
    returncode: int | None
    timed_out: bool
    output: bytes
    messages: str
    error: str | None = None


def _parents() -> dict[int, int]:
    out = {}
    for name in os.listdir("/proc"):
        if name.isdigit():
            try:
                with open(f"/proc/{name}/stat", encoding="ascii", errors="replace") as f:
                    out[int(name)] = int(f.read().rpartition(")")[2].split()[1])
            except (OSError, ValueError, IndexError):
                pass  # gone meanwhile
    return out


def children(pid: int) -> set[int]:
    return {p for p, of in _parents().items() if of == pid}


def started(before: set[int]) -> set[int]:
    """Children of this process that were not there before, and all that descend from them."""
    parents, me = _parents(), os.getpid()
    found = more = {p for p, of in parents.items() if of == me and p not in before}
    while more:
        more = {p for p, of in parents.items() if of in more} - found
        found = found | more
    return found


def _has_children() -> bool:
    """Whether this process has any child, running or not; nothing is reaped."""
    try:
        os.waitid(os.P_ALL, 0, os.WEXITED | os.WNOHANG | os.WNOWAIT)
        return True
    except ChildProcessError:
        return False


def _ends(program: subprocess.Popen, seconds: float) -> bool:
    """Whether a program ends in time; it is not reaped, so its number, which is its group's, stays its own."""
    try:
        at = os.pidfd_open(program.pid)
    except OSError:  # an older kernel
        until = time.monotonic() + seconds
        while not (gone := os.waitid(os.P_PID, program.pid, os.WEXITED | os.WNOHANG | os.WNOWAIT)) and time.monotonic() < until:
            time.sleep(0.005)
        return bool(gone)
    try:
        end = select.poll()
        end.register(at, select.POLLIN)
        return bool(end.poll(seconds * 1000))
    finally:
        os.close(at)


def _end_group(program: subprocess.Popen) -> None:
    """Ask what is left of the group of a program that has ended to end, and reap what does so soon; this process had no other children."""
    try:
        os.killpg(program.pid, signal.SIGTERM)
    except (ProcessLookupError, PermissionError):
        pass
    program.wait()
    until, pause = time.monotonic() + SOON, 0.0005
    try:
        while True:
            if not os.waitpid(-1, os.WNOHANG)[0]:
                if time.monotonic() > until:
                    break  # it takes its time, or has left the group
                time.sleep(pause)
                pause *= 2
    except ChildProcessError:
        pass  # none is left


def _signal(pids: set[int], number: int) -> None:
    for p in pids:
        try:
            os.kill(p, number)
        except ProcessLookupError:
            pass


def _reap(pids: set[int]) -> None:
    for p in pids:
        try:
            os.waitpid(p, os.WNOHANG)
        except ChildProcessError:
            pass


def _end(program: subprocess.Popen, mine: Callable[[], set[int]], grace: float) -> None:
    """End all of a set of processes, asked first, and wait until none is left."""
    left, until, number = mine(), time.monotonic() + grace, signal.SIGTERM
    while left:
        _signal(left, number)
        time.sleep(0.02)
        program.poll()
        _reap(left - {program.pid})
        if time.monotonic() > until:
            number = signal.SIGKILL
        left = mine()


def supervised(command: list[str], data: bytes = b"", seconds: float = 60.0, grace: float = GRACE) -> Ended:
    """Run a program on some bytes; whatever happens is told by what is returned."""
    ctypes.CDLL(None).prctl(_ADOPT, 1, 0, 0, 0)
    before = children(os.getpid()) if _has_children() else set()
    files = [os.memfd_create(n) for n in ("input", "output", "messages")]
    try:
        with os.fdopen(os.dup(files[0]), "wb") as f:
            f.write(data)
        os.lseek(files[0], 0, os.SEEK_SET)
        try:
            program = subprocess.Popen(command, stdin=files[0], stdout=files[1], stderr=files[2], start_new_session=True, cwd="/")
        except OSError as e:
            return Ended(None, False, b"", "", f"{type(e).__name__}: {e}"[:300])
        timed_out = not _ends(program, seconds)
        if not timed_out and not before:
            _end_group(program)

        def mine() -> set[int]:
            """What this worker had not started before is the program's."""
            ended = {program.pid} if program.poll() is not None else set()
            return started(before) - ended if _has_children() else set()

        _end(program, mine, grace)
        code = program.wait()
        output, messages = (os.pread(f, os.fstat(f).st_size, 0) for f in files[1:])
        return Ended(code, timed_out, output, messages.decode("utf-8", "replace")[-KEPT:])
    finally:
        for f in files:
            os.close(f)


def profile(df: DataFrame, cpus: int):
    """A resource profile by which an executor runs fewer tasks of a stage at once; none where all runs in one process."""
    if cpus < 2 or df.sparkSession.sparkContext.master.startswith("local"):
        return None
    from pyspark.resource import ResourceProfileBuilder, TaskResourceRequests

    return ResourceProfileBuilder().require(TaskResourceRequests().cpus(cpus)).build


def run_programs(rows: DataFrame, key: str, content: str, command: list[str], seconds: float = 60.0, cpus: int = 1, grace: float = GRACE) -> DataFrame:
    """(key, RESULT): one run of a program for each row, whose content is its input.

    Rows are dealt to all cores.  One program runs in a task at a time; ``cpus`` bounds how many run on an executor.
    """
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[Ended] = []
            first = 0

            def told() -> pa.RecordBatch:
                columns = zip(*((e.returncode, e.timed_out, e.output, e.messages, e.error) for e in held))
                values = [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.bool_(), pa.binary(), pa.string(), pa.string()))]
                return pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(held)), *values], [key, "returncode", "timed_out", "output", "messages", "error"])  # noqa: B023

            for data in batch.column(1):
                e = supervised(command, data.as_py() or b"", seconds, grace)
                if held and (len(held) == ROWS or sum(len(h.output) for h in held) + len(e.output) > ROWS_BYTES):
                    yield told()
                    first += len(held)
                    held.clear()
                held.append(e)
            if held:
                yield told()

    return dealt(rows.select(key, content), key).mapInArrow(run, f"`{key}` {kind}, {RESULT}", profile=profile(rows, cpus))


def converter(command: list[str], seconds: float) -> Callable[[str], tuple[int, str, str]]:
    """A converter of texts that is a program: its exit code, text and warnings; a program that is not there has failed."""

    def convert(source: str) -> tuple[int, str, str]:
        e = supervised(command, source.encode(), seconds)
        if e.timed_out:
            raise TimeoutError(seconds)
        return (127, "", e.error) if e.error else (e.returncode, e.output.decode("utf-8", "replace"), e.messages)

    return convert


def renderer(command: list[str]) -> Callable[[list[tuple[str, str, float]], float], dict[str, bytes]]:
    """A renderer of pages that is a program: it reads lines of JSON (key, body, scale) and writes lines (key, image in base64).

    Whatever it has written when its time is over counts; lines that are not whole do not.
    """

    def render(items: list[tuple[str, str, float]], seconds: float) -> dict[str, bytes]:
        lines = "".join(json.dumps({"key": k, "body": b, "scale": s}) + "\n" for k, b, s in items)
        e = supervised(command, lines.encode(), seconds)
        if e.error:
            raise OSError(e.error)
        out = {}
        for line in e.output.splitlines():
            try:
                row = json.loads(line)
                out[row["key"]] = base64.b64decode(row["image"], validate=True)
            except (ValueError, KeyError, TypeError):
                pass
        return out

    return render

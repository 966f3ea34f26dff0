"""Whether a picture is whole: checksums of its chunks, and its lines as they are inflated.

Lines come out of the packed data one after another and are dropped again, so a picture
takes the memory of one line.  A filter is looked at, not undone: undoing cannot fail.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Pixels above which only checksums are tested; channels of a kind of picture and its depths.
MOST_PIXELS = 16_000_000
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
DEPTHS = {0: (1, 2, 4, 8, 16), 2: (8, 16), 3: (1, 2, 4, 8), 4: (8, 16), 6: (8, 16)}
#: Passes of an interlaced picture: first row, first column, steps between rows and columns.
PASSES = ((0, 0, 8, 8), (0, 4, 8, 8), (4, 0, 8, 4), (0, 2, 4, 4), (2, 0, 4, 2), (0, 1, 2, 2), (1, 0, 2, 1))
INFLATED = 1 << 16


class Broken(ValueError):
    pass


def chunks(data: memoryview) -> Iterator[tuple[bytes, memoryview]]:
    """(name, body) of a picture's chunks up to its end, each with the right checksum."""
    if bytes(data[:8]) != b"\x89PNG\r\n\x1a\n":
        raise Broken("not a PNG")
    at = 8
    while True:
        if at + 12 > len(data):
            raise Broken("no end")
        size, name = struct.unpack(">I4s", data[at : at + 8])
        if at + 12 + size > len(data):
            raise Broken(f"a chunk is cut: {name.decode('latin-1')}")
        body = data[at + 8 : at + 8 + size]
        if zlib.crc32(body, zlib.crc32(name)) != struct.unpack(">I", data[at + 8 + size : at + 12 + size])[0]:
            raise Broken(f"wrong checksum: {name.decode('latin-1')}")
        yield name, body
        if name == b"IEND":
            return
        at += 12 + size


def strides(width: int, height: int, bits: int, laced: int) -> Iterator[tuple[int, int]]:
    """(lines, bytes of each with its filter) of every pass."""
    for y, x, dy, dx in PASSES if laced else ((0, 0, 1, 1),):
        rows, columns = len(range(y, height, dy)), len(range(x, width, dx))
        if rows and columns:
            yield rows, 1 + (columns * bits + 7) // 8


class Lines:
    """Counts off lines as inflated bytes come in."""

    def __init__(self, passes: Iterator[tuple[int, int]]):
        self.passes = passes
        self.lines, self.stride, self.inside = 0, 0, 0  # left in this pass; bytes of a line; seen of this line
        self.whole = self._next()

    def _next(self) -> bool:
        self.lines, self.stride = next(self.passes, (0, 0))
        return not self.lines

    def take(self, data: bytes) -> None:
        at = 0
        while at < len(data) and not self.whole:
            if not self.inside and data[at] > 4:
                raise Broken(f"no such filter: {data[at]}")
            some = min(len(data) - at, self.stride - self.inside)
            at, self.inside = at + some, self.inside + some
            if self.inside == self.stride:
                self.inside, self.lines = 0, self.lines - 1
                if not self.lines:
                    self.whole = self._next()


def problem(content: bytes | None, most: int = MOST_PIXELS) -> tuple[str | None, str | None]:
    """(error, warning) of a picture."""
    lines, inflate, palette, kind, seen = None, zlib.decompressobj(), False, None, False
    try:
        for name, body in chunks(memoryview(content or b"")):
            if name == b"IHDR":
                if len(body) != 13:
                    raise Broken("no header")
                width, height, depth, kind, packing, filters, laced = struct.unpack(">IIBBBBB", body)
                if not width or not height:
                    raise Broken("empty dimensions")
                if depth not in DEPTHS.get(kind, ()) or packing or filters or laced > 1:
                    raise Broken("unknown kind of picture")
                if width * height <= most:
                    lines = Lines(strides(width, height, CHANNELS[kind] * depth, laced))
            elif kind is None:
                raise Broken("no header")
            elif name == b"PLTE":
                palette = True
            elif name == b"IDAT":
                seen = True
                while lines and not lines.whole and body:
                    lines.take(inflate.decompress(body, INFLATED))
                    body = inflate.unconsumed_tail
        if kind == 3 and not palette:
            raise Broken("no palette")
        if lines is None and seen:
            return None, f"pixels are not decoded above {most}"
        if lines is None or not lines.whole:
            raise Broken("image data ends early")
    except (Broken, zlib.error) as e:
        return str(e)[:200], None
    return None, None


def _problems(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for s in batches:
        yield pd.DataFrame([problem(x) for x in s], columns=["error", "warning"])


def png_problem(content: Column | str) -> Column:
    """error and warning of a picture, both null where it is right."""
    return F.pandas_udf(_problems, "struct<error: string, warning: string>")(content)

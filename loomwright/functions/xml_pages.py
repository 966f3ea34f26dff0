"""Logical pages of diagram documents, from Arrow batches.

Two readings exist.  The lenient one keeps every page, blank ones too, and makes one page
of a document that it cannot parse.  The strict one reports an error instead and leaves
out pages without elements; pages keep their places in the document either way.
"""

from __future__ import annotations

import base64
import re
import urllib.parse
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

PAGES = "array<struct<page_number: int, page_name: string, body: string>>"
STRICT = f"struct<pages: {PAGES}, error: string>"
SIZE = "struct<width: double, height: double>"
OUTLINE = "struct<root: string, pages: int>"
#: The size of a page that names none, and what is added around a drawing.
DEFAULT_SIZE, MARGIN = (1000.0, 800.0), 20.0
_CELL = re.compile(r'(?:vertex|edge)="1"')


def read_text(content: bytes | str | None) -> str:
    """Text of a document, which may be compressed as a whole."""
    if content is None:
        return ""
    if isinstance(content, str):
        return content
    if content[:2] == b"\x1f\x8b":
        try:
            content = zlib.decompress(content, 31)
        except zlib.error:
            return ""
    return content.decode("utf-8", "replace")


def inflate(body: str) -> str:
    """The markup of a compressed page, empty if it is none."""
    try:
        raw = zlib.decompress(base64.b64decode(body, validate=False), -15)
    except (ValueError, zlib.error):
        return ""
    return urllib.parse.unquote(raw.decode("utf-8", "replace"))


def _local(tag: object) -> str:
    return str(tag).rpartition("}")[2]


def _body(diagram: ElementTree.Element) -> str:
    inner = "".join(ElementTree.tostring(c, encoding="unicode") for c in diagram)
    inner = inner or (diagram.text or "").strip()
    return inner if "mxGraphModel" in inner else inflate(inner) or inner


def _diagrams(root: ElementTree.Element) -> list[ElementTree.Element]:
    return [root] if _local(root.tag) == "diagram" else [c for c in root if _local(c.tag) == "diagram"]


def lenient(source: str) -> list[dict]:
    try:
        found = _diagrams(ElementTree.fromstring(source))
    except ElementTree.ParseError:
        found = []
    if not found:
        return [{"page_number": 1, "page_name": "Page-1", "body": source}]
    return [{"page_number": i, "page_name": d.get("name") or f"Page-{i}", "body": _body(d)} for i, d in enumerate(found, 1)]


def strict(source: str) -> dict:
    try:
        root = ElementTree.fromstring(source)
    except ElementTree.ParseError as e:
        return {"pages": [], "error": f"ParseError: {e}"[:300]}
    if _local(root.tag) == "mxGraphModel":
        return {"pages": [{"page_number": 1, "page_name": "Page-1", "body": source}], "error": None}
    pages = [{"page_number": i, "page_name": d.get("name") or f"Page-{i}", "body": _body(d)} for i, d in enumerate(_diagrams(root), 1)]
    pages = [p for p in pages if _CELL.search(p["body"])]
    return {"pages": pages, "error": None if pages else "no pages"}


def _numbers(element: ElementTree.Element, names: tuple[str, ...], defaults: tuple[float, ...]) -> list[float] | None:
    """Attributes as numbers, null if one is none."""
    try:
        return [float(element.get(n) or d) for n, d in zip(names, defaults)]
    except ValueError:
        return None


def bounding_box(body: str) -> dict:
    """Size of the drawing with a margin, from its geometry; without any, the size that the root element names."""
    try:
        root = ElementTree.fromstring(body)
    except ElementTree.ParseError:
        return dict(zip(("width", "height"), DEFAULT_SIZE))
    found = [_numbers(g, ("x", "y", "width", "height"), (0.0,) * 4) for g in root.iter() if _local(g.tag) == "mxGeometry"]
    corners = np.array([x for x in found if x]).reshape(-1, 2, 2)
    corners = corners[np.isfinite(corners).all(axis=(1, 2))]
    if not len(corners):
        return dict(zip(("width", "height"), _numbers(root, ("pageWidth", "pageHeight"), DEFAULT_SIZE) or DEFAULT_SIZE))
    low, size = corners[:, 0], np.maximum(corners[:, 1], 0.0)
    span = np.maximum((low + size).max(axis=0) - low.min(axis=0) + MARGIN, 1.0)
    return dict(zip(("width", "height"), span.tolist()))


def outline(content: bytes | None) -> dict:
    """The root element of a document, null if it is not well-formed, and the number of its pages, empty ones included."""
    try:
        root = ElementTree.fromstring(bytes(content or b""))  # in whatever encoding it says
    except (ElementTree.ParseError, LookupError, ValueError):
        return {"root": None, "pages": 0}
    return {"root": str(root.tag), "pages": len(root.findall("diagram")) if root.tag == "mxfile" else 1}


def _lenient_pages(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in batches:
        yield s.map(lambda x: lenient(read_text(x)))


def _strict_pages(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for s in batches:
        yield pd.DataFrame([strict(read_text(x)) for x in s], columns=["pages", "error"])


def _page_size(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for s in batches:
        yield pd.DataFrame([bounding_box(x or "") for x in s], columns=["width", "height"])


def _outline(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for s in batches:
        yield pd.DataFrame([outline(x) for x in s], columns=["root", "pages"])


def single_page(source: str, number: int) -> str:
    """One page of a document as a document of its own."""
    root = ElementTree.fromstring(source)
    if _local(root.tag) == "mxGraphModel":
        return source
    found = _diagrams(root)
    if not 1 <= number <= len(found):
        raise IndexError(f"page {number} of {len(found)}")
    out = ElementTree.Element("mxfile")
    out.append(found[number - 1])
    return ElementTree.tostring(out, encoding="unicode")


# Made when called: parsing a type needs a session.


def lenient_pages(source: Column | str) -> Column:
    return F.pandas_udf(_lenient_pages, PAGES)(source)


def strict_pages(source: Column | str) -> Column:
    return F.pandas_udf(_strict_pages, STRICT)(source)


def page_size(body: Column | str) -> Column:
    return F.pandas_udf(_page_size, SIZE)(body)


def document_outline(content: Column | str) -> Column:
    return F.pandas_udf(_outline, OUTLINE)(content)

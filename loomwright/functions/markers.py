"""Detection of diagrams in packages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomwright.functions.xml_pages import document_outline

#: What marks a diagram source, and what marks one embedded in other files.
XML_TAGS = r"<mxfile\b|<mxGraphModel\b|<diagram\b"
MARKERS = ("mxfile", "mxGraphModel", "mxgraph", "diagrams.net", "/drawio")
EMBEDDED = ("svg", "png", "pdf")


def latin(content: Column) -> Column:
    """Bytes as characters of the same numbers, so that regular expressions see bytes."""
    return F.decode(content, "ISO-8859-1")


def has_marker(content: Column) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(content, F.lit(m).cast("binary")) for m in MARKERS])


def has_diagram_tag(content: Column) -> Column:
    return F.regexp_like(latin(content), F.lit(XML_TAGS))


def is_diagram_xml(content: Column) -> Column:
    """A diagram's tag in a well-formed document; what has no tag is not parsed."""
    return has_diagram_tag(content) & document_outline(F.when(has_diagram_tag(content), content))["root"].isNotNull()


def suffix(path: Column) -> Column:
    """Lower-case extension of the last path element, empty if there is none."""
    return F.lower(F.regexp_extract(path, r"[^/.][^/]*\.([^./]*)\z", 1))


def reason(path: Column, content: Column) -> Column:
    """Why a member of a package is a hit, or null."""
    kind = suffix(path)
    return F.when((kind == "drawio") & has_diagram_tag(content), "direct_drawio_xml").when(kind.isin(*EMBEDDED) & has_marker(content), F.concat(F.lit("embedded_marker_"), kind))


def guess_extension(content: Column) -> Column:
    """What a package of one nameless file holds."""
    head = F.lower(F.regexp_replace(latin(F.substring(content, 1, 4096)), r"^[\x09-\x0d ]+", ""))
    tex = F.contains(head, F.lit("\\documentclass")) | F.contains(head, F.lit("\\begin{document}"))
    return F.when(F.startswith(head, F.lit("%pdf")), ".pdf").when(tex, ".tex").otherwise(".src")

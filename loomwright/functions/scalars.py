"""Scalar functions as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What the page metrics look for.
VERTEX = r'vertex="1"'
EDGE = r'edge="1"'
IMAGE = r"(?i)shape=image|image=data:|image=http|data:image"
VALUE = r'value="([^"]+)"'
MARKUP = r"<[^>]+>"
#: Render scales, from the largest.
SCALES = (2.0, 1.5, 1.25, 1.0)
LONGEST_SIDE, MOST_PIXELS = 4096, 20_000_000


def count_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("int")


def strip_space(text: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def page_metrics(body: Column, vertex: str = VERTEX, edge: str = EDGE, image: str = IMAGE, value: str = VALUE) -> dict[str, Column]:
    """verts, edges, elements, boxes, images and texts of a page's markup."""
    verts, edges, images = count_of(body, vertex), count_of(body, edge), count_of(body, image)
    shown = F.filter(F.regexp_extract_all(body, F.lit(value), F.lit(1)), lambda v: strip_space(F.regexp_replace(v, MARKUP, "")) != "")
    return {"verts": verts, "edges": edges, "elements": verts + edges, "boxes": F.greatest(verts - images, F.lit(0)), "images": images, "texts": F.size(shown).cast("int")}


def aspect(width: Column, height: Column) -> Column:
    return F.round(F.greatest(width, height) / F.greatest(F.least(width, height), F.lit(1)), 6)


def adaptive_scale(width: Column, height: Column) -> Column:
    """The largest render scale at which a page stays within the limits, never below one."""
    most = F.least(F.lit(SCALES[0]), LONGEST_SIDE / F.greatest(width, height, F.lit(1.0)), F.sqrt(MOST_PIXELS / F.greatest(width * height, F.lit(1.0))))
    steps = [F.when(most + 1e-9 >= s, F.lit(s)) for s in SCALES[:-1]]
    return F.coalesce(*steps, F.lit(SCALES[-1]))


def level(value: Column, cap: Column) -> Column:
    """0 to 1 on a logarithmic scale that ends at the cap."""
    return F.log1p(F.least(F.greatest(value.cast("double"), F.lit(0.0)), cap)) / F.greatest(F.log1p(cap), F.lit(1e-9))


def hamming(left: Column, right: Column) -> Column:
    return F.bit_count(left.bitwiseXOR(right)).cast("int")


def hash_of_hex(text: Column) -> Column:
    """64 bits from 16 hexadecimal digits."""
    high, low = F.conv(F.substring(text, 1, 8), 16, 10).cast("long"), F.conv(F.substring(text, 9, 8), 16, 10).cast("long")
    return F.shiftleft(high, 32).bitwiseOR(low)


def hex_of_bits(bits: Column) -> Column:
    """16 hexadecimal digits from an array of 64 booleans, first bit highest."""
    value = F.aggregate(bits, F.lit(0).cast("long"), lambda acc, b: F.shiftleft(acc, 1).bitwiseOR(b.cast("int").cast("long")))
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def bits_above_median(values: Column) -> Column:
    """One bit for each of 64 values: above the median of all but the first; the first is never set."""
    # The outer lambda binds the median, so that it is found once and not for each value.
    bound = F.array(F.struct(values.alias("v"), F.element_at(F.array_sort(F.slice(values, 2, 63)), 32).alias("m")))
    return F.element_at(F.transform(bound, lambda s: F.transform(s["v"], lambda v, i: (v > s["m"]) & (i > 0))), 1)


def slug(text: Column, most: int = 100, empty: str = "diagram") -> Column:
    """A name that is safe for files."""
    # Only what a name can hold is read: from the first letter, digit or hyphen to as many of them as it is long.
    head = F.regexp_extract(text, rf"\A[^A-Za-z0-9-]*+((?:[^A-Za-z0-9-]*+[A-Za-z0-9-]){{1,{most}}})", 1)
    clean = F.regexp_replace(head, r"[^A-Za-z0-9._-]+", "_")
    return F.substring(F.when(clean == "", empty).otherwise(clean), 1, most)


def task_key(paper: Column, name: Column, page: Column) -> Column:
    digest = F.substring(F.sha1(F.concat_ws("/", paper, name, page.cast("string"))), 1, 12)
    return F.concat_ws("_", slug(paper, 20), digest)


def last_part(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def state_keys(month: Column, source_key: Column) -> dict[str, Column]:
    """Where a source archive's completion, manifest and claim are kept."""
    at = lambda folder, suffix: F.concat_ws("/", F.lit(folder), month, F.concat(last_part(source_key), F.lit(suffix)))
    return {"completion": at("state/completed", ".json"), "manifest": at("manifests", ".jsonl"), "claim": at("state/claims", ".json")}


def paper_paths(month: Column, paper: Column) -> dict[str, Column]:
    """Where a paper's state, source package and match are kept."""
    return {"state": F.concat(month, F.lit("/"), paper, F.lit(".json")), "source": F.concat(month, F.lit("/"), paper, F.lit(".gz")), "match": F.concat(F.lit("matches/"), month, F.lit("/"), paper, F.lit(".gz"))}


def ordinal_name(number: Column, name: Column) -> Column:
    """The name of a paper's n-th diagram."""
    stem = F.regexp_replace(last_part(name), r"(?<=.)\.[^.]*\z", "")
    return F.concat(F.format_string("%03d_", number), slug(stem), F.lit(".drawio"))


def lost_race(code: Column, status: Column) -> Column:
    """Whether a refused write means that another was faster."""
    return F.coalesce(code.isin("409", "412", "ConditionalRequestConflict", "PreconditionFailed"), F.lit(False)) | F.coalesce(status.isin(409, 412), F.lit(False))


def utc_now() -> Column:
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def sorted_json(*columns: str) -> Column:
    """An object with its keys in order; keys without a value are left out."""
    return F.to_json(F.struct(*sorted(columns)))


def title(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def without_version(identifier: Column) -> Column:
    return F.regexp_replace(identifier, r"v[0-9]+\z", "")


def log_mean_exp(values: Column) -> Column:
    """Logarithm of the mean of exponentials of an array, stable for large values."""
    most = F.array_max(values)
    total = F.aggregate(F.transform(values, lambda x: F.exp(x - most)), F.lit(0.0), lambda a, x: a + x)
    return most + F.log(total) - F.log(F.size(values))


def starts_category(categories: Column, prefix: str = "cs.") -> Column:
    """Whether any category, in an array or a white-space separated string, starts so; null is no."""
    return F.coalesce(F.exists(categories, lambda c: F.startswith(c, F.lit(prefix))), F.lit(False))


def reasons(*rules: tuple[str, Column]) -> Column:
    """Names of the rules that hold, in order."""
    return F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules]))


def all_empty(*messages: Column) -> Column:
    return reduce(lambda a, b: a & b, [F.coalesce(m, F.lit("")) == "" for m in messages])


def png_size(content: Column) -> tuple[Column, Column]:
    """Width and height from a PNG header, 0 where there is none."""
    magic = F.hex(F.substring(content, 1, 8)) == "89504E470D0A1A0A"
    number = lambda at: F.when(magic & (F.length(content) >= 24), F.conv(F.hex(F.substring(content, at, 4)), 16, 10).cast("int")).otherwise(0)
    return number(17), number(21)

"""Exact and near-duplicate removal of pages."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwright.functions.images import same_picture
from loomwright.functions.scalars import hamming, hash_of_hex
from loomwright.operators import ordered
from loomwright.session import settled

#: What two near-duplicate pages may differ by.
PHASH_BITS, DHASH_BITS, ASPECT_GAP, INK_GAP, GREY_GAP = 4, 6, 0.025, 0.025, 8.0
KEEP_KEY = ("elements", "texts", "pixels", "png_bytes", "is_main", "png")


def best_of_group(df: DataFrame, group: str, keep: Sequence[str], size: str = "copies") -> DataFrame:
    """The row of each group with the largest keep key, and the group's size; combines before its shuffle."""
    rest = F.struct(*[c for c in df.columns if c != group])
    return df.groupBy(group).agg(F.max_by(rest, F.struct(*keep)).alias("_row"), F.count("*").alias(size)).select(group, "_row.*", size)


def bands_of(code: Column, radius: int, bits: int = 64) -> list[Column]:
    """radius + 1 pieces of a code: codes within the radius share one at least."""
    n, out, low = radius + 1, [], 0
    for i in range(n):
        width = bits // n + (i < bits % n)
        out.append(F.shiftrightunsigned(code, low).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1).cast("long")))
        low += width
    return out


def hamming_pairs(df: DataFrame, key: str, code: str, radius: int, carry: Sequence[str] = (), hot: int = 2_000, new: str | None = None) -> DataFrame:
    """Pairs (left_*, right_*) of rows with left key < right key and codes within ``radius``.

    Rows meet on shared bands; of several shared bands only the first reports a pair, so no
    distinct is needed.  A band's value with more than ``hot`` rows is split: its pairs agree
    to within the radius outside of the band too, so they share a second band, and meet on
    both.  Rows of one code should be made one row first.  With ``new``, a column of booleans,
    one row of a pair at least is new.
    """
    n = radius + 1
    kept = list(dict.fromkeys([*carry, *([new] if new else [])]))
    rows = df.filter(F.col(code).isNotNull()).select(key, code, *kept)
    # Bound by a lambda, so that the code is not worked out again for each band.
    pieces = F.element_at(F.transform(F.array(F.col(code)), lambda c: F.array(*bands_of(c, radius))), 1)
    # Each band once: its rows are counted for the crowded values and read again for both sides.
    spread = settled(rows.select("*", F.posexplode(pieces).alias("_band", "_piece")), "bands")
    crowded = spread.groupBy("_band", "_piece").agg(F.count("*").alias("_n")).filter(F.col("_n") > hot).select("_band", "_piece", F.lit(True).alias("_hot"))
    # A value needs `hot` rows to be crowded, so there are few of them; none is the usual case.
    if not crowded.isEmpty():
        spread = spread.join(crowded, ["_band", "_piece"], "left")
        others = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.struct(i.alias("_second"), code_and(F.col(code), _masks(radius), F.col("_band") * n + i).alias("_other")))
        seconds = F.when(F.col("_hot"), others).otherwise(F.array(F.struct(F.lit(-1).alias("_second"), F.lit(0).cast("long").alias("_other"))))
        spread = spread.withColumn("_s", F.explode(seconds)).select(key, code, *kept, "_band", "_piece", "_s._second", "_s._other")
        place = ["_band", "_piece", "_second", "_other"]
    else:
        place = ["_band", "_piece"]
    left, right = (spread.select(*place, *[F.col(c).alias(f"{side}_{c}") for c in (key, code, *kept)]) for side in ("left", "right"))
    met = F.col(f"left_{key}") < F.col(f"right_{key}")
    if new:
        met &= F.col(f"left_{new}") | F.col(f"right_{new}")
    differ = F.col(f"left_{code}").bitwiseXOR(F.col(f"right_{code}"))
    pairs = left.join(right, place).filter(met).withColumn("distance", F.bit_count(differ)).filter(F.col("distance") <= radius)
    # Few are left: of the bands, or second bands, that such a pair shares only the first reports it.
    shared = F.array_position(F.transform(F.array(differ), lambda x: F.array(*bands_of(x, radius)))[0], F.lit(0).cast("long")) - 1
    first = F.col("_band") == shared
    if "_second" in place:
        others = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: code_and(differ, _masks(radius), F.col("_band") * n + i))
        first &= (F.col("_second") < 0) | (F.col("_second") == F.array_position(others, F.lit(0).cast("long")) - 1)
    gone = {*place, *(() if new is None or new in carry else (f"left_{new}", f"right_{new}"))}
    return pairs.filter(first).drop(*gone)


def code_and(code: Column, masks: list[int], which: Column) -> Column:
    """The bits of a code that one of some masks lets through."""
    return code.bitwiseAND(F.get(F.array(*[F.lit(m).cast("long") for m in masks]), which))


def _masks(radius: int, bits: int = 64) -> list[int]:
    """For each band, radius + 1 pieces of what is outside of it; one of them is shared where the band is and the radius is kept."""
    n, low, out = radius + 1, [0], []
    for k in range(n):
        low.append(low[-1] + bits // n + (k < bits % n))
    for skipped in range(n):
        rest = [b for b in range(bits) if not low[skipped] <= b < low[skipped + 1]]
        for i in range(n):
            mask = sum(1 << b for b in rest[i * len(rest) // n : (i + 1) * len(rest) // n])
            out.append(mask - 2**64 if mask >= 2**63 else mask)
    return out


def near_pages(pages: DataFrame) -> DataFrame:
    """Pairs of pages (left_png, right_png) that look alike: hashes, shape, ink and grey, then thumbnails."""
    fields = ("d", "aspect", "ink_ratio", "gray_mean", "thumbnail")
    hashed = pages.filter("phash != '' and dhash != ''").withColumn("p", hash_of_hex(F.col("phash"))).withColumn("d", hash_of_hex(F.col("dhash")))
    pairs = hamming_pairs(hashed, "png", "p", PHASH_BITS, fields)
    gap = lambda c: F.abs(F.col(f"left_{c}") - F.col(f"right_{c}"))
    shape = F.abs(F.log(F.greatest(F.col("left_aspect"), F.lit(1e-6)) / F.greatest(F.col("right_aspect"), F.lit(1e-6))))
    close = pairs.filter((hamming(F.col("left_d"), F.col("right_d")) <= DHASH_BITS) & (shape <= ASPECT_GAP) & (gap("ink_ratio") <= INK_GAP) & (gap("gray_mean") <= GREY_GAP))
    return close.filter(same_picture("left_thumbnail", "right_thumbnail")).select("left_png", "right_png")


def connected(edges: DataFrame, left: str, right: str, rounds: int = 50) -> DataFrame:
    """(node, component): the least node that each node reaches, by least neighbours and shortcuts.

    Each round is written to the shared folder, so plans stay short and lost executors cost nothing.
    """
    one = edges.select(F.col(left).alias("u"), F.col(right).alias("v"))
    both = settled(one.unionByName(one.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    label = settled(both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("component")), "labels")
    for _ in range(rounds):
        around = both.join(label.select(F.col("node").alias("v"), "component"), "v").groupBy(F.col("u").alias("node")).agg(F.min("component").alias("m"))
        nearer = label.join(around, "node").select("node", F.least("component", "m").alias("component"), (F.col("m") < F.col("component")).alias("moved"))
        parent = nearer.select(F.col("node").alias("component"), F.col("component").alias("up"))
        new = settled(nearer.join(parent, "component", "left").select("node", F.least("component", "up").alias("component"), "moved"), "labels")
        label = new.drop("moved")
        if new.filter("moved").isEmpty():
            return label
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def cover(order: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The clique of each of ``order``'s members, who come one after the other and join the first clique whose members all link to them.

    ``left`` and ``right`` are the ends of the links as places in ``order``.  A clique takes a
    member in if the member's links into it are as many as it has members, so the work is
    that of going through all links once.
    """
    n = len(order)
    late, early = np.maximum(left, right), np.minimum(left, right)
    keep = late != early
    pair = np.unique(late[keep] * n + early[keep])
    late, early = pair // max(n, 1), pair % max(n, 1)
    begin = np.searchsorted(late, np.arange(n + 1))
    clique, size = np.zeros(n, np.int64), np.zeros(n, np.int64)
    used = 0
    for k in range(n):
        seen, links = np.unique(clique[early[begin[k] : begin[k + 1]]], return_counts=True)
        whole = seen[links == size[seen]]
        clique[k] = whole[0] if len(whole) else used
        used += not len(whole)
        size[clique[k]] += 1
    return clique


def cliques(rows: DataFrame, edges: DataFrame, component: str, key: str, order: str) -> DataFrame:
    """rows with ``clique``: within a component, rows by ``order`` (1 first) join the first clique whose members all link to them."""
    links = edges.select("left_" + key, "right_" + key)

    def split(members: pa.Table, pairs: pa.Table) -> pa.Table:
        members = members.sort_by(order)
        place = pd.Series(np.arange(len(members)), index=members[key].to_pandas())
        ends = [place.reindex(pairs[side + key].to_pandas()).to_numpy().astype(np.int64) for side in ("left_", "right_")]
        return members.append_column("clique", pa.array(cover(np.arange(len(members)), *ends), pa.int64()))

    tagged = links.join(rows.select(F.col(key).alias("left_" + key), F.col(component).alias("_part")), "left_" + key)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", clique long"
    return rows.groupBy(component).cogroup(tagged.groupBy("_part")).applyInArrow(lambda a, b: split(a, b), ddl)


def numbered(groups: DataFrame, least: str, name: str = "cluster_id") -> DataFrame:
    """Groups with names by the order of their least member, single ones included."""
    return ordered.numbered(groups, [least], name).withColumn(name, F.format_string("cluster_%06d", name))


def unique_pages(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one page of each cluster, clusters of more than one): exact copies, then complete linkage of look-alikes."""
    # Written once: pictures are not looked through again for each use of their features.
    usable = settled(pages.filter("is_cs and valid"), "pages")
    keep = F.struct(*KEEP_KEY)
    exact = best_of_group(usable, "sha256", KEEP_KEY)
    pairs = near_pages(exact)
    label = connected(pairs, "left_png", "right_png").withColumnRenamed("node", "png")
    ranked = exact.join(label, "png", "left").withColumn("component", F.coalesce("component", "png"))
    ranked = ranked.withColumn("_order", F.row_number().over(Window.partitionBy("component").orderBy(F.desc(keep))))
    placed = cliques(ranked.select("png", "component", "_order"), pairs, "component", "png", "_order")
    tagged = exact.join(placed.select("png", "component", "clique"), "png")
    members = usable.join(tagged.select("sha256", "component", "clique"), "sha256")
    sizes = members.groupBy("component", "clique").agg(
        F.count("*").alias("size"), F.count_distinct("sha256").alias("exact_variants"), F.min("png").alias("least"), F.max_by("png", keep).alias("keep"), F.sort_array(F.collect_list(F.struct("png", "elements", "sha256", "phash"))).alias("members")
    )
    clusters = numbered(sizes, "least")
    winners = usable.join(clusters.select(F.col("keep").alias("png"), F.col("cluster_id").alias("dedup_cluster"), F.col("size").alias("dedup_cluster_size"), F.col("exact_variants").alias("dedup_exact_variants")), "png")
    return winners, clusters.filter("size > 1").select("cluster_id", "size", "exact_variants", "keep", "members")

"""Near-duplicate documents: SuperMinHash signatures, banding, verification, components.

A document's set holds its distinct k-word shingles.  Documents with equal sets form a
class, and only one of a class goes on.  Each element of a set draws correlated
permutation ranks: in round j it offers its j-th random number plus j to the j-th place
of its own random permutation of the signature, and a document stops as soon as no later
round can lower any place.  Classes that share a band of the signature are candidates;
whole sets decide.  Bands are chosen so that a link at the threshold shares none with a
chance of ``MISS``; links above it are rarer still to be missed.  There is no second way
to such a link.

Candidate clusters (connected by shared bands) are compared exactly: small ones in one
task with others, large ones in chunks of bounded size, whose linked parts then meet
through one member each, until nothing joins any more; what is still apart is then
compared in blocks, each document of all but the largest part with every document of the
cluster, so no link between candidates of different parts is lost and no pair inside a part is made.

Null text and text without words give the empty set, linked with nothing.  Rows with a
null id are left out.  A repeated id is one document that has the links of all its rows;
each row is returned.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import Scratch, done, table, tidied
from llm.components import components
from llm.textcodes import BASE, byte_chunks, mix, shingles, signed, word_codes

#: The most shingles (and documents) of a cluster that one task compares.
TASK_SHINGLES, TASK_DOCS = 1_500_000, 2_000
#: The chance to miss a pair at the threshold that banding may leave.
MISS = 1e-5


def banding(threshold: float, miss: float = MISS, longest: int = 5) -> tuple[int, int]:
    """(rows of a band, bands): the most rows for which at most 24 bands keep the miss rate."""
    for rows in range(longest, 0, -1):
        bands = math.ceil(math.log(miss) / math.log(1 - threshold**rows)) if threshold < 1 else 1
        if bands <= 24:
            return rows, bands
    return 1, math.ceil(math.log(miss) / math.log(1 - threshold))


def superminhash(codes: np.ndarray, at: np.ndarray, m: int) -> np.ndarray:
    """Signatures (rows x m) of sets of codes; at[i]:at[i + 1] are those of row i.  Empty sets stay infinite."""
    n = len(at) - 1
    out = np.full((n, m), np.inf)
    flat = out.ravel()
    row = np.repeat(np.arange(n), np.diff(at))
    swaps: list[np.ndarray] = []
    for j in range(m):
        if not len(codes):
            break
        draw = mix(codes + np.uint64((j + 1) * 0xD1B54A32D192ED03 % 2**64))
        value = (draw >> np.uint64(11)).astype(np.float64) * 2.0**-53 + j
        place = (j + mix(draw ^ BASE) % np.uint64(m - j)).astype(np.int16)
        swaps.append(place)
        place = place.copy()
        for i in range(j - 1, -1, -1):  # where earlier swaps have taken this place from
            np.copyto(place, np.int16(i), where=place == swaps[i])
        np.minimum.at(flat, row * m + place, value)
        open_rows = out.max(axis=1) > j + 1
        keep = open_rows[row]
        if not keep.all():
            codes, row, swaps = codes[keep], row[keep], [s[keep] for s in swaps]
    return out


SIGNED = "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>"


def signatures(docs: DataFrame, k: int, rows: int, bands: int) -> DataFrame:
    m = rows * bands

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, data, offsets in byte_chunks(batch.column(1)):
                code, at = shingles(*word_codes(data, offsets), k)
                n = np.diff(at)
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code)])
                other = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(code ^ BASE))])
                sig = superminhash(code, at, m).view(np.uint64).reshape(len(n), bands, rows)
                band = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * BASE, (len(n), bands))
                for r in range(rows):
                    band = mix(band * BASE + sig[:, :, r])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, len(n)),
                        pa.array(n.astype(np.int64)),
                        pa.array(signed(sums[at[1:]] - sums[at[:-1]])),
                        pa.array(signed(other[at[1:]] - other[at[:-1]])),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, len(n) * bands + 1, bands, dtype=np.int32)), pa.array(signed(np.ascontiguousarray(band)).ravel())),
                    ],
                    ["doc_id", "n_shingles", "d1", "d2", "bands"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter("doc_id is not null").mapInArrow(tidied(sign), SIGNED)


def _linked(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning set of the links between documents a and documents b (indices into sets).

    Breadth first: each document that is reached counts its common shingles with all
    that are not reached yet, through postings of their shingles.
    """
    b_sizes = np.array([len(sets[i]) for i in b])
    token = np.concatenate([sets[i] for i in b]) if len(b) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(b)), b_sizes)
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    waiting = np.ones(len(b), bool)
    where = {int(d): i for i, d in enumerate(b)}
    links: list[tuple[int, int]] = []
    sources, queue = list(map(int, a)), []
    seen: set[int] = set()
    removed = 0
    while (queue or sources) and waiting.any():
        x = queue.pop() if queue else sources.pop()
        if x in seen:
            continue
        seen.add(x)
        if x in where and waiting[where[x]]:
            waiting[where[x]] = False
        s = sets[x]
        lo, hi = np.searchsorted(token, s, "left"), np.searchsorted(token, s, "right")
        size = hi - lo
        if size.sum():
            at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
            common = np.bincount(owner[at], minlength=len(b))
            union = b_sizes + len(s) - common
            hit = np.flatnonzero(waiting & (common > 0) & (100 * common >= percent * union))
            for i in hit:
                links.append((x, int(b[i])))
                queue.append(int(b[i]))
            waiting[hit] = False
            removed += len(hit)
            if removed > max(8, len(b) // 4):
                keep = waiting[owner]
                token, owner, removed = token[keep], owner[keep], 0
    return links


def _sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for _, data, offsets in byte_chunks(texts):
        code, at = shingles(*word_codes(data, offsets), k)
        out += [code[at[i] : at[i + 1]] for i in range(len(at) - 1)]
    return out


def _compare(docs: DataFrame, assigned: DataFrame, k: int, percent: int, links: bool = False) -> DataFrame:
    """(node, root): the least document that each linked one reaches inside its (task, part).

    With ``links`` the links (node, root) themselves: documents of side 0 meet all of their
    part, those of side 1 only side 0.
    """

    def link(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        part, side = group["part"].to_numpy(), group["side"].to_numpy()
        ids, sets = group["doc_id"].to_numpy(), _sets(group["text"], k)
        order = np.argsort(part, kind="stable")
        u: list[int] = []
        v: list[int] = []
        for some in np.split(order, np.flatnonzero(np.diff(part[order])) + 1) if len(order) else []:
            pairs = [(int(ids[x]), int(ids[y])) for x, y in _linked(sets, some[side[some] == 0], some, percent)]
            if links:
                u += [x for x, _ in pairs]
                v += [y for _, y in pairs]
                continue
            up: dict[int, int] = {}

            def root(x: int) -> int:
                while up.setdefault(x, x) != x:  # noqa: B023
                    up[x] = x = up[up[x]]  # noqa: B023
                return x

            for x, y in pairs:
                x, y = sorted((root(x), root(y)))
                up[y] = x
            u += up
            v += [root(x) for x in up]
        return pa.table({"node": pa.array(u, pa.int64()), "root": pa.array(v, pa.int64())})

    rows = docs.join(assigned, "doc_id").select("task", "part", "side", "doc_id", "text")
    return rows.groupBy("task").applyInArrow(lambda t: done(link(t)), "node long, root long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, task_shingles: int = TASK_SHINGLES, task_docs: int = TASK_DOCS) -> DataFrame:
    """Each document's set size and the least document that it can reach by links of at least ``percent``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "minhash")
    rows, bands = banding(percent / 100)
    signs = scratch.put(signatures(docs, k, rows, bands), "signatures")
    classes = scratch.put(
        signs.filter("n_shingles > 0").groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")), "classes"
    )
    keys = classes.select("rep", F.posexplode("bands").alias("band", "key"))
    shared = keys.groupBy("band", "key").agg(F.min("rep").alias("v"), F.count("*").alias("n")).filter("n > 1").drop("n")
    near = components(keys.join(shared, ["band", "key"]).select(F.col("rep").alias("u"), "v"), scratch, "candidates")
    sized = near.join(classes.select(F.col("rep").alias("node"), "n_shingles"), "node").select(F.col("node").alias("doc_id"), "component", "n_shingles")
    sized = scratch.put(sized, "clusters")
    totals = sized.groupBy("component").agg(F.sum("n_shingles").alias("total"), F.count("*").alias("docs"))
    totals = totals.withColumn("chunks", F.ceil(F.greatest(F.col("total") / task_shingles, F.col("docs") / task_docs)).cast("long"))
    totals = scratch.put(totals, "totals")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter("doc_id is not null")

    whole = totals.filter("chunks = 1").agg(F.sum("total")).first()[0] or 0
    tasks = max(1, math.ceil(whole / task_shingles))
    small_ones = sized.join(totals.filter("chunks = 1").select("component"), "component").select(
        "doc_id", F.pmod(F.xxhash64("component"), F.lit(tasks)).alias("task"), F.col("component").alias("part"), F.lit(0).alias("side")
    )
    found = scratch.put(_compare(texts, small_ones, k, percent), "roots")

    large = sized.join(totals.filter("chunks > 1").select("component", "chunks"), "component")
    if not large.isEmpty():
        found = found.unionByName(_large(texts, large, k, percent, scratch, task_shingles, task_docs))
    named = classes.select("n_shingles", "d1", "d2", "rep").join(found.groupBy("node").agg(F.min("root").alias("root")), F.col("rep") == F.col("node"), "left")
    named = named.select("n_shingles", "d1", "d2", F.coalesce("root", "rep").alias("component_id"))
    out = signs.drop("bands").join(named, ["n_shingles", "d1", "d2"], "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _large(texts: DataFrame, large: DataFrame, k: int, percent: int, scratch: Scratch, task_shingles: int, task_docs: int) -> DataFrame:
    """(node, root) for clusters that are too large for a task."""
    state = scratch.put(large.select("doc_id", "component", "n_shingles", F.col("doc_id").alias("label")), "large-0")

    def relabel(roots: DataFrame, name: str) -> DataFrame:
        new = state.join(roots.groupBy(F.col("node").alias("label")).agg(F.min("root").alias("root")), "label", "left")
        return scratch.put(new.select("doc_id", "component", "n_shingles", F.coalesce("root", "label").alias("label")), name)

    def chunked(members: DataFrame, salt: int) -> DataFrame:
        sums = members.groupBy("component").agg(F.sum("n_shingles").alias("total"), F.count("*").alias("docs"))
        n = F.ceil(F.greatest(F.col("total") / task_shingles, F.col("docs") / task_docs)).cast("long")
        chunk = F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.col("n"))
        task = F.xxhash64("component", chunk, F.lit(salt))
        return members.join(sums.select("component", n.alias("n")), "component").select("doc_id", task.alias("task"), task.alias("part"), F.lit(0).alias("side"))

    members, left, step = state, None, 0
    while True:  # chunks, then one of each linked part, while parts still join
        step += 1
        state = relabel(_compare(texts, chunked(members, step), k, percent), f"large-{step}")
        members = state.filter("doc_id = label")
        now, least = members.agg(F.count("*"), F.count_distinct("component")).first()
        if now in (left, least):
            break
        left = now

    parts = state.groupBy("component", "label").agg(F.count("*").alias("docs"), F.sum("n_shingles").alias("total"))
    rank = F.row_number().over(Window.partitionBy("component").orderBy(F.desc("docs"), "label"))
    parts = scratch.put(parts.withColumn("main", rank == 1), "parts")
    apart = parts.filter("not main").groupBy("component").agg(F.sum("docs").alias("o_docs"), F.sum("total").alias("o_total"))
    if not apart.isEmpty():
        whole = parts.groupBy("component").agg(F.sum("docs").alias("docs"), F.sum("total").alias("total"))

        def blocks(size: str, count: str):
            return F.ceil(F.greatest(2 * F.col(size) / task_shingles, 2 * F.col(count) / task_docs)).cast("long")

        plan = apart.join(whole, "component").select("component", blocks("o_total", "o_docs").alias("rows"), blocks("total", "docs").alias("columns"))
        placed = state.join(parts.select("component", "label", "main"), ["component", "label"]).join(plan, "component")
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        as_row = placed.filter("not main").select("doc_id", "component", F.pmod(F.xxhash64("doc_id", F.lit("row")), F.col("rows")).alias("r"), every("columns").alias("c"), F.lit(0).alias("side"))
        as_column = placed.select("doc_id", "component", every("rows").alias("r"), F.pmod(F.xxhash64("doc_id", F.lit("column")), F.col("columns")).alias("c"), F.lit(1).alias("side"))
        both = as_row.unionByName(as_column).groupBy("doc_id", "component", "r", "c").agg(F.min("side").alias("side"))
        task = F.xxhash64("component", "r", "c")
        links = _compare(texts, both.select("doc_id", task.alias("task"), task.alias("part"), "side"), k, percent, links=True)
        labels = state.select(F.col("doc_id").alias("node"), F.col("label").alias("u")).distinct()
        ends = links.join(labels, "node").select("u", F.col("root").alias("node")).join(labels.withColumnRenamed("u", "v"), "node").select("u", "v").filter("u != v")
        ends = scratch.put(ends.distinct(), "links-blocks")
        if not ends.isEmpty():
            state = relabel(components(ends, scratch, "parts-linked").select("node", F.col("component").alias("root")), "large-linked")
    return state.select(F.col("doc_id").alias("node"), F.col("label").alias("root"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, linked from 85 hundredths."""
    found = near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))

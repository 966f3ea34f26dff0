"""Ordered folds: next-fit packing and fixed chunks.

Next-fit depends on all that came before, so it is a fold over rows in order.  Rows are
ranged into blocks; each block tells in a few numbers what it does to the bin that is open
before it, and the blocks are then followed by these numbers alone.  With what each block
starts from known, all blocks number their rows side by side.  Bins never depend on how
rows are spread.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.operators.ordered import numbered
from loomwright.session import settled

#: Fixed value: archives round files up to so many bytes and add as many for a header.
TAR_BLOCK = 512


def next_fit(weights: np.ndarray, cap: float, carried: float | None = None) -> tuple[np.ndarray, float]:
    """(bin of each item, what the last bin holds); ``carried`` is what an open bin holds already.

    A bin closes when the next item would exceed ``cap``; an item above it is alone in its bin.
    """
    n = len(weights)
    sums = np.concatenate([[0.0], np.cumsum(weights)])
    bins = np.zeros(n, np.int64)
    if not n:
        return bins, carried or 0.0
    at = 0 if carried is None else int(np.searchsorted(sums, cap - carried, "right")) - 1
    if carried is not None and at >= n:
        return bins, carried + sums[-1]
    starts = _starts(sums, cap, max(at, 0))
    bins[starts if carried is not None else starts[1:]] = 1
    return np.cumsum(bins), float(sums[-1] - sums[starts[-1]])


def _next(sums: np.ndarray, cap: float) -> np.ndarray:
    """For each item, the item that opens the next bin if it opens one."""
    n = len(sums) - 1
    return np.maximum(np.searchsorted(sums, sums[:-1] + cap, "right") - 1, np.arange(n) + 1)


def _starts(sums: np.ndarray, cap: float, first: int) -> np.ndarray:
    after, out, at = _next(sums, cap).tolist(), [], first
    while at < len(after):
        out.append(at)
        at = after[at]
    return np.array(out, np.int64)


def transitions(weights: np.ndarray, cap: float) -> dict[str, list]:
    """What a block of items does to a bin that is open before it, whatever that holds.

    ``room``: sums of the leading items that an open bin may still take; where the k-th sum
    is the first that does not fit, ``count[k]`` bins are opened and the last one holds
    ``held[k]``.  Only items that fit into one empty bin from the block's beginning count,
    so the lists are as long as a bin has items, however long the block is.
    """
    sums = np.concatenate([[0.0], np.cumsum(weights)])
    n = len(weights)
    most = max(1, min(n, int(np.searchsorted(sums, cap, "right")))) if n else 0
    after = _next(sums, cap).tolist() if n else []
    count, held = [0] * (n + 1), [0.0] * (n + 1)
    for i in range(n - 1, -1, -1):
        j = after[i]
        count[i], held[i] = (1, float(sums[n] - sums[i])) if j >= n else (count[j] + 1, held[j])
    return {"room": sums[1 : most + 1].tolist(), "count": count[:most], "held": held[:most], "total": float(sums[-1])}


def pack_next_fit(df: DataFrame, order: Sequence[str], weight: Column, cap: float, name: str = "bin", block: int | None = None) -> DataFrame:
    """``df`` with the number of its bin, from 0, in the order of ``order`` (a total one).

    ``block``: about so many rows to a partition; Spark decides where it is not given.
    """
    rows = df.withColumn("_w", weight.cast("double"))
    if block:
        rows = rows.repartitionByRange(max(1, -(-df.count() // block)), *order).sortWithinPartitions(*order)
    else:
        rows = rows.orderBy(*order)
    # Partition and place are written with the rows, so both passes see the same blocks.
    placed = settled(rows.withColumn("_m", F.monotonically_increasing_id()).withColumn("_b", F.shiftright("_m", 33)), name)

    def summary(group: pa.Table) -> pa.Table:
        got = transitions(group.sort_by("_m")["_w"].to_numpy(), cap)
        return pa.table({"_b": group["_b"][:1]} | {k: pa.array([v], pa.float64() if k == "total" else pa.list_(pa.float64())) for k, v in got.items()})

    # For each block as many numbers as a bin has items: these alone come to the driver.
    tables = placed.select("_b", "_m", "_w").groupBy("_b").applyInArrow(lambda t: summary(t), "_b long, room array<double>, count array<double>, held array<double>, total double")
    known: dict[int, tuple[float | None, int]] = {}
    held, number = None, 0
    for r in sorted(tables.collect(), key=lambda r: r["_b"]):
        known[r["_b"]] = (held, number)
        if held is None:
            number, held = number + int(r["count"][0]) - 1, r["held"][0]
            continue
        k = int(np.searchsorted(np.array(r["room"]), cap - held, "right"))
        if k >= len(r["room"]) and held + r["total"] <= cap:
            held += r["total"]
        else:
            k = min(k, len(r["count"]) - 1)
            number, held = number + int(r["count"][k]), r["held"][k]
    starts = placed.sparkSession.sparkContext.broadcast(known)
    columns, ddl = df.columns, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + f", `{name}` long"

    def fold(group: pa.Table) -> pa.Table:
        group = group.sort_by("_m")
        carried, first = starts.value[group["_b"][0].as_py()]
        bins, _ = next_fit(group["_w"].to_numpy(), cap, carried)
        return group.select(columns).append_column(name, pa.array(bins + first, pa.int64()))

    return placed.groupBy("_b").applyInArrow(lambda t: fold(t), ddl)


def tar_size(length: Column) -> Column:
    """Bytes that a file takes in an archive."""
    return TAR_BLOCK + F.ceil(length / TAR_BLOCK) * TAR_BLOCK


def fixed_chunks(df: DataFrame, order: Sequence[Column], size: int, name: str = "chunk") -> DataFrame:
    """Rows in order, so many to a chunk."""
    return numbered(df, order, name, 0).withColumn(name, F.floor(F.col(name) / size).cast("long"))


def slice_rows(df: DataFrame, order: Sequence[Column], offset: int = 0, limit: int | None = None) -> DataFrame:
    out = df.orderBy(*order).offset(offset)
    return out if limit is None else out.limit(limit)

"""Tables of runs, keyed state, the metric index and components that grow by batches."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from loomwright.operators import dedup
from loomwright.operators.growing import SLOTS, Components, MetricIndex
from loomwright.streaming.incremental import KeyedState
from loomwright.streaming.runs import Runs

SCHEMA = StructType([StructField("k", LongType()), StructField("at", LongType()), StructField("v", StringType())])


def written(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_a_batch_writes_in_proportion_to_itself(spark, tmp_path):
    state = KeyedState(spark, f"file://{tmp_path}/s", SCHEMA, "k", ["at"])
    large = spark.range(200_000).select(F.col("id").alias("k"), F.lit(0).cast("long").alias("at"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    state.merge(large, 0)
    base, want = written(tmp_path), {}
    for n in range(1, 12):
        before = written(tmp_path)
        rows = [(int(k), n, f"v{n}") for k in range(n * 7, n * 7 + 20)]
        want |= {k: v for k, _, v in rows}
        state.merge(spark.createDataFrame(rows, SCHEMA), n)
        assert written(tmp_path) - before < base / 20
    got = {r.k: r.v for r in state.version().filter("at > 0").collect()}
    assert got == want and state.version().count() == 200_000
    # Runs of one level were merged, so there are few.
    assert len(state.runs.runs()) <= 3 * 4
    assert state.version(3).filter("at > 3").isEmpty()  # an old version is as it was
    assert {r.k: r.v for r in state.of(spark.createDataFrame([(8,), (10**9,), (8,)], "k long")).collect()} == {8: want[8]}
    assert state.runs.vacuum() > 0
    assert state.version().filter("at > 0").count() == len(want) and len(state.runs.numbers()) == 1


def test_a_crash_before_the_commit_loses_and_doubles_nothing(spark, tmp_path, monkeypatch):
    runs = Runs(spark, f"file://{tmp_path}/r", "k long")
    rows = lambda *k: spark.createDataFrame([(x,) for x in k], "k long")
    runs.add(rows(1, 2), 0)
    with monkeypatch.context() as m:
        m.setattr(Runs, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            runs.add(rows(3), 1)
    assert sorted(r.k for r in runs.table().collect()) == [1, 2]
    for _ in range(2):  # the batch comes again, and once more
        runs.add(rows(3), 1)
    assert sorted(r.k for r in runs.table().collect()) == [1, 2, 3]
    assert runs.vacuum(2) == 1  # what the crash left
    assert sorted(r.k for r in runs.table().collect()) == [1, 2, 3]
    assert Runs(spark, f"file://{tmp_path}/none", "k long").table().count() == 0
    runs.add(rows(1).limit(0))
    assert runs.table().count() == 3


@pytest.fixture(scope="module")
def codes():
    rng = np.random.default_rng(7)
    base = [int(x) for x in rng.integers(-(2**63), 2**63 - 1, 40)]
    out = []
    for b in base:
        for _ in range(6):
            mask = sum(1 << int(i) for i in rng.choice(63, rng.integers(0, 5), replace=False))
            out.append(b ^ mask)
    return list(enumerate(out)) + [(10_000, None), (10_001, 0), (10_002, -1), (10_003, 0)]


def test_batches_give_the_pairs_of_one_join(spark, tmp_path, codes):
    df = spark.createDataFrame(codes, "key long, code long")
    want = {(a, b): bin((x ^ y) & (2**64 - 1)).count("1") for a, x in codes for b, y in codes if a < b and x is not None and y is not None and bin((x ^ y) & (2**64 - 1)).count("1") <= 4}
    assert {(r.left_key, r.right_key): r.distance for r in dedup.hamming_pairs(df, "key", "code", 4).collect()} == want
    index, found = MetricIndex(spark, f"file://{tmp_path}/i", 4), []
    for i in range(5):
        found += [((r.left_key, r.right_key), r.distance) for r in index.add(df.filter(F.col("key") % 5 == i), i).collect()]
    assert len(found) == len(want) and dict(found) == want
    with pytest.raises(ValueError):
        index.add(df, 2)
    asked = spark.createDataFrame([(77_000, codes[3][1]), (77_001, None)], "key long, code long")
    near = {r.other: r.distance for r in index.query(asked).collect()}
    assert near == {k: bin((c ^ codes[3][1]) & (2**64 - 1)).count("1") for k, c in codes if c is not None and bin((c ^ codes[3][1]) & (2**64 - 1)).count("1") <= 4}


def test_a_small_batch_reads_few_files(spark, tmp_path, codes):
    index = MetricIndex(spark, f"file://{tmp_path}/i", 4)
    rng = np.random.default_rng(3)
    index.add(spark.createDataFrame([(i, int(x)) for i, x in enumerate(rng.integers(-(2**63), 2**63 - 1, 3000))], "key long, code long"))
    one = spark.createDataFrame([(10**6, 5)], "key long, code long")
    files = index.near(one)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in files
    whole = index.runs.rows().select(F.input_file_name()).distinct().count()
    asked = [r[0] for r in index._banded(one).select(F.col("_band") * SLOTS + F.col("_slot")).collect()]
    read = index.runs.rows().filter((F.col("_band") * SLOTS + F.col("_slot")).isin(asked)).select(F.input_file_name()).distinct().count()
    assert read * 8 < whole and index.near(one).count() < 300


def test_batches_of_links_give_the_labels_of_one_run(spark, tmp_path):
    rng = np.random.default_rng(5)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(7, 7), (400, 401), (401, 402), (402, 400)]
    df = spark.createDataFrame(links, "a long, b long")
    parts, moved = Components(spark, f"file://{tmp_path}/c"), 0
    for i in range(5):
        before = {r.node: r.component for r in parts.labels().collect()}
        changed = {r.node: r.component for r in parts.add(df.filter((F.col("a") * 3 + F.col("b")) % 5 == i), "a", "b").collect()}
        after = {r.node: r.component for r in parts.labels().collect()}
        assert changed == {n: c for n, c in after.items() if before.get(n) != c}  # only what moved is written
        moved += len(changed)
    one = {r.node: r.component for r in dedup.connected(df.filter("a != b"), "a", "b").collect()}
    assert {n: c for n, c in after.items() if n in one} == one and after[7] == min(after[7], 7)
    assert parts.add(df.limit(0), "a", "b").count() == 0

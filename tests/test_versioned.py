"""S11, ST4, ST5: a change rewrites the buckets it touches and nothing else."""

import os
import random

import pytest

from quarry.session import scratch_path
from quarry.sources import versioned
from quarry.streaming.stream import backfill_versions, fresh_paths

SCHEMA = "k long, g string, y double"


def files(root):
    """Data file -> its time of change."""
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet") and "_manifest" not in d}


def local(spark, name):
    return scratch_path(spark, name).removeprefix("file:")


def rows_of(spark, root, version):
    return sorted(tuple(r) for r in versioned.read(spark, root, version).select("k", "g", "y").collect())


def bucket_of(spark, keys, root):
    n = versioned.manifest(spark, root, 0)[0]["buckets"]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    return {r["k"]: r["b"] for r in df.select("k", versioned._bucket(["k"], n).alias("b")).collect()}


def test_merge_rewrites_touched_buckets_only(spark):
    root = local(spark, "merge")
    versioned.create(spark.createDataFrame([(i, "a", None) for i in range(200)], SCHEMA), root, ["k"], buckets=16)
    before = files(root)
    changes = spark.createDataFrame([(3, "x", 1.5), (77, "y", None), (999, "z", 2.0)], SCHEMA)
    touched = versioned.merge(spark, root, changes, 1, cols=["y"])
    of = bucket_of(spark, [3, 77, 999], root)
    assert touched == set(of.values()) and len(touched) <= 3
    after = files(root)
    assert {f: t for f, t in after.items() if f in before} == before  # nothing of version 0 was written again
    assert {int(f.split("__kb=")[1].split("/")[0]) for f in after if f not in before} == touched
    assert rows_of(spark, root, 1) == [(i, "a", 1.5 if i == 3 else None) if i else (0, "a", None) for i in range(200)]
    assert rows_of(spark, root, 0) == [(i, "a", None) for i in range(200)]


def test_repeating_a_version_changes_nothing(spark):
    root = local(spark, "again")
    versioned.create(spark.createDataFrame([(i, "a", 0.0) for i in range(50)], SCHEMA), root, ["k"], buckets=8)
    changes = spark.createDataFrame([(5, "n", 5.0), (60, "n", 6.0)], SCHEMA)
    for _ in range(2):
        versioned.merge(spark, root, changes, 1)
        assert len(rows_of(spark, root, 1)) == 51 and (5, "n", 5.0) in rows_of(spark, root, 1)


@pytest.mark.parametrize("seed", [1, 2])
def test_changes_in_random_batches_equal_a_rebuilt_table(spark, seed):
    r = random.Random(seed)
    root, held = local(spark, "random"), {i: (i, "a", float(i)) for i in range(40)}
    held[None] = (None, "a", 1.0)
    versioned.create(spark.createDataFrame(list(held.values()), SCHEMA), root, ["k"], buckets=4)
    for version in range(1, 5):
        batch = {k: (k, f"v{version}", r.random()) for k in r.sample([None, *range(60)], r.choice([0, 1, 5, 20]))}
        if version % 2:
            versioned.merge(spark, root, spark.createDataFrame(list(batch.values()), SCHEMA), version)
            held |= batch
        else:
            batch.pop(None, None)
            versioned.merge(spark, root, spark.createDataFrame(list(batch.values()), SCHEMA), version, cols=["g", "y"])
            held |= {k: v for k, v in batch.items() if k in held}
        got = sorted(map(repr, (tuple(x) for x in versioned.read(spark, root, version).select("k", "g", "y").collect())))
        assert got == sorted(map(repr, held.values()))


def test_updates_must_be_unique(spark):
    root = local(spark, "unique")
    versioned.create(spark.createDataFrame([(1, "a", 0.0)], SCHEMA), root, ["k"])
    with pytest.raises(Exception, match="not unique"):
        versioned.merge(spark, root, spark.createDataFrame([(1, "a", 1.0), (1, "a", 2.0)], SCHEMA), 1, cols=["y"])


def test_empty_tables(spark):
    root = local(spark, "empty")
    none = spark.createDataFrame([], SCHEMA)
    versioned.create(spark.createDataFrame([(1, "a", 0.0)], SCHEMA), root, ["k"])
    assert versioned.merge(spark, root, none, 1) == set() and versioned.merge(spark, root, none, 2, cols=["y"]) == set()
    assert rows_of(spark, root, 2) == [(1, "a", 0.0)]
    root = local(spark, "none")
    versioned.create(none, root, ["k"])
    assert versioned.read(spark, root, 0).schema == none.schema and rows_of(spark, root, 0) == []
    assert versioned.merge(spark, root, spark.createDataFrame([(1, "a", 0.0)], SCHEMA), 1, cols=["y"]) == set()
    assert len(versioned.merge(spark, root, spark.createDataFrame([(1, "a", 0.0)], SCHEMA), 2)) == 1 and rows_of(spark, root, 2) == [(1, "a", 0.0)]


def test_expired_folders_go_and_named_ones_stay(spark):
    root = local(spark, "expire")
    versioned.create(spark.createDataFrame([(i, "a", 0.0) for i in range(100)], SCHEMA), root, ["k"], buckets=8)
    for v in range(1, 5):
        versioned.merge(spark, root, spark.createDataFrame([(1, f"v{v}", float(v))], SCHEMA), v)
    want = [rows_of(spark, root, v) for v in (3, 4)]
    gone = versioned.expire(spark, root, 4, keep=2)
    b = bucket_of(spark, [1], root)[1] if os.path.exists(f"{root}/_manifest/v0") else int(gone[0].split("=")[1])
    assert gone == [f"v{v}/__kb={b}" for v in (0, 1, 2)]
    assert [rows_of(spark, root, v) for v in (3, 4)] == want
    assert sorted(os.listdir(f"{root}/_manifest")) == ["v3", "v4"]


def test_late_actuals_of_a_stream(spark):
    """The newest of a batch's actuals counts; other buckets are left alone; a repeated epoch is the same."""
    root, ck = (p.removeprefix("file:") for p in fresh_paths(spark, "late"))
    versioned.create(spark.createDataFrame([(i, "a", None) for i in range(64)], SCHEMA), root, ["k"], buckets=16)
    before = files(root)
    batches = [[(1, 5.0, 1), (1, 7.0, 2), (500, 1.0, 1)], [(2, 9.0, 1)]]
    for n, batch in enumerate(batches):
        spark.createDataFrame(batch, "k long, y double, arrived int").write.parquet(f"{root}-in/{n}")
        src = spark.readStream.schema("k long, y double, arrived int").option("recursiveFileLookup", "true").parquet(f"{root}-in")
        src.writeStream.foreachBatch(backfill_versions(root, ["y"])).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()
    want = [(i, "a", {1: 7.0, 2: 9.0}.get(i)) for i in range(64)]
    assert sorted(rows_of(spark, root, 2)) == want
    backfill_versions(root, ["y"])(spark.createDataFrame(batches[1], "k long, y double, arrived int"), 1)
    assert rows_of(spark, root, 2) == want
    assert {f: t for f, t in files(root).items() if f in before} == before

"""Search by blocks returns what the full join returns, and opens few blocks."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.operators.block_search import block_candidates, bounds, deal
from quarry.operators.match import _full_candidates, batch_search, build_index, query_vectors

WORDS = ["amber", "cobalt", "ridge", "lake", "stone", "river", "falcon", "42", "ölfeld", "maple"]


def table(spark, n, seed):
    rng = random.Random(seed)
    # every name begins alike: the common grams are held by all, and names repeat
    return spark.createDataFrame([(i, "part no " + " ".join(rng.choices(WORDS, k=2)), i % 3) for i in range(n)], "id long, name string, grp int")


@pytest.mark.parametrize("size,k", [(1, 3), (4, 1), (16, 7)])
def test_equal_to_the_full_join(spark, size, k):
    c = table(spark, 120, 1)
    q = spark.createDataFrame([("part no amber lake", 0), ("cobalt", 1), ("no", 2), ("zzz", 0), ("", 1), ("Ölfeld 42 part", 2)], "q string, grp int")
    full = batch_search(q, "q", "q", c, "id", "name", k)
    assert sorted(map(tuple, batch_search(q, "q", "q", c, "id", "name", k, blocks=size).collect())) == sorted(map(tuple, full.collect()))


def test_filters_count_before_the_bound(spark):
    c = table(spark, 120, 2)
    q = spark.createDataFrame([("part no amber lake", 0), ("cobalt", 1), ("no", 7)], "q string, grp int")
    ask = dict(filters=F.col("q_grp") == F.col("c_grp"))
    want = batch_search(q, "q", "q", c, "id", "name", 4, **ask).collect()
    assert sorted(map(tuple, batch_search(q, "q", "q", c, "id", "name", 4, blocks=4, **ask).collect())) == sorted(map(tuple, want))


def test_blocks_that_cannot_rank_are_not_scored(spark):
    c = table(spark, 3000, 3)
    q = spark.createDataFrame([(f"part no {a} {b}",) for a in WORDS for b in WORDS[:3]], "q string")
    index, idf, n = build_index(c, "id", "name")
    qv = query_vectors(q, "q", "q", idf, n)
    every = _full_candidates(qv, index).count()
    assert every == 30 * 3000  # a gram that all hold joins every query with every name
    scored = block_candidates(qv, index, 5, 6, lambda d: d, 32).count()
    assert scored < every / 4
    # bounds are rows of blocks, and no score is above its bound
    dealt = deal(index, 32)
    bound = bounds(qv, dealt)
    assert bound.count() < every / 10
    block = dealt.select(F.col("id").alias("cid"), "block").distinct()
    over = _full_candidates(qv, index).join(block, "cid").join(bound, ["qid", "block"], "left").filter(F.col("bound").isNull() | (F.col("cos") > F.col("bound") + 1e-9))
    assert over.isEmpty()


def test_tasks_of_a_search_grow_with_its_texts(spark, monkeypatch):
    """Texts in one split become grams in many tasks, and the written index is not broadcast to score it."""
    from quarry.operators import block_search, match

    monkeypatch.setattr(match, "GRAMS_AT_ONCE", 1000)
    c = table(spark, 600, 4).coalesce(1)
    tf = match._gram_tf(c, "id", "name", 3)
    per_task = [r["count"] for r in tf.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) > 5 and max(per_task) < sum(per_task) / 3
    index, idf, n = build_index(c, "id", "name")
    qv = query_vectors(spark.createDataFrame([("part no amber lake",)], "q string"), "q", "q", idf, n)
    dealt = deal(index, 8)
    plan = block_search.scores(qv, dealt, bounds(qv, dealt))._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=merge" in plan

"""Quantiles of large groups equal the plain ones, and no task orders a whole group."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators.relational import exact_quantiles, hist_quantiles

QS = {"min": 0.0, "q1": 0.25, "mid": 0.5, "p99": 0.99, "max": 1.0}


def key(r):
    return str(r[0]), tuple(r)


@pytest.mark.parametrize("seed,rows_per_task,bins", [(1, 50, 10), (2, 10, 1000), (3, 0, 3), (4, 10**9, 10)])
def test_equal_to_plain_quantiles(spark, seed, rows_per_task, bins):
    r = random.Random(seed)
    rows = [(r.choice(["a", "b", None]), None if r.random() < 0.1 else r.choice([r.gauss(0, 100), float(r.randrange(5))])) for _ in range(600)] + [("one", 3.0), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = sorted(map(tuple, exact_quantiles(df, "v", "k", QS, rows_per_task, bins).collect()), key=repr)
    for k, n, *values in got:
        held = np.array([v for x, v in rows if x == k and v is not None])
        assert n == len(held) and np.allclose(values, np.quantile(held, list(QS.values())))
    plain = sorted(map(tuple, hist_quantiles(df, "v", "k", QS).collect()), key=repr)
    assert [x[:2] for x in got] == [x[:2] for x in plain] and np.allclose([x[2:] for x in got], [x[2:] for x in plain], rtol=0, atol=1e-9)


def test_one_group_of_distinct_values_is_ordered_in_small_parts(spark):
    """Of 100,000 distinct values in one group, the ordered bins together hold a few percent."""
    n = 100_000
    df = spark.range(n).select(F.lit("k").alias("k"), (F.col("id") * 7919 % n).cast("double").alias("v"))
    assert [tuple(r) for r in exact_quantiles(df, "v", "k", {"q1": 0.25, "q3": 0.75}, 1000, 200).collect()] == [("k", n, (n - 1) * 0.25, (n - 1) * 0.75)]
    cuts = df.groupBy("k").agg(F.percentile_approx("v", [i / 200 for i in range(1, 200)], 2000).alias("c"))
    held = df.join(cuts, "k").groupBy(F.size(F.filter("c", lambda c: c < F.col("v")))).count().agg(F.max("count")).first()[0]
    assert held < 3 * n / 200


def test_empty_table(spark):
    assert exact_quantiles(spark.createDataFrame([], "k string, v double"), "v", "k", QS).collect() == []

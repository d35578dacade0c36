"""The segmented scan equals the plain plan, spreads a hot key, and matches no nulls."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import asof
from quarry.operators.asof import asof_join, asof_join_many, retrieve

DAY = dt.date(2024, 1, 1)


def rows(spark, seed, n, keys=("a", "b", None)):
    r = random.Random(seed)
    day = lambda: None if r.random() < 0.1 else DAY + dt.timedelta(days=int(r.paretovariate(0.6)) % 200)
    spine = [(i, r.choice(keys), day()) for i in range(n)]
    feats = [(r.choice(keys), day(), None if r.random() < 0.2 else i, i) for i in range(n)]
    return spark.createDataFrame(spine, "id int, k string, t date"), spark.createDataFrame(feats, "k string, ft date, v int, w int")


def brute(spine, feats):
    out = []
    for i, k, t in map(tuple, spine.collect()):
        held = [(ft, v is not None, v or 0, w) for fk, ft, v, w in map(tuple, feats.collect()) if k is not None and t is not None and fk == k and ft is not None and ft <= t]
        best = max(held, default=None)
        out.append((i, k, t, best[2] if best and best[1] else None, best[3] if best else None, best[0] if best else None))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("id", "k", "t", "v", "w", "m").collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_all_modes_equal_brute_force(spark, seed):
    spine, feats = rows(spark, seed, 80)
    want = brute(spine, feats)
    for mode in ({}, {"segment_rows": 5}, {"segment_rows": 30}, {"segment_rows": 10**6}, {"time_bucket": "month"}, {"time_bucket": "year"}):
        assert got(asof_join(spine, feats, "k", "t", "ft", keep_feature_ts="m", **mode)) == want, mode


def test_null_keys_and_times_match_nothing(spark):
    spine = spark.createDataFrame([(1, None, DAY), (2, "a", None), (3, "a", DAY)], "id int, k string, t date")
    feats = spark.createDataFrame([(None, DAY, 9), ("a", None, 8), ("a", DAY, 7)], "k string, ft date, v int")
    for mode in ({}, {"segment_rows": 1}, {"time_bucket": "month"}):
        out = {r.id: r.v for r in asof_join(spine, feats, "k", "t", "ft", **mode).collect()}
        assert out == {1: None, 2: None, 3: 7}
        many = asof_join_many(spine, [{"df": feats, "timestamp_col": "ft"}, {"df": feats, "timestamp_col": "ft", "prefix": "p_"}], "k", "t", **mode)
        assert {r.id: (r.v, r.p_v) for r in many.collect()} == {1: (None, None), 2: (None, None), 3: (7, 7)}


def test_several_views_in_segments(spark):
    spine, feats = rows(spark, 7, 60)
    views = [{"df": feats, "keys": ["k"], "timestamp_col": "ft", "cols": ["v"]}, {"df": feats, "keys": ["k"], "timestamp_col": "ft", "cols": ["w"], "prefix": "x_"}]
    plain = retrieve(spine, views, "t")
    cut = retrieve(spine, [v | {"segment_rows": 4} for v in views], "t")
    assert plain.columns == cut.columns and sorted(map(repr, plain.collect())) == sorted(map(repr, cut.collect()))


def test_tolerance_in_segments(spark):
    spine, feats = rows(spark, 8, 60)
    plain = asof_join(spine, feats, "k", "t", "ft", tolerance="3 days", keep_feature_ts="m")
    assert got(asof_join(spine, feats, "k", "t", "ft", tolerance="3 days", keep_feature_ts="m", segment_rows=6)) == got(plain)


def test_a_key_with_all_rows_is_cut_where_its_rows_lie(spark):
    """Nine tenths of the rows within one hour: calendar units would leave them in one piece."""
    n = 20_000
    at = F.timestamp_seconds(F.when(F.col("id") % 10 > 0, F.lit(1_700_000_000) + F.col("id") % 3600).otherwise(1_600_000_000 + F.col("id") * 1000))
    ev = spark.range(n).select("id", F.lit("k").alias("k"), at.alias("t"))
    cuts = asof.time_cuts(ev, ["k"], "t", 1000).first()["__cuts"]
    held = ev.select(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col("t").cast("double"))).alias("s")).groupBy("s").count().collect()
    assert len(held) >= 18 and max(r["count"] for r in held) < 2000
    feats = ev.filter("id % 7 = 0").select("k", F.col("t").alias("ft"), F.col("id").alias("v"))
    a = asof_join(ev, feats, "k", "t", "ft")
    b = asof_join(ev, feats, "k", "t", "ft", segment_rows=1000)
    assert a.exceptAll(b).isEmpty() and b.count() == n


def test_no_hot_key_leaves_the_plain_plan(spark):
    spine, feats = rows(spark, 9, 20)
    assert asof.time_cuts(spine.filter("k IS NOT NULL"), ["k"], "t", 100) is None


def test_cuts_are_bisected(spark):
    """The segment of a row is the number of cuts before it, found without passing all cuts."""
    from quarry.operators.asof import MOST_SEGMENTS, cuts_before

    for n in (0, 1, 2, 7, 600, MOST_SEGMENTS - 1):
        cuts = [float(2 * i) for i in range(n)]
        df = spark.range(-2, 2 * n + 2).select(F.array(*[F.lit(c) for c in cuts]).cast("array<double>").alias("c"), F.col("id").cast("double").alias("at"))
        got = df.select("at", cuts_before("c", "at").alias("n")).collect()
        assert [(r.at, r.n) for r in got] == [(r.at, sum(c < r.at for c in cuts)) for r in got]
    plan = df.select(cuts_before("c", "at"))._jdf.queryExecution().analyzed().toString()
    assert "filter(" not in plan

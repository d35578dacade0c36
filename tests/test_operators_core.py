"""Unit tests on tiny hand-written frames: edge cases of FIXTURES.md §5."""

import datetime as dt

from pyspark.sql import functions as F

from quarry.functions.scalar import is_us_holiday, round_half_up, safe_div
from quarry.operators.asof import asof_join
from quarry.operators.relational import (
    discrete_summary,
    first_n,
    latest_per_key,
    nth_value_cols,
    surrogate_key,
)
from quarry.operators.timeseries import compute_lag, future_stubs, rolling, ts_features
from quarry.sources.sinks import check_fk, check_unique, merge_update

D = dt.date


def test_safe_div_and_round(spark):
    df = spark.createDataFrame([(1.005, 1.0, 0.0)], "a double, b double, z double")
    r = df.select(
        safe_div("a", "z").alias("q"),
        round_half_up("a", 2).alias("r"),
        round_half_up(F.lit(-2.5), 0).alias("n"),
    ).first()
    assert r.q is None
    assert r.r == 1.01  # rounds the decimal value, not the binary double
    assert r.n == -3.0  # half away from zero


def test_holiday_rule(spark):
    days = [D(2024, 1, 1), D(2024, 7, 4), D(2024, 11, 28), D(2024, 11, 29), D(2024, 12, 24), D(2024, 11, 21), D(2024, 3, 3)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r.d: r.h for r in df.select("d", is_us_holiday("d").alias("h")).collect()}
    assert got == {
        D(2024, 1, 1): True,
        D(2024, 7, 4): True,
        D(2024, 11, 28): True,  # Thursday 22-28 Nov
        D(2024, 11, 29): True,  # Friday 23-29 Nov
        D(2024, 12, 24): True,
        D(2024, 11, 21): False,  # a Thursday, but before the 22nd
        D(2024, 3, 3): False,
    }


def test_first_n_and_nth_value_cols_ties(spark):
    df = spark.createDataFrame(
        [(1, D(2024, 1, 1), 1), (1, D(2024, 1, 1), 2), (1, D(2024, 1, 5), 3), (2, D(2024, 2, 1), 4)],
        "k int, d date, id int",
    )
    top = first_n(df, "k", ["d", "id"], 2)
    assert sorted(r.id for r in top.collect()) == [1, 2, 4]
    p = {r.k: (r.value_1, r.value_2) for r in nth_value_cols(df, "k", ["d", "id"], "d", 2).collect()}
    assert p[1] == (D(2024, 1, 1), D(2024, 1, 1))
    assert p[2] == (D(2024, 2, 1), None)


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (1, 2, "c"), (2, 5, None)], "k int, t int, v string")
    got = {r.k: (r.t, r.v) for r in latest_per_key(df, "k", "t").collect()}
    assert got == {1: (3, "b"), 2: (5, None)}


def test_discrete_summary_median(spark):
    df = spark.createDataFrame([(v,) for v in [1, 1, 2, 7, 9, 9]], "g long")
    r = discrete_summary(df, "g").first()
    assert (r.n, r.sum, r.min, r.max, r.median) == (6, 29, 1, 9, 4.5)
    odd = discrete_summary(spark.createDataFrame([(v,) for v in [3, 1, 2]], "g long"), "g").first()
    assert odd.median == 2.0


def test_discrete_summary_empty(spark):
    df = spark.createDataFrame([], "g long")
    assert discrete_summary(df, "g").count() == 0 or discrete_summary(df, "g").first().n is None


def test_surrogate_key_is_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v"))
    out = surrogate_key(df, ["v"], partitions=4).collect()
    pairs = sorted((r.v, r.row_id) for r in out)
    assert [p[1] for p in pairs] == list(range(1, 1001))


def _spine_feats(spark):
    spine = spark.createDataFrame(
        [(1, D(2024, 1, 1)), (1, D(2024, 1, 5)), (1, D(2024, 3, 2)), (2, D(2024, 1, 1)), (3, D(2024, 1, 1)), (1, D(2024, 1, 5))],
        "k int, t date",
    )
    feats = spark.createDataFrame(
        [
            (1, D(2024, 1, 5), 10.0, "x"),  # same instant as a spine row: counts
            (1, D(2024, 1, 5), 11.0, "y"),  # two features at one instant: the larger wins
            (1, D(2024, 2, 1), None, "z"),  # latest row with a NULL field stays NULL
            (2, D(2024, 6, 1), 5.0, "w"),  # key whose spine precedes all its features
        ],
        "k int, ft date, a double, b string",
    )
    return spine, feats


def test_asof_semantics(spark):
    spine, feats = _spine_feats(spark)
    out = asof_join(spine, feats, "k", "t", "ft", keep_feature_ts="ft")
    got = sorted((r.k, r.t, r.a, r.b, r.ft) for r in out.collect())
    assert got == [
        (1, D(2024, 1, 1), None, None, None),
        (1, D(2024, 1, 5), 11.0, "y", D(2024, 1, 5)),
        (1, D(2024, 1, 5), 11.0, "y", D(2024, 1, 5)),  # duplicate spine rows kept
        (1, D(2024, 3, 2), None, "z", D(2024, 2, 1)),
        (2, D(2024, 1, 1), None, None, None),
        (3, D(2024, 1, 1), None, None, None),
    ]


def test_asof_time_bucketed_equals_plain(spark):
    spine, feats = _spine_feats(spark)
    a = asof_join(spine, feats, "k", "t", "ft").collect()
    b = asof_join(spine, feats, "k", "t", "ft", time_bucket="month").collect()
    assert sorted(map(tuple, a), key=repr) == sorted(map(tuple, b), key=repr)


def test_asof_tolerance_and_static(spark):
    spine, feats = _spine_feats(spark)
    out = asof_join(spine, feats, "k", "t", "ft", tolerance="10 days")
    got = {(r.k, r.t): r.b for r in out.collect()}
    assert got[(1, D(2024, 3, 2))] is None  # 30 days old: beyond tolerance
    assert got[(1, D(2024, 1, 5))] == "y"
    static = spark.createDataFrame([(1, "gold")], "k int, tier string")
    s = asof_join(spine, static, "k", "t", None)
    assert s.count() == spine.count()


def test_asof_empty_inputs(spark):
    spine, feats = _spine_feats(spark)
    assert asof_join(spine, feats.limit(0), "k", "t", "ft").count() == spine.count()
    assert asof_join(spine.limit(0), feats, "k", "t", "ft").count() == 0


def test_compute_lag_row_vs_calendar(spark):
    df = spark.createDataFrame(
        [(1, D(2024, 1, 1), 1.0), (1, D(2024, 1, 2), 2.0), (1, D(2024, 1, 4), 4.0)], "k int, d date, v double"
    )
    row = {r.d: r.v_lag_1 for r in compute_lag(df, ["v"], [1], "d", "k").collect()}
    cal = {r.d: r.v_lag_1 for r in compute_lag(df, ["v"], [1], "d", "k", calendar=True).collect()}
    assert row[D(2024, 1, 4)] == 2.0  # previous row
    assert cal[D(2024, 1, 4)] is None  # 3 Jan is missing
    assert row[D(2024, 1, 1)] is None and cal[D(2024, 1, 2)] == 1.0


def test_rolling_null_until_full(spark):
    df = spark.createDataFrame([(1, i, float(i)) for i in range(1, 6)], "k int, t int, y double")
    out = {r.t: (r.y_lag1_roll2_mean, r.y_lag1_roll2_std) for r in rolling(df, "y", "k", "t", 1, 2, ("mean", "std")).collect()}
    assert out[1] == (None, None) and out[2] == (None, None)
    assert out[3][0] == 1.5 and abs(out[3][1] - 0.7071067811865476) < 1e-12


def test_ts_features_short_series(spark):
    df = spark.createDataFrame([(1, D(2024, 1, d), d) for d in range(1, 4)], "k int, ds date, y long")
    out = ts_features(df, "k", "ds", "y").orderBy("ds").collect()
    assert out[-1].y_lag_1 == 2 and out[-1].y_lag_28 is None and out[-1].y_lag28_roll28_mean is None
    assert out[-1].y_expanding_mean == 1.5


def test_future_stubs(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1), 5, 1.0), (1, D(2024, 1, 2), 6, 2.0)], "k int, ds date, y int, x double")
    out = future_stubs(df, "k", "ds", "y", 3, ["x"]).orderBy("ds").collect()
    assert len(out) == 5
    assert [r.ds for r in out[2:]] == [D(2024, 1, 3), D(2024, 1, 4), D(2024, 1, 5)]
    assert all(r.y is None and r.x == 2.0 for r in out[2:])


def test_key_checks_and_merge(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k int, v string")
    assert [r.k for r in check_unique(t, ["k"]).collect()] == [2]
    parent = spark.createDataFrame([(1,)], "k int")
    assert sorted(r.k for r in check_fk(t, parent, [("k", "k")]).collect()) == [2, 2]
    target = spark.createDataFrame([(1, 1.0), (2, None)], "k int, y double")
    upd = spark.createDataFrame([(2, 5.0), (3, 9.0)], "k int, y double")
    got = {r.k: r.y for r in merge_update(target, upd, ["k"], ["y"]).collect()}
    assert got == {1: 1.0, 2: 5.0}  # matched rows updated, unmatched updates ignored


def test_merge_update_rejects_duplicate_updates(spark):
    import pytest

    target = spark.createDataFrame([(1, 1.0)], "k int, y double")
    upd = spark.createDataFrame([(1, 5.0), (1, 6.0)], "k int, y double")
    with pytest.raises(Exception):
        merge_update(target, upd, ["k"], ["y"]).collect()


def test_conditional_aggregates_and_box(spark):
    from quarry.functions.scalar import count_distinct_if, growth_pct, sum_if
    from quarry.operators.relational import box_summary

    df = spark.createDataFrame([("a", 1, True), ("a", 1, True), ("a", 2, False), ("b", 3, True)], "k string, d int, h boolean")
    r = {
        x.k: (x.s, x.c)
        for x in df.groupBy("k").agg(sum_if("d", F.col("h")).alias("s"), count_distinct_if("d", F.col("h")).alias("c")).collect()
    }
    assert r == {"a": (2, 1), "b": (3, 1)}
    g = spark.range(1).select(growth_pct(F.lit(30.0), F.lit(3), F.lit(20.0), F.lit(4)).alias("g"), growth_pct(F.lit(1.0), F.lit(0), F.lit(1.0), F.lit(1)).alias("z")).first()
    assert g.g == 100.0 and g.z is None  # (10 - 5) / 5; a zero day count gives NULL, not an error
    vals = spark.createDataFrame([("x", float(v)) for v in [1, 2, 3, 4, 100]], "k string, v double")
    ex = box_summary(vals, "k", "v").first()
    ap = box_summary(vals, "k", "v", exact=False).first()
    assert (ex.min, ex.q1, ex.median, ex.q3, ex.max, ex.mean) == (1.0, 2.0, 3.0, 4.0, 100.0, 22.0)
    assert (ap.min, ap.median, ap.max, ap.n) == (1.0, 3.0, 100.0, 5)


def test_asof_hot_key_bucketed_equals_plain(spark):
    # key 0 holds a third of all spine and feature rows, spread over 3 years
    import random

    rnd = random.Random(3)
    spine = [(0 if i % 3 == 0 else rnd.randrange(1, 50), D(2020, 1, 1) + dt.timedelta(days=rnd.randrange(1100))) for i in range(900)]
    feats = [(0 if i % 3 == 0 else rnd.randrange(1, 50), D(2020, 1, 1) + dt.timedelta(days=rnd.randrange(1100)), float(i)) for i in range(600)]
    s = spark.createDataFrame(spine, "k int, t date")
    f = spark.createDataFrame(feats, "k int, ft date, v double")
    plain = asof_join(s, f, "k", "t", "ft", keep_feature_ts="m").collect()
    for bucket in ("month", "year"):
        b = asof_join(s, f, "k", "t", "ft", time_bucket=bucket, keep_feature_ts="m").collect()
        assert sorted(map(tuple, plain), key=repr) == sorted(map(tuple, b), key=repr), bucket
    assert len(plain) == 900


def test_future_stubs_actual_exog_masks_the_tail(spark):
    df = spark.createDataFrame([(1, D(2024, 1, d), d, float(d)) for d in range(1, 6)], "k int, ds date, y int, x double")
    out = future_stubs(df, "k", "ds", "y", 2, ["x"], exog="actual").orderBy("ds").collect()
    assert [r.y for r in out] == [1, 2, 3, None, None]
    assert [r.x for r in out] == [1.0, 2.0, 3.0, 4.0, 5.0]  # true future features kept


def test_asof_many_views_one_shuffle_equals_fold(spark):
    import random

    from quarry.operators.asof import asof_join_many

    rnd = random.Random(11)
    spine = spark.createDataFrame([(rnd.randrange(5), rnd.randrange(60)) for _ in range(80)], "k int, t int")
    v1 = spark.createDataFrame([(rnd.randrange(5), rnd.randrange(60), rnd.randrange(9)) for _ in range(40)], "k int, t1 int, a int")
    v2 = spark.createDataFrame([(rnd.randrange(5), rnd.randrange(60), float(rnd.randrange(9))) for _ in range(40)], "k int, t2 int, b double")
    many = asof_join_many(spine, [{"df": v1, "timestamp_col": "t1"}, {"df": v2, "timestamp_col": "t2"}], "k", "t")
    fold = asof_join(asof_join(spine, v1, "k", "t", "t1"), v2, "k", "t", "t2")
    assert sorted(map(tuple, many.collect()), key=repr) == sorted(map(tuple, fold.select(*many.columns).collect()), key=repr)
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        many.explain()
    final = out.getvalue().split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning") == 1  # one shuffle for both views

"""Sources, sinks, feature store, calendar, monitoring and streaming sinks."""

import datetime as dt
import math
import os
import tempfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions.scalar import id_string, one_hot, uniform_int, value_map
from quarry.operators.asof import asof_join
from quarry.operators.calendar import calendar, mod_label
from quarry.operators.features import feature_view, generate_dataset, latest_features, make_spine, shift_label
from quarry.operators.match import batch_search
from quarry.operators.monitor import monitor_baseline, psi, weighted_prf
from quarry.operators.relational import coverage, holdout_tail
from quarry.operators.text import explode_segments
from quarry.operators.timeseries import intervals_to_labels, scd_intervals
from quarry.sources.sinks import append_by_name, ctas, save, snapshot, with_comments
from quarry.sources.tables import list_files, read_files, seq, values

D = dt.date


def tmp(name):
    return tempfile.mkdtemp(prefix=f"quarry-test-{name}-")


def test_files_listing_and_content(spark):
    root = tmp("files")
    spark.createDataFrame([("hello",), ("world",)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/t")
    lst = list_files(spark, root, "*.txt")
    assert lst.columns == ["path", "size", "modification_time"]
    rows = list_files(spark, root).filter(F.col("path").endswith(".txt")).collect()
    assert len(rows) == 1 and rows[0].size == len("hello\nworld\n")
    txt = read_files(spark, f"{root}/t", "*.txt").collect()
    assert txt[0].text == "hello\nworld\n"


def test_save_append_ctas_snapshot_comments(spark):
    root = tmp("sinks")
    df = values(spark, [(1, "a")], "k int, v string")
    save(df, f"{root}/t")
    append_by_name(spark.createDataFrame([("b", 2)], "v string, k int"), df, f"{root}/t")
    got = sorted(tuple(r) for r in spark.read.parquet(f"{root}/t").collect())
    assert got == [(1, "a"), (2, "b")]  # matched by name, not position
    ctas(df, f"{root}/c", "replace")
    ctas(values(spark, [(9, "z")], "k int, v string"), f"{root}/c", "skip")
    assert spark.read.parquet(f"{root}/c").first().k == 1
    snap = snapshot(df, root, "ds", "v1", sources=["t"])
    assert snap.count() == 1
    with pytest.raises(Exception):
        snapshot(df, root, "ds", "v1")  # versions are immutable
    c = with_comments(df, {"k": "the key"})
    assert c.schema["k"].metadata["comment"] == "the key"
    assert seq(spark, 5, "n").count() == 5


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "n int, c string")
    r = df.select(
        id_string("CALL_", "n").alias("id"),
        value_map("c", {"A": 1, "B": -1}, 0).alias("m"),
        uniform_int(1, 6, "n").alias("u"),
    ).collect()
    assert [x.id for x in r] == ["CALL_0001", "CALL_0002", "CALL_0003"]
    assert [x.m for x in r] == [1, -1, 0]
    assert all(1 <= x.u <= 6 for x in r)
    oh = one_hot(df, "c", {"A": "is_a", "B": "is_b"}).orderBy("n").collect()
    assert [(x.is_a, x.is_b) for x in oh] == [(1, 0), (0, 1), (0, 0)]
    cov = coverage(spark.createDataFrame([(1,), (None,)], "x int"), "x").first()
    assert (cov.n_rows, cov.n_non_null) == (2, 1)


def test_calendar_and_labels(spark):
    cal = calendar(spark, "2023-01-01", "2025-12-31").collect()
    assert len(cal) == 1096 and sum(r.is_holiday for r in cal) == 21
    assert cal[0].date_key == 1 and cal[0].month == "Jan" and cal[0].fiscal_period == "FP01-2023"
    wd = calendar(spark, "2024-01-01", "2024-01-07", weekdays_only=True).count()
    assert wd == 5
    teams = spark.range(6).select(mod_label("id", ["t1", "t2", "t3"]).alias("t")).collect()
    assert [r.t for r in teams] == ["t1", "t2", "t3", "t1", "t2", "t3"]
    scd = spark.createDataFrame([("w", D(2024, 1, 1), 10), ("w", D(2024, 3, 1), 12)], "k string, eff date, cap int")
    iv = scd_intervals(scd, "k", "eff").orderBy("eff").collect()
    assert iv[0].valid_to == D(2024, 3, 1) and iv[1].valid_to is None
    lab = intervals_to_labels(spark.createDataFrame([("m", D(2024, 1, 2))], "k string, end date"), "k", "end").first()
    assert (lab.date, lab.failure) == (D(2024, 1, 2), 1)


def test_feature_store_round_trip(spark):
    root = tmp("fs")
    feats = spark.createDataFrame(
        [(1, D(2024, 1, 1), 1.0), (1, D(2024, 1, 3), 3.0), (2, D(2024, 1, 2), 5.0)], "k int, d date, f double"
    )
    static = spark.createDataFrame([(1, "gold"), (2, "silver")], "k int, tier string")
    fv = feature_view(feats, "fv", ["k"], "d", version="1").materialize(root)
    sv = feature_view(static, "sv", ["k"], None)
    assert os.path.isdir(fv.path)
    events = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 2, 5)), (1, dt.datetime(2024, 1, 3, 9)), (2, dt.datetime(2024, 1, 1, 1))], "k int, ts timestamp_ntz"
    )
    fails = spark.createDataFrame([(1, D(2024, 1, 3)), (1, D(2024, 1, 3))], "k int, date date")
    labels = shift_label(fails, "k", "date", 1, "fail_next_day")
    spine = make_spine(events, "k", "ts", "2024-01-01", "2024-01-03", labels=labels, label_col="fail_next_day")
    ds = {(r.k, r.date): (r.f, r.tier, r.fail_next_day) for r in generate_dataset(spine, [fv, sv], "date").collect()}
    assert ds == {
        (1, D(2024, 1, 2)): (1.0, "gold", 1),  # label de-duplicated, not doubled
        (1, D(2024, 1, 3)): (3.0, "gold", 0),
        (2, D(2024, 1, 1)): (None, "silver", 0),
    }
    lat = {r.k: r.f for r in latest_features(spark.createDataFrame([(1,), (2,), (3,)], "k int"), [fv]).collect()}
    assert lat == {1: 3.0, 2: 5.0, 3: None}


def test_monitoring_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0)], "y int, p int")
    r = weighted_prf(df, "y", "p").first()
    # class 0: P=2/3 R=1 F=0.8 (support 2); class 1: P=1 R=1/2 F=2/3 (support 2)
    assert math.isclose(r.precision, (2 / 3 + 1) / 2) and math.isclose(r.recall, 0.75)
    assert math.isclose(r.f1, (0.8 + 2 / 3) / 2)
    base = spark.createDataFrame([(float(i % 10),) for i in range(100)], "x double")
    assert abs(psi(base, base, "x").first().psi) < 1e-12  # PSI(x, x) = 0
    shifted = spark.createDataFrame([(float(i % 10) + 5,) for i in range(100)], "x double")
    assert psi(base, shifted, "x").first().psi > 1.0
    skewed = spark.createDataFrame([(float(i * i % 97),) for i in range(300)], "x double")
    assert abs(psi(skewed, skewed, "x", edges="quantile").first().psi) < 1e-12
    assert psi(skewed, skewed.select((F.col("x") + 40).alias("x")), "x", edges="quantile").first().psi > 1.0
    const = spark.createDataFrame([(1.0,)] * 5, "x double")
    assert psi(const, const, "x").first().psi == 0.0  # constant column: one bin
    mb = monitor_baseline(spark.createDataFrame([("w", D(2024, 1, 1), 3.0)], "k string, ds date, y double"), "k", "ds", "y", "pred").first()
    assert mb.pred == mb.y == 3.0
    tr, va = holdout_tail(spark.createDataFrame([(1, i) for i in range(10)], "k int, t int"), "k", "t", 3)
    assert sorted(r.t for r in va.collect()) == [7, 8, 9] and tr.count() == 7


def test_search_filters_and_segments(spark):
    m = spark.createDataFrame([("Microsoft Teams", "collab"), ("Microsoft Azure", "cloud")], "name string, cat string")
    q = spark.createDataFrame([("Microsoft Teams", "cloud")], "q string, want string")
    res = batch_search(q, "q", "q", m, "name", "name", k=5, filters=F.col("c_cat") == F.col("q_want"))
    assert [r.name for r in res.collect()] == ["Microsoft Azure"]
    calls = spark.createDataFrame(
        [("c1", [("S0", "hi", 0.0, 1.5), ("S1", "yo", 1.5, 2.0)]), ("c2", [])],
        "call string, seg array<struct<speaker:string,text:string,start:double,end:double>>",
    )
    rows = explode_segments(calls, "seg").collect()
    assert len(rows) == 3 and rows[-1].speaker is None
    assert explode_segments(calls, "seg", keep_empty=False).count() == 2


def test_streaming_index_and_backfill(spark):
    from quarry.streaming.stream import backfill_actuals, refresh_index

    root = tmp("stream")
    spark.createDataFrame([(1, "alpha"), (2, "beta")], "id int, t string").write.parquet(f"{root}/in/a")
    src = spark.readStream.schema("id int, t string").option("recursiveFileLookup", "true").parquet(f"{root}/in")
    q = src.writeStream.foreachBatch(refresh_index(f"{root}/idx", "id", "t")).option(
        "checkpointLocation", f"{root}/ck1"
    ).trigger(availableNow=True).start()
    q.awaitTermination()
    idx = spark.read.parquet(f"{root}/idx")
    assert set(r.gram for r in idx.filter("id = 1").collect()) == {"^al", "alp", "lph", "pha", "ha$"}
    # a re-run of the same epoch replaces its rows instead of duplicating them
    again = spark.createDataFrame([(1, "alpha"), (2, "beta")], "id int, t string")
    refresh_index(f"{root}/idx", "id", "t")(again, 0)
    assert spark.read.parquet(f"{root}/idx").filter("id = 1").count() == 5

    spark.createDataFrame([("w", D(2024, 1, 1), None), ("w", D(2024, 1, 2), None)], "k string, d date, y double").write.parquet(
        f"{root}/target/v0"
    )
    spark.createDataFrame([("w", D(2024, 1, 1), 7.0)], "k string, d date, y double").write.parquet(f"{root}/late/a")
    late = spark.readStream.schema("k string, d date, y double").option("recursiveFileLookup", "true").parquet(f"{root}/late")
    q = late.writeStream.foreachBatch(backfill_actuals(f"{root}/target", ["k", "d"], ["y"])).option(
        "checkpointLocation", f"{root}/ck2"
    ).trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r.d: r.y for r in spark.read.parquet(f"{root}/target/v1").collect()}
    assert got == {D(2024, 1, 1): 7.0, D(2024, 1, 2): None}
    # re-running epoch 0 rewrites v1 identically (no error, no change)
    backfill_actuals(f"{root}/target", ["k", "d"], ["y"])(spark.read.parquet(f"{root}/late/a"), 0)
    assert {r.d: r.y for r in spark.read.parquet(f"{root}/target/v1").collect()} == got


@settings(max_examples=15, deadline=None)
@given(
    spine=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 40)), min_size=0, max_size=25),
    feats=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 40), st.integers(0, 9)), min_size=0, max_size=25),
)
def test_asof_properties(spark, spine, feats):
    s = spark.createDataFrame(spine, "k int, t int")
    f = spark.createDataFrame(feats, "k int, ft int, v int")
    for bucket in (None,):
        out = asof_join(s, f, "k", "t", "ft", keep_feature_ts="ft").collect()
        assert len(out) == len(spine)  # exactly the spine's rows
        for r in out:
            cands = [x for x in feats if x[0] == r.k and x[1] <= r.t]
            if not cands:
                assert r.ft is None
            else:
                best = max(cands, key=lambda x: (x[1], x[2]))
                assert (r.ft, r.v) == (best[1], best[2])  # latest, never later than the spine


def test_streams_read_tables_stored_as_folders(spark):
    """Part files in several batches, a group touched by more than one: upserted, old versions kept."""
    from quarry.streaming.stream import file_stream, fresh_paths, latest_version, run_to_table, stream_daily, utc_instant

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    root = tmp("folders")
    events.repartition(5).write.parquet(f"{root}/events.parquet")
    src = file_stream(spark, f"{root}/events.parquet", events.schema, max_files=2).withColumn("event_time", utc_instant("ts"))
    agg = stream_daily(src, "event_time", ["event_type"], [F.count(F.lit(1)).alias("n")], watermark="60 days")
    out, ck = fresh_paths(spark, "test-upsert")
    done = run_to_table(agg, out, ck, ["day", "event_type"])
    done.awaitTermination()
    assert done.lastProgress["batchId"] >= 2
    got = {(r.day, r.event_type): r.n for r in latest_version(spark, out, done).collect()}
    want = events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n")).collect()
    assert got == {(r.day, r.event_type): r.n for r in want}
    assert spark.read.parquet(f"{out}/v0").agg(F.sum("n")).first()[0] < sum(got.values())


def test_search_against_stream_refreshed_index(spark):
    from quarry.operators.match import batch_search, index_from_tf
    from quarry.streaming.stream import refresh_index

    root = tmp("idx")
    corpus = spark.createDataFrame([(1, "Microsoft Teams"), (2, "Microsoft Azure"), (3, "Slack"), (4, "Zoom")], "id long, name string")
    run = refresh_index(f"{root}/tf", "id", "name")
    run(corpus.filter("id <= 2"), 0)  # two epochs, as a stream would deliver them
    run(corpus.filter("id > 2"), 1)
    run(corpus.filter("id > 2"), 1)  # a re-run epoch changes nothing
    idx = index_from_tf(spark.read.parquet(f"{root}/tf").drop("epoch"))
    q = spark.createDataFrame([("MS Teams",), ("zoom",)], "q string")
    key = lambda r: (r.q, r.rank, r.id, r.cosine_similarity)
    direct = batch_search(q, "q", "q", corpus, "id", "name", k=3)
    stored = batch_search(q, "q", "q", corpus, "id", "name", k=3, index=idx)
    assert sorted(map(key, direct.collect())) == sorted(map(key, stored.collect()))


def test_updated_document_loses_its_old_grams(spark):
    from quarry.operators.match import batch_search, index_from_tf
    from quarry.streaming.stream import refresh_index

    root = tmp("idx2")
    first = spark.createDataFrame([(1, "alpha"), (2, "beta")], "id long, name string")
    changed = spark.createDataFrame([(1, "omega")], "id long, name string")
    run = refresh_index(f"{root}/tf", "id", "name")
    run(first, 0)
    run(changed, 1)
    now = spark.createDataFrame([(1, "omega"), (2, "beta")], "id long, name string")
    q = spark.createDataFrame([("alpha",), ("omega",)], "q string")
    got = batch_search(q, "q", "q", now, "id", "name", k=2, index=index_from_tf(spark.read.parquet(f"{root}/tf")))
    assert {(r.q, r.id): r.cosine_similarity for r in got.collect()}[("omega", 1)] == 1.0
    assert not [r for r in got.collect() if r.q == "alpha" and r.id == 1 and r.cosine_similarity > 0.3]

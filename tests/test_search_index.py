"""The search index that follows a stream: equal to one built anew, whatever the batches (ST3, E1)."""

import random

import pytest

from quarry.operators.match import batch_search, build_index
from quarry.streaming.search_index import SearchIndex, segments

SCHEMA = "id long, text string, gone boolean, seq int"


def test_segments_cover_every_epoch_once():
    for fan in (2, 3, 4):
        for epoch in range(70):
            held = segments(epoch, fan)
            assert [e for a, b in held for e in range(a, b + 1)] == list(range(epoch + 1))
            levels = 0
            while fan ** (levels + 1) <= epoch + 1:
                levels += 1
            assert len(held) <= (fan - 1) * levels + fan - 1
    assert segments(-1) == [] and segments(5, 2) == [(0, 3), (4, 5)]


def grams(index):
    rows, idf, n = index
    return (
        sorted((r["id"], r["gram"], round(r["w"], 9)) for r in rows.collect()),
        sorted((r["gram"], round(r["idf"], 9)) for r in idf.collect()),
        rows.sparkSession.range(1).select(n.alias("n")).first()["n"],
    )


@pytest.mark.parametrize("fan,seed,epochs", [(2, 1, 5), (3, 2, 3)])
def test_random_changes_equal_an_index_built_anew(spark, tmp_path, fan, seed, epochs):
    rng = random.Random(seed)
    words = ["amber", "cobalt", "Amber-2", "öl", "42", "", None]
    ix = SearchIndex(spark, str(tmp_path / "ix"), "long", fan=fan, buckets=4)
    run = ix.follow("id", "text", gone="gone", order="seq")
    truth: dict[int, str | None] = {}
    for epoch in range(epochs):
        rows, seq = [], 0
        for _ in range(0 if epoch == 3 else 6):  # an empty batch is an epoch too
            i, seq = rng.randrange(8), seq + 1
            t = None if rng.random() < 0.1 else " ".join(filter(None, rng.choices(words, k=3)))
            out = rng.random() < 0.3
            rows.append((i, t, out or None, seq))
            if out:
                truth.pop(i, None)
            else:
                truth[i] = t
        rows.append((None, "no id", None, 99))
        rng.shuffle(rows)
        batch = spark.createDataFrame(rows, SCHEMA)
        run(batch, epoch)
        if epoch == 2:
            run(batch, epoch)  # a repeated micro-batch changes nothing
    last = epochs - 1
    assert {r["id"]: r["text"] for r in ix.documents(last).collect()} == truth
    now = spark.createDataFrame(list(truth.items()), "id long, text string")
    assert grams(ix.at(last)) == grams(build_index(now, "id", "text"))
    # the statistics are sums: no gram of a withdrawn document is left in them
    df = {r["gram"]: r["df"] for r in ix.frequencies(last).collect()}
    assert all(v > 0 for v in df.values()) and df.get(None, 0) == len(truth)
    before = grams(ix.at(last))
    assert ix.expire(last) and grams(ix.at(last)) == before
    assert ix.expire(last) == []


def test_a_batch_leaves_older_segments_and_untouched_buckets_alone(spark, tmp_path):
    root = tmp_path / "ix"
    ix = SearchIndex(spark, str(root), "long", fan=4, buckets=8)
    run = ix.follow("id", "text", gone="gone")
    run(spark.createDataFrame([(i, f"part {i}", False, 0) for i in range(60)], SCHEMA), 0)
    files = {p: p.stat().st_mtime_ns for p in root.rglob("*.parquet")}
    run(spark.createDataFrame([(7, "spare wheel", False, 0), (8, None, True, 0)], SCHEMA), 1)
    assert {p: p.stat().st_mtime_ns for p in files} == files
    plan = ix._counted(ix._read([(1, 1)], "docs").select("id", "__kb"), segments(0))._jdf.queryExecution().toString()
    assert "PartitionFilters: [__kb" in plan or "__kb#" in plan and "IN (" in plan
    hits = batch_search(
        spark.createDataFrame([("spare wheel",), ("part 8",)], "q string"), "q", "q", ix.documents(1), "id", "text", 1, index=ix.at(1)
    )
    got = {r["q"]: r["id"] for r in hits.collect()}
    assert got["spare wheel"] == 7 and got["part 8"] != 8


def test_an_index_without_documents(spark, tmp_path):
    ix = SearchIndex(spark, str(tmp_path / "ix"), "string")
    ix.follow("id", "text")(spark.createDataFrame([], "id string, text string"), 0)
    assert ix.documents(0).isEmpty() and grams(ix.at(0)) == ([], [], 0)
    with pytest.raises(ValueError):
        SearchIndex(spark, "x", "long", fan=1)


def test_a_large_bucket_is_written_by_several_tasks(spark, monkeypatch, tmp_path):
    from quarry.streaming import search_index

    monkeypatch.setattr(search_index, "ROWS_AT_ONCE", 50)
    index = search_index.SearchIndex(spark, str(tmp_path), "long", buckets=2)
    docs = spark.range(100).selectExpr("id", "0 AS epoch", "false AS gone", "concat('part no ', id) AS text")
    index.add(docs, 0)
    files = list(tmp_path.glob("seg-0-0/postings/__kb=0/*.parquet"))
    assert len(files) > 5 and index.documents(0).count() == 100

"""Streaming queries (ST1-ST5).  Each runs a Structured Streaming
query to completion (``availableNow``) over the driver tables and returns the
table it maintains; the oracle is the batch SQL of the same question, so the
check is "stream result == batch result"."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalar import money
from quarry.operators.match import batch_search
from quarry.operators.timeseries import compute_lag
from quarry.plans.maintenance import N_LAGS, SENSOR_COLS, _sql_lags, daily_sensor_means
from quarry.plans.matching import SQL_SEARCH_TEXTS
from quarry.plans.registry import query
from quarry.plans.text import _sql_entities, entity_columns
from quarry.sources import versioned
from quarry.sources.tables import load, table_path
from quarry.streaming.search_index import SearchIndex
from quarry.streaming.stream import (
    file_stream,
    backfill_versions,
    fresh_paths,
    incremental_map,
    latest_version,
    refresh_feature_view,
    run_to_table,
    stream_daily,
    utc_instant,
)

# ---------------------------------------------------------------------------
# ST4: daily event metrics per type from the events stream.
# ---------------------------------------------------------------------------
STREAM_DAILY_SQL = """
SELECT CAST(ts AS DATE) AS day, event_type, COUNT(*) AS n_events,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value_sum, MAX(value) AS value_max
FROM events GROUP BY 1, 2
"""


@query("stream_daily_event_metrics", STREAM_DAILY_SQL)
def stream_daily_event_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = load(spark, sf_dir, "events").schema
    src = file_stream(spark, table_path(sf_dir, "events"), schema).withColumn("event_time", utc_instant("ts"))
    agg = stream_daily(
        src,
        "event_time",
        ["event_type"],
        [
            F.count(F.lit(1)).alias("n_events"),
            F.sum(money("value")).cast("double").alias("value_sum"),
            F.max("value").alias("value_max"),
        ],
    )
    out, ckpt = fresh_paths(spark, "stream-daily")
    done = run_to_table(agg, out, ckpt, ["day", "event_type"])
    done.awaitTermination()
    return latest_version(spark, out, done).select("day", "event_type", "n_events", "value_sum", "value_max")


# ---------------------------------------------------------------------------
# ST1: documents -> typed entities, kept up to date by a stateless stream.
# ---------------------------------------------------------------------------
@query("stream_entity_extraction", _sql_entities())
def stream_entity_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = load(spark, sf_dir, "documents").schema
    src = file_stream(spark, table_path(sf_dir, "documents"), schema)

    def transform(df: DataFrame) -> DataFrame:
        return entity_columns(df.select("doc_id", "lang", "text"))

    out, ckpt = fresh_paths(spark, "stream-entities")
    incremental_map(src, transform, out, ckpt).awaitTermination()
    return spark.read.parquet(out)


# ---------------------------------------------------------------------------
# ST2: the sensor lag feature view refreshed incrementally.
#
# The events table is split into a base load and two landing files: rows of
# every third machine since 15 Jan arrive late (batch 1), everything from
# 25 Jan on arrives last (batch 2).  Each micro-batch appends to the sensor
# table and rewrites only the key-hash partitions of the machines it
# touches.  The final view must equal the lag features of the whole table.
# ---------------------------------------------------------------------------
LATE_FROM, NEW_FROM = "2024-01-15", "2024-01-25"


def _daily_lags(rows: DataFrame) -> DataFrame:
    daily = daily_sensor_means(rows)
    return compute_lag(daily, SENSOR_COLS, list(range(1, N_LAGS + 1)), "date", "machine_id").drop(*SENSOR_COLS)


@query("stream_lag_refresh", _sql_lags(False))
def stream_lag_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events")
    late = (F.col("ts") >= F.lit(LATE_FROM).cast("timestamp_ntz")) & (F.pmod(F.col("user_id"), F.lit(3)) == 0)
    new = F.col("ts") >= F.lit(NEW_FROM).cast("timestamp_ntz")
    root, _ = fresh_paths(spark, "stream-lags")
    source_path, view_path, landing = f"{root}/sensors", f"{root}/view", f"{root}/landing"
    ckpt = f"{root}/checkpoint"

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kb = F.pmod(F.xxhash64(F.col("user_id")), F.lit(buckets))

    # the sensor table: one partition per load (base = -1, then one per
    # micro-batch epoch, so a re-run batch overwrites its own) and bucket
    def land(rows: DataFrame, epoch: int) -> None:
        rows.withColumn("__kb", kb).write.mode("overwrite").partitionBy("__kb").parquet(f"{source_path}/epoch={epoch}")

    land(ev.filter(~late & ~new), -1)
    _daily_lags(spark.read.parquet(source_path)).withColumn("__kb", F.pmod(F.xxhash64("machine_id"), F.lit(buckets))).write.mode(
        "overwrite"
    ).partitionBy("__kb").parquet(view_path)

    refresher = refresh_feature_view(
        view_path,
        "machine_id",
        buckets,
        touched=lambda b: b.select(F.col("user_id").alias("machine_id")),
        recompute=lambda restrict: _daily_lags(restrict(spark.read.parquet(source_path), "user_id")),
        before=land,
    )
    # the late rows land and are taken in, then the new ones: one batch each
    for rows, name in ((ev.filter(late & ~new), "b1"), (ev.filter(new), "b2")):
        rows.write.mode("overwrite").parquet(f"{landing}/{name}")
        src = spark.readStream.schema(ev.schema).option("recursiveFileLookup", "true").parquet(landing)
        src.writeStream.foreachBatch(refresher).option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(view_path).drop("__kb")


# ---------------------------------------------------------------------------
# ST5: actuals arrive late, in three files of a stream, and fill the waiting
# forecasts of a versioned table; only the buckets a batch touches are written.
# The orders of each status are one file; orders of status P never get one.
# ---------------------------------------------------------------------------
BACKFILL_SQL = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, round(o_totalprice / 1000) * 1000 AS predicted,
       CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS actual,
       CASE WHEN o_orderstatus <> 'P' THEN abs(o_totalprice - round(o_totalprice / 1000) * 1000) END AS error
FROM orders
"""


@query("stream_late_actuals", BACKFILL_SQL)
def stream_late_actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate")
    root, ckpt = fresh_paths(spark, "stream-actuals")
    predicted = F.round(F.col("o_totalprice") / 1000) * 1000
    waiting = o.select("o_orderkey", F.to_date("o_orderdate").alias("day"), predicted.alias("predicted"), F.lit(None).cast("double").alias("actual"))
    versioned.create(waiting, root, ["o_orderkey"])
    landing, schema = f"{root}-landing", "o_orderkey long, actual double, arrived int"
    # a first, wrong reading of the finished orders is corrected in the same batch
    late = o.filter("o_orderstatus = 'F'").select("o_orderkey", F.col("o_totalprice").alias("actual"), F.lit(2).alias("arrived"))
    late = late.unionByName(late.select("o_orderkey", F.lit(0.0).alias("actual"), F.lit(1).alias("arrived")))
    rest = o.filter("o_orderstatus NOT IN ('F', 'P')").select("o_orderkey", F.col("o_totalprice").alias("actual"), F.lit(3).alias("arrived"))
    epochs = 0
    for rows, name in ((late, "a"), (rest, "b")):
        rows.write.mode("overwrite").parquet(f"{landing}/{name}")
        src = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(landing)
        done = src.writeStream.foreachBatch(backfill_versions(root, ["actual"])).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        done.awaitTermination()
        epochs = done.lastProgress["batchId"] + 1
    table = versioned.read(spark, root, epochs)
    return table.select("o_orderkey", "day", "predicted", "actual", F.abs(F.col("actual") - F.col("predicted")).alias("error"))


# ---------------------------------------------------------------------------
# ST3: a search index over the parts' descriptions follows a stream of four
# batches: all parts, the large ones with a provisional text; their full texts;
# the dear parts withdrawn; the small ones of these back again.  The oracle
# searches the parts that are left, with statistics counted over them.
# ---------------------------------------------------------------------------
LARGE, DEAR = "p_size > 25", "p_retailprice >= 990"
INDEX_SQL = SQL_SEARCH_TEXTS.format(
    corpus=f"SELECT p_partkey AS id, p_name || ' ' || p_brand || ' ' || p_type AS text FROM part WHERE NOT ({LARGE} AND {DEAR})",
    queries="SELECT DISTINCT p_name || ' ' || p_type AS text FROM part",
    k=3,
)


@query("stream_index_search", INDEX_SQL)
def stream_index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    full = F.concat_ws(" ", "p_name", "p_brand", "p_type")
    large, dear = F.expr(LARGE), F.expr(DEAR)

    def rows(df: DataFrame, text, gone: bool = False) -> DataFrame:
        return df.select("p_partkey", text.cast("string").alias("text"), F.lit(gone).alias("gone"))

    batches = [
        rows(p, F.when(large, F.col("p_brand")).otherwise(full)),
        rows(p.filter(large), full),
        rows(p.filter(dear), F.lit(None), gone=True),
        rows(p.filter(dear & ~large), full),
    ]
    root, ckpt = fresh_paths(spark, "stream-index")
    index, landing, epoch = SearchIndex(spark, root, "long"), f"{root}-landing", -1
    for i, b in enumerate(batches):
        b.write.mode("overwrite").parquet(f"{landing}/b{i}")
        src = spark.readStream.schema("p_partkey long, text string, gone boolean").option("recursiveFileLookup", "true").parquet(landing)
        w = src.writeStream.foreachBatch(index.follow("p_partkey", "text", gone="gone")).option("checkpointLocation", ckpt)
        done = w.trigger(availableNow=True).start()
        done.awaitTermination()
        epoch = done.lastProgress["batchId"]
    q = p.select(F.concat_ws(" ", "p_name", "p_type").alias("asked")).distinct()
    found = batch_search(q, "asked", "asked", index.documents(epoch), "id", "text", 3, index=index.at(epoch), blocks=64)
    return found.select("asked", "rank", F.col("id").alias("p_partkey"), "cosine_similarity", "text_match")

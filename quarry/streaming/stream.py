"""Structured Streaming operators (ST1-ST5).

The reference only refreshes derived tables periodically; here each refresh
is a streaming query over a file source:

* ST1 ``incremental_map``  - stateless transform, append sink.
* ST2 ``refresh_feature_view`` - foreachBatch: the keys touched by the batch
  are recomputed over their history (a late row changes the next lag rows
  too) and only their key-hash partitions are overwritten.
* ST3 ``refresh_index`` - foreachBatch: append n-gram rows of new documents.
* ST4 ``stream_daily`` - event-time watermark + 1-day tumbling windows.
* ST5 ``backfill_versions`` - foreachBatch + MERGE that rewrites the touched
  buckets of a versioned table (``backfill_actuals``: of a plain one, whole).

Checkpoints live under the shared folder named by ``spark.checkpoint.dir``;
a restarted query resumes from its checkpoint.  A micro-batch may run again
after a failure, so every ``foreachBatch`` writer is idempotent per epoch:
it overwrites an epoch-named partition or version, never appends blindly
(the file sink of ST1 is exactly-once by itself).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path
from quarry.sources import versioned


def utc_instant(ntz) -> Column:
    """A zone-less timestamp read as UTC, as a zoned instant.

    Built from its fields, so the result does not depend on the session time
    zone; a 1-day window over it starts at the zone-less midnight.
    """
    t = F.col(ntz) if isinstance(ntz, str) else ntz
    return F.make_timestamp(
        F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t), F.extract(F.lit("SECOND"), t), F.lit("UTC")
    )


def day_of_instant(c) -> Column:
    """UTC calendar day of an instant, independent of the session zone."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.unix_seconds(c) / 86400).cast("int"))


def file_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """Stream over a table's files; ``path`` is its folder, or one file.

    The last letter is put in brackets: as a pattern, the path may be either.
    """
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    path = path.rstrip("/")
    return r.parquet(f"{path[:-1]}[{path[-1]}]")


def _trigger(w, trigger: str | None):
    return w.trigger(availableNow=True) if trigger in (None, "availableNow") else w.trigger(processingTime=trigger)


def incremental_map(
    src: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    sink: str,
    checkpoint: str,
    trigger: str | None = None,
):
    """ST1: keep ``sink`` in step with ``src`` through a stateless transform.

    ``trigger``: None/"availableNow" processes what is there and stops;
    "20 minutes" keeps a lag target like a self-refreshing table.
    """
    w = transform(src).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
    return _trigger(w.outputMode("append"), trigger).start()


def stream_daily(
    src: DataFrame,
    instant: str,
    by: list[str],
    aggs: list[Column],
    watermark: str = "1 day",
) -> DataFrame:
    """ST4: per 1-day tumbling window (and groups), with a watermark.

    The state holds one row per (window, group); the watermark bounds how
    late a row may arrive and lets append mode finalise a day.
    """
    return (
        src.withWatermark(instant, watermark)
        .groupBy(F.window(instant, "1 day").alias("w"), *by)
        .agg(*aggs)
        .withColumn("day", day_of_instant(F.col("w.start")))
        .drop("w")
    )


def run_to_table(agg: DataFrame, out_path: str, checkpoint: str, keys: list[str], trigger: str | None = None, buckets: int = 8):
    """Keep a table in step with a streaming aggregate.

    Each micro-batch brings only the groups it touched (update mode, so the
    watermark lets old state go); they replace the same ``keys`` in version
    ``epoch`` of a table dealt to ``buckets`` (``quarry.sources.versioned``): buckets
    that a batch does not touch are not rewritten, the version before stays
    readable, and a re-run batch writes the same version again.  Read it with
    ``latest_version``.
    """

    def upsert(batch: DataFrame, epoch: int) -> None:
        changes = batch.dropDuplicates(keys)
        if epoch == 0:
            versioned.create(changes, out_path, keys, buckets)
        else:
            versioned.merge(batch.sparkSession, out_path, changes, epoch)

    w = agg.writeStream.outputMode("update").foreachBatch(upsert)
    return _trigger(w.option("checkpointLocation", checkpoint), trigger).start()


def latest_version(spark: SparkSession, out_path: str, query) -> DataFrame:
    """The table after a finished ``run_to_table`` query."""
    return versioned.read(spark, out_path, query.lastProgress["batchId"])


def refresh_feature_view(
    view_path: str,
    key: str,
    buckets: int,
    touched: Callable[[DataFrame], DataFrame],
    recompute: Callable[[Callable[[DataFrame, str], DataFrame]], DataFrame],
    before: Callable[[DataFrame, int], None] | None = None,
):
    """ST2: a ``foreachBatch`` function refreshing a view partitioned by
    ``__kb = xxhash64(key) mod buckets``.

    ``before(batch, epoch)`` lands the batch in the source table (idempotently,
    e.g. into an epoch partition); ``touched(batch)``
    gives the batch's keys (column ``key``); ``recompute(restrict)`` rebuilds
    the view rows from source rows passed through ``restrict(df, key_col)``,
    which keeps only keys of the touched buckets (whole key histories, since
    a late row changes later lags).  Only those ``__kb`` partitions are
    rewritten (dynamic partition overwrite).
    """

    def bucket(c: str) -> Column:
        return F.pmod(F.xxhash64(F.col(c)), F.lit(buckets))

    def run(batch: DataFrame, epoch: int) -> None:
        if before is not None:
            before(batch, epoch)
        hit = touched(batch).select(bucket(key).alias("__kb")).distinct()  # <= buckets rows

        def restrict(df: DataFrame, col: str) -> DataFrame:
            # a source partitioned by __kb is pruned to the touched buckets
            if "__kb" not in df.columns:
                df = df.withColumn("__kb", bucket(col))
            return df.join(F.broadcast(hit), "__kb", "left_semi").drop("__kb")

        out = recompute(restrict).withColumn("__kb", bucket(key))
        (
            out.repartition("__kb")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("__kb")
            .parquet(view_path)
        )

    return run


def refresh_index(index_path: str, id_col: str, text: str, n: int = 3):
    """ST3: ``foreachBatch`` adding (id, gram, tf) rows of new documents
    under ``index_path/epoch=<id>``.

    IDF is not stored: searches compute it from the tf table, so adding an
    epoch never rewrites older rows.
    """
    from quarry.operators.match import _gram_tf

    def run(batch: DataFrame, epoch: int) -> None:
        # one partition per epoch, overwritten: a re-run batch replaces its
        # own rows instead of appending them twice
        _gram_tf(batch, id_col, text, n).write.mode("overwrite").parquet(f"{index_path}/epoch={epoch}")

    return run


def backfill_actuals(target_root: str, keys: list[str], cols: list[str]):
    """ST5: ``foreachBatch`` applying late actuals with ``merge_update``.

    Batch ``epoch`` reads version ``v<epoch>`` and writes ``v<epoch+1>``
    (never overwriting the version being read).  A re-run batch recomputes
    the same version from the same input and overwrites it: idempotent.
    """
    from quarry.sources.sinks import merge_update

    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        cur = spark.read.parquet(f"{target_root}/v{epoch}")
        merge_update(cur, batch, keys, cols).write.mode("overwrite").parquet(f"{target_root}/v{epoch + 1}")

    return run


def backfill_versions(root: str, cols: list[str]):
    """ST5: ``foreachBatch`` setting ``cols`` of the rows that late actuals name.

    ``root`` holds a table of ``quarry.sources.versioned``; batch ``epoch`` writes version
    ``epoch + 1`` and rewrites only the buckets its keys fall into.  The
    newest actual of a key in a batch counts if the batch has a column
    ``arrived``; otherwise a key may occur once.
    """

    def run(batch: DataFrame, epoch: int) -> None:
        if "arrived" in batch.columns:
            keys = versioned.manifest(batch.sparkSession, root, epoch)[0]["keys"]
            batch = batch.groupBy(*keys).agg(F.max(F.struct("arrived", *cols)).alias("__n")).select(*keys, *[F.col(f"__n.{c}").alias(c) for c in cols])
        versioned.merge(batch.sparkSession, root, batch, epoch + 1, cols=cols)

    return run


def fresh_paths(spark: SparkSession, name: str) -> tuple[str, str]:
    """(output path, checkpoint path) under the shared checkpoint folder."""
    base = scratch_path(spark, name)
    return f"{base}/out", f"{base}/checkpoint"

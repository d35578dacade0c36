"""Exact top-k search that skips blocks of documents by their best possible score.

Documents are dealt to blocks by their heaviest gram, so a block's documents are
alike; a block keeps the greatest weight of each gram in it.  The sum of a query's
weights with these bounds every score in the block.  A query first scores the
``k`` blocks of greatest bound; blocks whose bound is below its k-th score hold
none of its top k and are left out.  What a common gram fans out to is
blocks, not documents, and documents are met by (block, gram), which parts a gram
that a third of them hold.  No cut is given, and nothing is dropped that could rank.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.operators.relational import first_n
from quarry.session import scratch_path
from quarry.sources.sinks import materialize


ROWS_AT_ONCE = 500_000  # index rows of a task; there are as many tasks as that takes


def deal(index: DataFrame, size: int) -> DataFrame:
    """The index ``(id, gram, w)`` with ``block``: the heaviest gram of the document and a part of about ``size`` documents."""
    spark = index.sparkSession
    led = index.withColumn("lead", F.max(F.struct("w", "gram")).over(Window.partitionBy("id"))["gram"])
    led = materialize(led, scratch_path(spark, "search-leads"))
    held = led.filter("gram = lead").groupBy("lead").agg(F.count(F.lit(1)).alias("n"))
    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / size))
    return led.join(held, "lead").select("id", "gram", "w", F.xxhash64("lead", part).alias("block"))


def _tasks(dealt: DataFrame) -> int:
    return -(-dealt.count() // ROWS_AT_ONCE) or 1


def bounds(qv: DataFrame, dealt: DataFrame) -> DataFrame:
    """``(qid, block, bound)``: no document of the block scores more for the query; blocks that share no gram with it are left out.

    A task has whole blocks, so a pair of query and block is summed in one task only.
    """
    most = dealt.repartition(_tasks(dealt), "block").groupBy("gram", "block").agg(F.max("w").alias("most"))
    return qv.join(most, "gram").groupBy(F.col("id").alias("qid"), "block").agg(F.sum(F.col("w") * F.col("most")).alias("bound"))


def scores(qv: DataFrame, dealt: DataFrame, chosen: DataFrame) -> DataFrame:
    """``(qid, cid, cos)`` of the documents of chosen ``(qid, block)`` that share a gram with the query.

    The index is packed tightly where it is written and is many times as large in memory, so it is never a table to broadcast.
    """
    chosen = chosen.select("qid", "block")
    open_ = dealt.join(chosen.select("block").distinct(), "block", "left_semi")
    asked = chosen.join(qv.select(F.col("id").alias("qid"), "gram", F.col("w").alias("wq")), "qid")
    tasks = _tasks(dealt)
    met = asked.repartition(tasks, "block", "gram").hint("merge").join(open_.repartition(tasks, "block", "gram").hint("merge"), ["block", "gram"])
    return met.groupBy("qid", F.col("id").alias("cid")).agg(F.sum(F.col("wq") * F.col("w")).alias("cos"))


def block_candidates(qv: DataFrame, index: DataFrame, k: int, digits: int, allowed: Callable[[DataFrame], DataFrame], size: int) -> DataFrame:
    """Scored pairs that hold every query's top k after ``allowed``, ties by the rounded score included.

    A query with fewer than ``k`` allowed documents in its first blocks opens all blocks that share a gram with it.
    """
    spark = qv.sparkSession
    dealt = materialize(deal(index, size), scratch_path(spark, "search-blocks"))
    qv = materialize(qv, scratch_path(spark, "search-queries"))
    bound = materialize(bounds(qv, dealt), scratch_path(spark, "search-bounds"))
    first = first_n(bound, "qid", [F.col("bound").desc(), F.col("block")], k, rank_col="__i").select("qid", "block")
    seen = materialize(allowed(scores(qv, dealt, first)), scratch_path(spark, "search-first"))
    rounded = seen.select("qid", "cid", F.round(F.col("cos").cast("decimal(38,12)"), digits).cast("double").alias("s"))
    best = first_n(rounded, "qid", [F.col("s").desc(), F.col("cid")], k, rank_col="__i")
    kth = best.groupBy("qid").agg(F.min("s").alias("kth"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k)
    # a score that rounds to the k-th may rank before it by its id; sums of doubles differ in their last digits
    room = F.lit(10.0**-digits + 1e-9)
    left = bound.join(kth, "qid", "left").filter(F.col("kth").isNull() | (F.col("bound") >= F.col("kth") - room))
    left = left.join(first, ["qid", "block"], "left_anti")
    return seen.unionByName(allowed(scores(qv, dealt, left)))

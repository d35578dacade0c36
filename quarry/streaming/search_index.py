"""ST3, E1: a search index that follows a stream of new, changed and withdrawn documents.

A micro-batch becomes one segment of three tables and changes none before it:

    seg-<first>-<last>/docs      (id, epoch, gone, text, __kb)  newest row of each document named; gone = withdrawn
    seg-<first>-<last>/postings  (id, epoch, gram, tf, __kb)    grams of the documents that are not gone
    seg-<first>-<last>/stats     (gram, df)                     change of each gram's document frequency;
                                                                the row of a null gram: of the number of documents

Statistics are sums.  A batch reads the grams that its documents had before, from
the buckets (hash of the id) that it touches only, and takes them off; so nothing
is ever counted over the whole index again.  Readers sum the changes and keep of each document
the rows of its newest epoch.

``fan`` neighbouring segments of one size are merged into one when the last of them is written;
so after epoch E there are at most (fan - 1) * log_fan(E + 1) + 1 segments, a row
is rewritten log_fan(E + 1) times, and E alone tells which segments hold the
index (``segments``): there is no list to keep.  A merge that reaches back to
epoch 0 forgets withdrawn documents.  Each epoch overwrites its own folders only,
so a repeated micro-batch changes nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.match import _gram_tf, _unit
from quarry.sources.versioned import _files

FAN = 4
BUCKETS = 16
ROWS_AT_ONCE = 250_000  # of a bucket that one task writes
STATS = "gram string, df long"


def segments(epoch: int, fan: int = FAN) -> list[tuple[int, int]]:
    """(first, last) epochs of the segments that hold the index after ``epoch``, oldest first."""
    out, first = [], 0
    while first <= epoch:
        size = 1
        while first % (size * fan) == 0 and first + size * fan <= epoch + 1:
            size *= fan
        out.append((first, first + size - 1))
        first += size
    return out


class SearchIndex:
    """The index under ``root``, of documents whose id has type ``id_type``, over character runs of length ``n``."""

    def __init__(self, spark: SparkSession, root: str, id_type: str, n: int = 3, fan: int = FAN, buckets: int = BUCKETS):
        if fan < 2:
            raise ValueError("fan: at least two segments are merged")
        self.spark, self.root, self.n, self.fan, self.buckets = spark, root, n, fan, buckets
        self.schemas = {
            "docs": f"id {id_type}, epoch int, gone boolean, text string, __kb int",
            "postings": f"id {id_type}, epoch int, gram string, tf long, __kb int",
            "stats": STATS,
        }

    # ---------------------------------------------------------------- segments

    def _path(self, segment: tuple[int, int], table: str) -> str:
        return f"{self.root}/seg-{segment[0]}-{segment[1]}/{table}"

    def _read(self, held: list[tuple[int, int]], table: str) -> DataFrame:
        schema = self.schemas[table]
        parts = [self.spark.read.schema(schema).parquet(self._path(s, table)) for s in held]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schema)

    def _write(self, rows: DataFrame, segment: tuple[int, int], table: str) -> None:
        path = self._path(segment, table)
        if table == "stats":
            rows.write.mode("overwrite").parquet(path)
        else:  # buckets are even: a document is in one, and its rows are bounded by its text
            # a task sorts what it writes, so a bucket of many rows is written by several
            n = rows.count()
            pieces = -(-n // (self.buckets * ROWS_AT_ONCE)) or 1
            piece = F.pmod(F.xxhash64("id", F.lit("piece")), F.lit(pieces))
            dealt = rows.repartition(self.buckets * pieces, "__kb", piece) if pieces > 1 else rows.repartition("__kb")
            dealt.write.mode("overwrite").partitionBy("__kb").parquet(path)

    def _newest(self, held: list[tuple[int, int]], keep=None) -> DataFrame:
        """``(id, epoch, gone, text, __kb)`` of each document's newest epoch; ``keep`` restricts the rows read."""
        d = self._read(held, "docs")
        if keep is not None:
            d = keep(d)
        return d.groupBy("id", "__kb").agg(F.max("epoch").alias("epoch"), F.max_by("gone", "epoch").alias("gone"), F.max_by("text", "epoch").alias("text"))

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("__kb", F.pmod(F.xxhash64("id"), F.lit(self.buckets)).cast("int"))

    # ------------------------------------------------------------------ writing

    def follow(self, id_col: str, text: str, gone: str | None = None, order: str | None = None):
        """``foreachBatch`` that takes a batch's documents into the index.

        ``gone``: a boolean column, true where a document is withdrawn (null: it is not).
        ``order``: of several rows of one document in a batch the one with the
        greatest value counts (then one that is not gone, then the greatest text);
        a batch always comes after the batches before it.
        Rows without an id are no documents; a null text is one without grams.
        """

        def run(batch: DataFrame, epoch: int) -> None:
            rows = batch.filter(F.col(id_col).isNotNull()).select(
                F.col(id_col).alias("id"),
                (F.col(order) if order else F.lit(0)).alias("__o"),
                (F.coalesce(F.col(gone), F.lit(False)) if gone else F.lit(False)).alias("gone"),
                F.col(text).alias("text"),
            )
            last = rows.groupBy("id").agg(F.max(F.struct("__o", ~F.col("gone"), "text")).alias("r"))
            docs = last.select("id", F.lit(epoch).alias("epoch"), (~F.col("r.col2")).alias("gone"), F.col("r.text").alias("text"))
            docs = docs.withColumn("text", F.when(~F.col("gone"), F.col("text")))
            self.add(docs, epoch)

        return run

    def add(self, docs: DataFrame, epoch: int) -> None:
        """Write the segment of ``epoch``: ``docs (id, epoch, gone, text)`` with unique ids; then merge what it completes."""
        own = (epoch, epoch)
        self._write(self._bucketed(docs), own, "docs")
        docs = self._read([own], "docs")
        tf = _gram_tf(docs.filter("NOT gone"), "id", "text", self.n)
        self._write(self._bucketed(tf.withColumn("epoch", F.lit(epoch))), own, "postings")
        new = self._read([own], "postings").select("gram", F.lit(1).alias("c"))
        new = new.unionByName(docs.filter("NOT gone").select(F.lit(None).cast("string").alias("gram"), F.lit(1).alias("c")))
        old = self._counted(docs.select("id", "__kb"), segments(epoch - 1, self.fan))
        change = new.unionByName(old).groupBy("gram").agg(F.sum("c").cast("long").alias("df"))
        self._write(change.filter("df <> 0"), own, "stats")
        size = self.fan
        while (epoch + 1) % size == 0:
            self._merge(epoch + 1 - size, epoch, size // self.fan)
            size *= self.fan

    def _counted(self, ids: DataFrame, held: list[tuple[int, int]]) -> DataFrame:
        """``(gram, c = -1)`` for each gram, and a null one, of what the documents were before."""
        touched = [r["__kb"] for r in ids.select("__kb").distinct().collect()]  # at most as many as buckets

        def keep(d: DataFrame) -> DataFrame:
            return d.filter(F.col("__kb").isin(touched)).join(ids, ["id", "__kb"], "left_semi")

        was = self._newest(held, keep).filter("NOT gone").select("id", "epoch")
        grams = keep(self._read(held, "postings")).join(was, ["id", "epoch"], "left_semi").select("gram")
        return grams.unionByName(was.select(F.lit(None).cast("string").alias("gram"))).withColumn("c", F.lit(-1))

    def _merge(self, first: int, last: int, size: int) -> None:
        parts = [(a, a + size - 1) for a in range(first, last + 1, size)]
        whole = (first, last)
        docs = self._newest(parts)
        # what is gone must be known while an older segment may still hold it
        self._write(docs.filter("NOT gone") if first == 0 else docs, whole, "docs")
        live = self._read([whole], "docs").filter("NOT gone").select("id", "epoch")
        self._write(self._read(parts, "postings").join(live, ["id", "epoch"], "left_semi"), whole, "postings")
        stats = self._read(parts, "stats").groupBy("gram").agg(F.sum("df").alias("df"))
        self._write(stats.filter("df <> 0"), whole, "stats")

    def expire(self, epoch: int) -> list[str]:
        """Remove the segments that the index after ``epoch`` and later ones do not use; their names."""
        used = {f"seg-{a}-{b}" for a, b in segments(epoch, self.fan)}
        fs, top = _files(self.spark, self.root)
        gone = []
        for s in fs.listStatus(top):
            name = s.getPath().getName()
            if name.startswith("seg-") and name not in used and int(name.split("-")[2]) <= epoch:
                fs.delete(s.getPath(), True)
                gone.append(name)
        return sorted(gone)

    # ------------------------------------------------------------------ reading

    def documents(self, epoch: int) -> DataFrame:
        """``(id, text)`` of the documents after ``epoch``."""
        return self._newest(segments(epoch, self.fan)).filter("NOT gone").select("id", "text")

    def frequencies(self, epoch: int) -> DataFrame:
        """``(gram, df)``; the row of a null gram holds the number of documents, if there are any."""
        return self._read(segments(epoch, self.fan), "stats").groupBy("gram").agg(F.sum("df").alias("df")).filter("df <> 0")

    def at(self, epoch: int) -> tuple[DataFrame, DataFrame, object]:
        """``(index, idf, n_docs)`` after ``epoch``, for ``batch_search(index=...)``: equal to ``build_index`` of ``documents``."""
        held = segments(epoch, self.fan)
        live = self._newest(held).filter("NOT gone").select("id", "epoch")
        tf = self._read(held, "postings").join(live, ["id", "epoch"], "left_semi").select("id", "gram", "tf")
        stats = self.frequencies(epoch)
        n_docs = stats.agg(F.coalesce(F.sum(F.when(F.col("gram").isNull(), F.col("df"))), F.lit(0))).scalar()
        idf = stats.filter("gram IS NOT NULL").select("gram", (F.log((n_docs + 1).cast("double") / (F.col("df") + 1)) + 1).alias("idf"))
        w = tf.join(idf, "gram").select("id", "gram", (F.col("tf") * F.col("idf")).alias("w"))
        return _unit(w), idf, n_docs

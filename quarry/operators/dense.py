"""Exact dense top-k by pivot cells.

A bounded number of corpus vectors serve as pivots; every vector belongs to
the cell of its nearest pivot.  The angle between vectors obeys the triangle
inequality, so a vector of a cell can be no closer to a query than the
query's angle to the pivot less the cell's widest angle.  Round one searches
each query's own cell and yields a k-th best score; round two visits only the
cells that this score does not rule out.  Cells are dealt to parts of bounded
size, and both rounds stream queries past them; a query is sent once to a part,
whatever number of its cells are open.  Nothing but the pivots and one row per
cell goes through the driver.

Vectors without structure leave all cells open: then all pairs are compared, in
squares of rows and queries of bounded size, and what is shuffled grows with
the rows times the side of the squares.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.relational import first_n
from quarry.session import scratch_path
from quarry.sources.sinks import materialize

SLACK = 1e-9
SLICE = 1 << 20  # numbers that a slice of visits, products or scores holds
QUERIES = 256  # that pass a part at a time


def _unit_rows(vectors) -> np.ndarray:
    m = np.stack([np.asarray(v, np.float64) for v in vectors])
    return m / np.sqrt((m * m).sum(1))[:, None]


def _usable(df: DataFrame, id_col: str, vec_col: str, name: str) -> DataFrame:
    """(name, v): vectors with a direction; null, zero and non-finite ones have none."""
    v = F.col(vec_col).cast("array<double>")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    x = df.select(F.col(id_col).alias(name), v.alias("v")).withColumn("__n", norm)
    return x.filter((F.col("__n") > 0) & (F.col("__n") < float("inf"))).drop("__n")


def choose_pivots(corpus: DataFrame, pivots: int) -> np.ndarray:
    """Directions of the ``pivots`` corpus vectors with the smallest hash of their id."""
    rows = corpus.orderBy(F.xxhash64("cid"), "cid").select("v").limit(pivots).collect()
    return np.unique(_unit_rows([r["v"] for r in rows]), axis=0) if rows else np.zeros((0, 0))


def assign_cells(corpus: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(cid, v, cell, angle) with the number of the nearest pivot and the angle to it."""
    cid = corpus.schema["cid"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                cos = _unit_rows(f["v"]) @ pivots.T
                cell = cos.argmax(1)
                f["cell"] = cell.astype(np.int32)
                f["angle"] = np.arccos(np.clip(cos[np.arange(len(f)), cell], -1, 1))
                yield f

    return corpus.mapInPandas(run, f"cid {cid}, v array<double>, cell int, angle double")


def _open_cells(cos: np.ndarray, widest: np.ndarray, floor: np.ndarray) -> np.ndarray:
    """Which cells may hold a row that reaches ``floor``, from the queries' cosines with the pivots."""
    closest = np.maximum(0.0, np.arccos(np.clip(cos, -1, 1)) - widest)
    return np.cos(np.minimum(closest, np.pi)) >= floor[:, None] - SLACK


def cell_visits(queries: DataFrame, pivots: np.ndarray, reach: dict[int, float], home: bool, place: dict[int, range] | None = None) -> DataFrame:
    """(qid, v, cell, floor) rows: the own cell of each query, or all others that ``floor`` leaves open.

    With ``place``, the parts of each cell, the queries carry their own ``cell`` and the rows are
    (qid, v, cell, floor, part): one for each part that holds an open cell.  Rows leave in slices of
    bounded size, however many a query has.
    """
    qid = queries.schema["qid"].dataType.simpleString()
    cells = np.array(sorted(reach), np.int32)
    widest = np.array([reach[c] for c in cells.tolist()])
    held = None
    if place is not None:
        held = np.zeros((len(cells), max(r.stop for r in place.values())), bool)
        for i, c in enumerate(cells.tolist()):
            held[i, place[c].start : place[c].stop] = True

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if not len(f):
                continue
            cos = _unit_rows(f["v"]) @ pivots[cells].T
            own = cos.argmax(1) if held is None else np.searchsorted(cells, f["cell"].to_numpy())
            if home:
                rows, at = np.arange(len(f)), own
            else:
                open_ = _open_cells(cos, widest, f["floor"].to_numpy())
                open_[np.arange(len(f)), own] = False
                rows, at = np.nonzero(open_ if held is None else open_.astype(np.float32) @ held > 0)
            step = max(1, SLICE // pivots.shape[1])
            for lo in range(0, len(rows), step):
                out = f.iloc[rows[lo : lo + step]][["qid", "v", "floor"]].copy()
                out["cell"] = cells[(at if held is None else own[rows])[lo : lo + step]]
                if held is not None:
                    out["part"] = at[lo : lo + step].astype(np.int32)
                yield out[names]

    schema = f"qid {qid}, v array<double>, cell int, floor double" + ("" if held is None else ", part int")
    names = ["qid", "v", "cell", "floor"] + ([] if held is None else ["part"])
    return queries.mapInPandas(run, schema)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows in one fixed order of additions: equal rows have equal products."""
    x = a * b
    while x.shape[1] > 1:
        half = x.shape[1] // 2
        x = np.concatenate([x[:, :half] + x[:, half : 2 * half], x[:, 2 * half :]], 1)
    return x[:, 0]


class _Part:
    """The rows of one part, by cell and id.

    Of equal rows no more are held than can be among a query's ``k``: ``k`` of each id, and of these
    the first ``2k``, as a query leaves out only what has its own id.
    """

    def __init__(self, members: pd.DataFrame, k: int, exclude_self: bool):
        m = members.sort_values(["cell", "cid"], kind="stable")
        rows = _unit_rows(m["v"])
        same = np.unique(np.ascontiguousarray(rows).view(np.dtype((np.void, rows.shape[1] * 8))).ravel(), return_inverse=True)[1]
        m = m.assign(same=same, at=np.arange(len(m)))
        m = m[m.groupby(["same", "cid"]).cumcount() < k]
        m = m[m.groupby("same").cumcount() < 2 * k]
        self.rows, self.ids, self.k, self.exclude = rows[m["at"].to_numpy()], m["cid"].to_numpy(), k, exclude_self
        self.place = np.empty(len(m), np.int64)  # of the ids in their order
        self.place[np.argsort(self.ids, kind="stable")] = np.arange(len(m))
        cell = m["cell"].to_numpy()
        cuts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        self.cells, self.cuts = cell[cuts], np.append(cuts, len(m))

    def search(self, names: np.ndarray, queries: np.ndarray, floor: np.ndarray, open_: np.ndarray) -> pd.DataFrame:
        """(qid, cid, score): the k best of each query in the cells open to it, but for what cannot reach ``floor``."""
        bar, kept = floor.copy(), (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        step = max(1, SLICE // max(1, len(queries)))
        for c in range(len(self.cells)):
            asked = np.flatnonzero(open_[:, c])
            for lo in range(self.cuts[c], self.cuts[c + 1], step) if len(asked) else ():
                hi = min(lo + step, self.cuts[c + 1])
                sim = queries[asked] @ self.rows[lo:hi].T
                hit = sim >= bar[asked][:, None] - SLACK
                if hi - lo > self.k and np.count_nonzero(hit) > 8 * self.k * len(asked):
                    if self.exclude:
                        sim[names[asked][:, None] == self.ids[None, lo:hi]] = -np.inf
                    bar[asked] = np.maximum(bar[asked], np.partition(sim, -self.k, axis=1)[:, -self.k])
                    hit = sim >= bar[asked][:, None] - SLACK
                q, r = np.nonzero(hit)
                if len(q):
                    kept = self._best(names, queries, bar, kept, asked[q], r + lo)
        q, r, score = kept
        return pd.DataFrame({"qid": names[q], "cid": self.ids[r], "score": score})

    def _best(self, names, queries, bar, kept, q, r):
        """The k best of each query among ``kept`` and the rows ``r`` of queries ``q``; raises ``bar`` to the k-th."""
        other = names[q] != self.ids[r] if self.exclude else np.ones(len(q), bool)
        q, r = q[other], r[other]
        step = max(1, SLICE // queries.shape[1])
        score = [_products(queries[q[i : i + step]], self.rows[r[i : i + step]]) for i in range(0, len(q), step)]
        q, r, s = np.append(kept[0], q), np.append(kept[1], r), np.concatenate([kept[2], *score])
        order = np.lexsort((self.place[r], -s, q))
        q, r, s = q[order], r[order], s[order]
        nth = np.arange(len(q)) - np.searchsorted(q, q)
        last = nth == self.k - 1
        bar[q[last]] = np.maximum(bar[q[last]], s[last])
        return q[nth < self.k], r[nth < self.k], s[nth < self.k]


def _search(visits: DataFrame, rows: DataFrame, pivots: np.ndarray, reach: dict[int, float], home: bool, k: int, exclude_self: bool, sheets: int) -> DataFrame:
    """(qid, cid, score): at most k rows per visit ``(qid, v, cell, floor, part)``, from ``rows (cid, v, cell, part)``.

    A task holds the rows of one part and streams one of the ``sheets`` of the queries past them; it
    searches the own cell of a query, or all others open to it.
    """
    qid, cid = (d.schema[c].dataType.simpleString() for d, c in ((visits, "qid"), (rows, "cid")))
    every = F.explode(F.sequence(F.lit(0), F.lit(sheets - 1)))
    left = rows.select("part", every.alias("sheet"), F.lit(0).alias("kind"), F.lit(None).cast(qid).alias("qid"), "cid", "cell", "v", F.lit(0.0).alias("floor"))
    sheet = F.pmod(F.xxhash64("qid"), F.lit(sheets)).cast("int")
    right = visits.select("part", sheet.alias("sheet"), F.lit(1).alias("kind"), "qid", F.lit(None).cast(cid).alias("cid"), "cell", "v", "floor")
    widest = np.array([reach.get(c, 0.0) for c in range(len(pivots))])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, part = None, [], None
        for f in frames:
            for (number, sheet, kind), g in f.groupby(["part", "sheet", "kind"], sort=False):
                if (number, sheet) != key:
                    key, held, part = (number, sheet), [], None
                if kind == 0:
                    held.append(g[["cid", "cell", "v"]])
                    continue
                if part is None and held:
                    part, held = _Part(pd.concat(held), k, exclude_self), []
                if part is None:
                    continue
                for lo in range(0, len(g), QUERIES):
                    some = g.iloc[lo : lo + QUERIES]
                    queries, floor = _unit_rows(some["v"]), some["floor"].to_numpy(float)
                    open_ = some["cell"].to_numpy()[:, None] == part.cells[None, :]
                    if not home:
                        open_ = ~open_ & _open_cells(queries @ pivots[part.cells].T, widest[part.cells], floor)
                    yield part.search(some["qid"].to_numpy(), queries, floor, open_)

    dealt = left.unionByName(right).repartition("part", "sheet").sortWithinPartitions("part", "sheet", "kind")
    return dealt.mapInPandas(run, f"qid {qid}, cid {cid}, score double")


def deal_cells(sizes: dict[int, int], part_rows: int) -> dict[int, range]:
    """The parts of each cell: a large cell has parts of its own, small ones share a part of about ``part_rows`` rows."""
    place, parts, shared, load = {}, 0, None, 0
    for cell, n in sorted(sizes.items()):
        if n >= part_rows:
            place[cell] = range(parts, parts - (-n // part_rows))
            parts = place[cell].stop
            continue
        if shared is None or load + n > part_rows:
            shared, load, parts = parts, 0, parts + 1
        place[cell], load = range(shared, shared + 1), load + n
    return place


def dense_topk(
    queries: DataFrame,
    q_id: str,
    q_vec: str,
    corpus: DataFrame,
    c_id: str,
    c_vec: str,
    k: int,
    exclude_self: bool = False,
    digits: int = 6,
    pivots: int | None = None,
    part_rows: int = 32_768,
) -> DataFrame:
    """The k nearest corpus vectors by cosine, exactly; ties to the smaller corpus id.

    Output ``(q_id, rank, neighbor_c_id, cosine_similarity)``.  Ids keep their
    type.  Vectors without a direction (null, zero, not finite) take no part.
    Without a number of ``pivots``, one per 500 corpus vectors, 4 to 256.
    """
    c = _usable(corpus, c_id, c_vec, "cid")
    q = _usable(queries, q_id, q_vec, "qid")
    centres = choose_pivots(c, pivots or min(256, max(4, c.count() // 500)))
    if not len(centres):
        empty = q.limit(0).select(F.col("qid").alias(q_id), F.lit(1).alias("rank"))
        return empty.crossJoin(c.limit(0).select(F.col("cid").alias(f"neighbor_{c_id}"), F.lit(0.0).alias("cosine_similarity")))
    spark = corpus.sparkSession
    # written once: both rounds must see a row, and a query, in the same cell
    cells = materialize(assign_cells(c, centres), scratch_path(spark, "dense-cells"))
    shape = cells.groupBy("cell").agg(F.max("angle").alias("widest"), F.count(F.lit(1)).alias("n")).collect()  # one row per pivot
    reach = {r["cell"]: r["widest"] for r in shape}
    asked = materialize(cell_visits(q.withColumn("floor", F.lit(-2.0)), centres, reach, home=True), scratch_path(spark, "dense-queries"))
    # tasks are squares of rows and queries: their number grows with both, what each holds does not
    side = -(-sum(r["n"] for r in shape) // math.ceil(math.sqrt(4 * spark.sparkContext.defaultParallelism)))
    part_rows = max(1, min(part_rows, (1 << 22) // centres.shape[1], max(2048, side)))
    place = deal_cells({r["cell"]: r["n"] for r in shape}, part_rows)
    sheets = max(1, -(-asked.count() // part_rows))
    parts = F.broadcast(spark.createDataFrame([(cell, r.start, len(r)) for cell, r in place.items()], "cell int, first int, parts int"))
    rows = cells.join(parts, "cell").select("cid", "v", "cell", (F.col("first") + F.pmod(F.xxhash64("cid", "v"), F.col("parts"))).cast("int").alias("part"))
    own = asked.join(parts, "cell").withColumn("part", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("parts") - 1))).drop("first", "parts")
    near = first_n(_search(own, rows, centres, reach, True, k, exclude_self, 1), "qid", [F.desc("score"), "cid"], k)
    near = materialize(near, scratch_path(spark, "dense-near"))
    floors = near.groupBy("qid").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(-2.0).alias("__f"))
    pending = asked.join(floors, "qid", "left").withColumn("floor", F.coalesce("__f", "floor")).select("qid", "v", "cell", "floor")
    far = _search(cell_visits(pending, centres, reach, False, place), rows, centres, reach, False, k, exclude_self, sheets)
    ranked = first_n(near.unionByName(far), "qid", [F.desc("score"), "cid"], k, rank_col="rank")
    return ranked.select(
        F.col("qid").alias(q_id),
        "rank",
        F.col("cid").alias(f"neighbor_{c_id}"),
        F.round(F.col("score").cast("decimal(38,12)"), digits).cast("double").alias("cosine_similarity"),
    )

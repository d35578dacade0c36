"""Mixing sources to target weights (operator 7): iterative proportional fitting.

Token totals of the cells source x language x topic are raked to the target
shares of each dimension in turn until all hold; a cell never gets more
tokens than it has.  A document's probability is its cell's raked total over
its real one, and documents are drawn independently with these calibrated
probabilities by a seeded hash of their id.

Every source found has a target of its own: those that the targets do not list
share what the listed ones leave, in equal parts.  Languages and topics that
are not listed share what the listed ones leave as one value.  Only the cells'
totals reach the driver; their number is that of the sources found times the
listed values of the other dimensions, at most.

A value with fewer tokens than its target gives all it has, and the others of
its dimension share the difference in proportion; ``margins`` reports what was
asked of every value and what it gives.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REST = "(rest)"

# Dimensions whose unlisted values are found in the data and get equal targets, each its own.
OPEN = ("source",)

# Production targets: shares of all tokens drawn.
TARGETS = {
    "source": {"src0": 0.10},
    "lang": {"en": 0.50, "de": 0.20, "fr": 0.18, "es": 0.10},
    "topic": {"prose": 0.50, "long": 0.30, "short": 0.05, "listing": 0.05, "record": 0.10},
}


@dataclass(frozen=True)
class Params:
    """Production parameters: tokens drawn as a share of all, and when raking ends."""

    budget: float = 0.4
    rounds: int = 500
    tolerance: float = 1e-9
    seed: int = 37


def tokens(text: str) -> Column:
    """Number of words; none for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def topic(text: str) -> Column:
    """What kind of text it is: a listing, a record, or prose by length (null: short)."""
    t = F.coalesce(F.col(text), F.lit(""))
    return (
        F.when(F.contains(t, F.lit(" | ")), "listing")
        .when(t.rlike("[0-9]{4}"), "record")
        .when(F.char_length(t) < 300, "short")
        .when(F.char_length(t) >= 6000, "long")
        .otherwise("prose")
    )


def reachable(share: np.ndarray, tokens: np.ndarray, budget: float) -> np.ndarray:
    """Tokens wanted of each value: ``share`` of ``budget``, no more than there are; what is lacking goes to the others in proportion."""
    want, free = np.zeros(len(share)), (share > 0) & (tokens > 0)
    while free.any():
        left = budget - want[~free].sum()
        part = np.where(free, share, 0) / share[free].sum() * left
        short = free & (part > tokens)
        if not short.any():
            return np.where(free, part, want)
        want[short] = tokens[short]
        free &= ~short
    return want


def rake_cells(totals: np.ndarray, codes: list[np.ndarray], shares: list[np.ndarray], budget: float, p: Params = Params()) -> np.ndarray:
    """``rake`` for a list of cells; ``codes`` has the number of each cell's value in every dimension."""
    wants = [reachable(share, np.bincount(code, totals, len(share)), budget) for code, share in zip(codes, shares)]
    raked = totals * min(1.0, budget / max(totals.sum(), 1e-300))
    for _ in range(p.rounds):
        before = raked
        for code, want in zip(codes, wants):
            have = np.bincount(code, raked, len(want))
            raked = raked * np.divide(want, have, out=np.ones_like(want), where=have > 0)[code]
        raked = np.minimum(raked, totals)
        if np.abs(raked - before).max(initial=0) <= p.tolerance * max(budget, 1.0):
            break
    return raked


def rake(totals: np.ndarray, shares: list[np.ndarray], budget: float, p: Params = Params()) -> np.ndarray:
    """Raked totals: margins in proportion ``shares`` of ``budget`` tokens, no cell above its total.

    What a value lacks, or all of its share if it has no tokens, goes to the
    others in proportion.  Where the caps of single cells make the targets
    unreachable, the raked totals are the last round's.
    """
    codes = list(np.indices(totals.shape).reshape(totals.ndim, -1))
    return rake_cells(totals.ravel(), codes, shares, budget, p).reshape(totals.shape)


@dataclass
class Plan:
    """Cells found: value numbers in each dimension, tokens and raked tokens; values and target shares of each dimension."""

    codes: list[np.ndarray]
    totals: np.ndarray
    raked: np.ndarray
    values: list[list[str]]
    shares: list[np.ndarray]


def _keys(dims: dict[str, Column], targets: dict[str, dict[str, float]]) -> dict[str, Column]:
    """The cell value of each dimension: every value found of an open one, else the listed ones; null is of the rest."""
    return {d: F.coalesce(F.col(d).cast("string"), F.lit(REST)) if d in OPEN else F.when(F.col(d).isin(sorted(targets[d])), F.col(d)).otherwise(REST) for d in dims}


def plan(keyed: DataFrame, names: list[str], targets: list[dict[str, float]], params: Params) -> Plan:
    """Rake the cells of ``names``: one aggregate, then a list of cells on the driver."""
    cells = keyed.groupBy(*names).agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens")).toArrow()
    totals = cells.column("tokens").to_numpy().astype(float)
    codes, values, shares = [], [], []
    for n, target in zip(names, targets):
        column = cells.column(n).to_pylist()
        found = sorted(set(column) | set(target))
        number = {v: i for i, v in enumerate(found)}
        code = np.array([number[v] for v in column], np.int64)
        filled = np.bincount(code, totals, len(found)) > 0
        # equal parts of what is left for each unlisted value that has tokens
        rest = [v for v in found if v not in target and filled[number[v]]]
        left = max(0.0, 1 - sum(target.values())) / max(1, len(rest))
        share = np.zeros(len(found))
        share[[number[v] for v in rest]] = left
        share[[number[v] for v in target]] = list(target.values())
        codes.append(code)
        values.append(found)
        shares.append(share)
    return Plan(codes, totals, rake_cells(totals, codes, shares, params.budget * totals.sum(), params), values, shares)


def _keyed(docs: DataFrame, dims: dict[str, Column], size: Column, id_col: str, targets: dict[str, dict[str, float]]) -> DataFrame:
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("__id"), size.alias("n_tokens"), *[value.alias(d) for d, value in dims.items()])
    return keyed.withColumns({f"__{d}": key for d, key in _keys(dims, targets).items()})


def calibrate(docs: DataFrame, dims: dict[str, Column], size: Column, id_col: str = "doc_id", targets: dict[str, dict[str, float]] | None = None, params: Params = Params()) -> DataFrame:
    """(row, dims..., n_tokens, probability, selected) for every row of ``docs``.

    ``row`` is the input row as a struct, so its column names cannot clash.
    Null values of a dimension belong to its rest, which in an open dimension
    is one more value.  A row without id is drawn by the hash of null; rows
    with one id are drawn alike; texts without tokens follow their cell
    (probability one where a cell has none).
    """
    targets = targets or TARGETS
    names = [f"__{d}" for d in dims]
    keyed = _keyed(docs, dims, size, id_col, targets)
    found = plan(keyed, names, [targets[d] for d in dims], params)
    chance = np.divide(found.raked, found.totals, out=np.ones_like(found.totals), where=found.totals > 0)
    columns = [pa.array(values, pa.string()).take(pa.array(code)) for values, code in zip(found.values, found.codes)]
    table = docs.sparkSession.createDataFrame(pa.table([*columns, pa.array(chance, pa.float64())], names=[*names, "probability"]))
    drawn = F.shiftrightunsigned(F.xxhash64("__id", F.lit(params.seed)), 11) / F.lit(float(1 << 53))
    return keyed.join(F.broadcast(table), names).withColumn("selected", drawn < F.col("probability")).select("row", *dims, "n_tokens", "probability", "selected")


def margins(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", targets: dict | None = None, params: Params = Params()) -> DataFrame:
    """(dimension, value, tokens, asked, expected): for every value of every dimension, tokens there are, tokens its target asks, and expected tokens of ``mix``.

    The row with dimension "all" has the totals: the budget is asked.
    """
    targets = targets or TARGETS
    dims = _dims(text_col, source_col, lang_col)
    found = plan(_keyed(docs, dims, tokens(text_col), id_col, targets), [f"__{d}" for d in dims], [targets[d] for d in dims], params)
    budget = params.budget * found.totals.sum()
    rows = [("all", None, float(found.totals.sum()), float(budget), float(found.raked.sum()))]
    for d, code, values, share in zip(dims, found.codes, found.values, found.shares):
        there, given = np.bincount(code, found.totals, len(values)), np.bincount(code, found.raked, len(values))
        rows += [(d, v, float(t), float(a), float(g)) for v, t, a, g in zip(values, there, share / max(share.sum(), 1e-300) * budget, given)]
    return docs.sparkSession.createDataFrame(rows, "dimension string, value string, tokens double, asked double, expected double")


def _dims(text_col: str, source_col: str, lang_col: str) -> dict[str, Column]:
    return {"source": F.col(source_col), "lang": F.col(lang_col), "topic": topic(text_col)}


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", targets: dict | None = None, params: Params = Params()) -> DataFrame:
    """``calibrate`` by source, language and topic, tokens being words."""
    return calibrate(docs, _dims(text_col, source_col, lang_col), tokens(text_col), id_col, targets, params)


def sample(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that ``mix`` draws, columns as they were."""
    return mix(docs, **options).filter("selected").select("row.*")

"""Column-level helpers.

All of them return ``Column`` expressions built from ``pyspark.sql.functions``
so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_div(a, b) -> Column:
    """``a / NULLIF(b, 0)`` computed in double precision."""
    return _c(a).cast("double") / F.nullif(_c(b).cast("double"), F.lit(0.0))


def round_half_up(x, digits: int) -> Column:
    """Round a number half away from zero at ``digits`` and return a double.

    The value goes through DECIMAL(38,10) first so the rounding happens on a
    decimal, the way a SQL engine rounds money, not on the binary double.
    """
    return F.round(_c(x).cast("decimal(38,10)"), digits).cast("double")


def money(x, scale: int = 2) -> Column:
    """Exact money: cast a 2-decimal double to DECIMAL before arithmetic."""
    return _c(x).cast(f"decimal(18,{scale})")


def sum_if(x, cond) -> Column:
    """A2: ``SUM(CASE WHEN cond THEN x ELSE 0 END)``."""
    return F.sum(F.when(cond, _c(x)).otherwise(F.lit(0)))


def count_distinct_if(x, cond) -> Column:
    """A4: ``COUNT(DISTINCT CASE WHEN cond THEN x END)``."""
    return F.count_distinct(F.when(cond, _c(x)))


def growth_pct(a, a_days, b, b_days) -> Column:
    """A10: ``((a/a_days) - (b/b_days)) / (b/b_days) * 100`` with NULL guards."""
    ra = safe_div(a, a_days)
    rb = safe_div(b, b_days)
    return (ra - rb) / F.nullif(rb, F.lit(0.0)) * 100.0


def value_map(x, mapping: Mapping, default=None) -> Column:
    """Simple CASE ``x WHEN k THEN v ... ELSE default END``."""
    expr = None
    for k, v in mapping.items():
        expr = (F.when(_c(x) == F.lit(k), F.lit(v)) if expr is None
                else expr.when(_c(x) == F.lit(k), F.lit(v)))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def one_hot(df, col: str, names: Mapping[str, str]):
    """One 0/1 integer column per category value, then drop ``col``."""
    return df.withColumns(
        {name: (F.col(col) == F.lit(v)).cast("int") for v, name in names.items()}
    ).drop(col)


def dow_sunday0(d) -> Column:
    """Day of week with 0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(_c(d)) - 1


def id_string(prefix: str, n, width: int = 4) -> Column:
    """Zero-padded identifier such as ``CALL_0001``."""
    return F.format_string(f"{prefix}%0{width}d", _c(n).cast("int"))


def hash_int(*keys) -> Column:
    """Deterministic non-negative 32-bit integer from the md5 of the key(s).

    ``conv(substr(md5(k), 1, 8), 16, 10)``; the same integer can be computed
    in any SQL engine with md5, so rate samples have an oracle.
    """
    k = F.concat_ws("|", *[_c(x).cast("string") for x in keys])
    return F.conv(F.substring(F.md5(k), 1, 8), 16, 10).cast("bigint")


def uniform_int(lo: int, hi: int, *keys) -> Column:
    """Deterministic 'random' integer in [lo, hi] keyed by the row."""
    return F.pmod(hash_int(*keys), F.lit(hi - lo + 1)) + F.lit(lo)


def clip(x, lo, hi) -> Column:
    """Integer clip ``least(greatest(x, lo), hi)``."""
    return F.least(F.greatest(_c(x), F.lit(lo)), F.lit(hi))


# Fixed values (the sales calendar's days off): month, first and last day of
# the month, weekday (Sunday 0; None: any).
HOLIDAYS = (
    (1, 1, 1, None),
    (7, 4, 4, None),
    (11, 22, 28, 4),
    (11, 23, 29, 5),
    (12, 24, 26, None),
)


def is_us_holiday(d) -> Column:
    """G1: whether a date is one of ``HOLIDAYS``, as a pure expression of the date."""
    d = _c(d)
    hit = F.lit(False)
    for month, first, last, weekday in HOLIDAYS:
        one = (F.month(d) == month) & F.dayofmonth(d).between(first, last)
        hit = hit | (one if weekday is None else one & (dow_sunday0(d) == weekday))
    return hit

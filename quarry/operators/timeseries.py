"""Time-series features, validation and per-key forecasting
(W3, W5, W6, M11, M13-M16, G6, G7).

All window features of one series share ONE window spec (same partition and
order), so Catalyst plans one sort for all of them.  Per-key windows are
applied to *daily* series: a key has at most one row per day, so a window
partition is bounded by the calendar span whatever the raw skew was (the raw
rows are reduced by a map-side partial aggregate first).

Rolling statistics are computed from running SUM/COUNT (and sum of squares)
rather than AVG/STDDEV, so they are exact for integer and decimal inputs and
do not depend on summation order.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _cols(x):
    return [x] if isinstance(x, str) else list(x)


def compute_lag(
    df: DataFrame,
    cols: list[str],
    lags: list[int],
    order_by: str,
    group_by,
    calendar: bool = False,
) -> DataFrame:
    """``<col>_lag_<n>`` for every column and lag.

    Row semantics (default): the n-th previous *row* of the key, NULL at the
    series start.  ``calendar=True``: the value exactly n *days* earlier
    (NULL when that day is missing), built with one shifted self-join: every
    row is exploded into its n future dates, pivoted in one aggregation and
    left-joined back on (key, date).
    """
    keys = _cols(group_by)
    if not calendar:
        w = Window.partitionBy(*keys).orderBy(order_by)
        return df.withColumns({f"{c}_lag_{n}": F.lag(c, n).over(w) for c in cols for n in lags})
    shifted = df.select(
        *keys,
        F.explode(
            F.array(*[F.struct(F.lit(n).alias("n"), F.date_add(order_by, n).alias("d")) for n in lags])
        ).alias("__s"),
        *cols,
    )
    piv = shifted.groupBy(*keys, F.col("__s.d").alias(order_by)).agg(
        *[F.max(F.when(F.col("__s.n") == n, F.col(c))).alias(f"{c}_lag_{n}") for c in cols for n in lags]
    )
    return df.join(piv, on=[*keys, order_by], how="left")


def _frame(w, lo: int, hi: int):
    return w.rowsBetween(lo, hi)


def rolling(
    df: DataFrame,
    y: str,
    key,
    ts: str,
    lag: int,
    window: int,
    stats=("mean",),
    name: str | None = None,
) -> DataFrame:
    """Mean / sample std of ``y`` over rows [t-lag-window+1, t-lag].

    NULL until the window is full, as a rolling window with
    ``min_periods = window`` would be.
    """
    base = Window.partitionBy(*_cols(key)).orderBy(ts)
    return df.withColumns(rolling_exprs(y, base, lag, window, stats, name))


def rolling_exprs(y: str, base, lag: int, window: int, stats=("mean",), name: str | None = None) -> dict:
    w = _frame(base, -(lag + window - 1), -lag)
    n = F.count(F.col(y)).over(w)
    s = F.sum(F.col(y)).over(w)
    out = {}
    stem = name or f"{y}_lag{lag}_roll{window}"
    if "mean" in stats:
        out[f"{stem}_mean"] = F.when(n == window, s.cast("double") / n)
    if "std" in stats:
        ss = F.sum(F.col(y) * F.col(y)).over(w)
        num = (n * ss - s * s).cast("double")
        out[f"{stem}_std"] = F.when(
            (n == window) & (n > 1), F.sqrt(F.greatest(num, F.lit(0.0)) / (n * (n - 1)).cast("double"))
        )
    return out


def expanding_mean_expr(y: str, base, lag: int = 1) -> Column:
    """Mean of all rows up to ``lag`` rows back."""
    w = base.rowsBetween(Window.unboundedPreceding, -lag)
    return F.sum(F.col(y)).over(w).cast("double") / F.count(F.col(y)).over(w)


# The forecast feature recipe - lags 1/7/14/28, rolling mean
# and std of lag 7 over 7 rows and of lag 14 over 14 rows, rolling mean of
# lag 28 over 28 rows, expanding mean of lag 1, and calendar parts.
DEFAULT_TS_CONFIG = {
    "lags": [1, 7, 14, 28],
    "rolling": [(7, 7, ("mean", "std")), (14, 14, ("mean", "std")), (28, 28, ("mean",))],
    "expanding_lag": 1,
    "calendar": True,
}


def ts_features(df: DataFrame, key, ts: str, y: str, cfg: dict | None = None) -> DataFrame:
    """Forecast feature builder, every window feature on one spec."""
    cfg = cfg or DEFAULT_TS_CONFIG
    keys = _cols(key)
    base = Window.partitionBy(*keys).orderBy(ts)
    exprs = {f"{y}_lag_{n}": F.lag(y, n).over(base) for n in cfg["lags"]}
    for lag, win, stats in cfg["rolling"]:
        exprs.update(rolling_exprs(y, base, lag, win, stats))
    if cfg.get("expanding_lag"):
        exprs[f"{y}_expanding_mean"] = expanding_mean_expr(y, base, cfg["expanding_lag"])
    if cfg.get("calendar"):
        exprs.update(
            {
                "day_of_week": F.weekday(ts),  # Monday = 0, as pandas' dayofweek
                "month": F.month(ts),
                "quarter": F.quarter(ts),
                "week_of_year": F.weekofyear(ts),
            }
        )
    return df.withColumns(exprs)


def rolling_origin_cv(df: DataFrame, key, ts: str, h: int, n_windows: int, step: int | None = None) -> DataFrame:
    """Rolling-origin folds as rows ``(fold, role)``.

    Cutoff of fold k (k = 1..n) is ``max(ts) - k*step`` days, per series;
    a row is 'train' for fold k when ``ts <= cutoff`` and 'valid' when
    ``cutoff < ts <= cutoff + h``.  Rows are replicated at most n_windows
    times (a fixed fan-out, no pairs).
    """
    step = step or h
    keys = _cols(key)
    last = Window.partitionBy(*keys)
    x = df.withColumn("__max", F.max(ts).over(last))
    folds = F.explode(F.sequence(F.lit(1), F.lit(n_windows))).alias("fold")
    x = x.select("*", folds)
    cutoff = F.date_sub(F.col("__max"), F.col("fold") * step)
    x = x.withColumn("cutoff", cutoff)
    role = F.when(F.col(ts) <= F.col("cutoff"), "train").when(
        F.col(ts) <= F.date_add(F.col("cutoff"), h), "valid"
    )
    return x.withColumn("role", role).filter(F.col("role").isNotNull()).drop("__max")


def forecast_errors(df: DataFrame, key, y: str, yhat: str) -> tuple[DataFrame, DataFrame]:
    """RMSE and SMAPE per series, then their mean over series.

    SMAPE = mean(|y - yhat| / (|y| + |yhat|)), a term is 0 when both are 0.
    """
    keys = _cols(key)
    err = F.col(y) - F.col(yhat)
    den = F.abs(F.col(y)) + F.abs(F.col(yhat))
    per = df.groupBy(*keys).agg(
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.when(den == 0, F.lit(0.0)).otherwise(F.abs(err) / den)).alias("smape"),
        F.count(F.lit(1)).alias("n"),
    )
    overall = per.agg(F.avg("rmse").alias("rmse"), F.avg("smape").alias("smape"), F.count(F.lit(1)).alias("series"))
    return per, overall


def future_stubs(history: DataFrame, key, ts: str, y: str, h: int, feats: list[str], exog: str = "carry_forward") -> DataFrame:
    """M15 / BQ11: history plus ``h`` rows per key to be predicted.

    ``exog="carry_forward"`` (production scoring): the rows sit on the ``h``
    days after the key's last date, carry the last known exogenous features
    forward and have ``y = NULL``; the fan-out is ``h`` rows per key (a
    generator, not a cross join of data).
    ``exog="actual"`` (hold-out scoring): the key's last ``h`` rows keep
    their true exogenous features and get ``y = NULL``; the rows before them
    are the history.
    """
    keys = _cols(key)
    if exog == "actual":
        w = Window.partitionBy(*keys).orderBy(F.col(ts).desc())
        r = history.select(*keys, ts, y, *feats).withColumn("__rd", F.row_number().over(w))
        masked = F.when(F.col("__rd") <= h, F.lit(None).cast(history.schema[y].dataType)).otherwise(F.col(y))
        return r.withColumn(y, masked).drop("__rd")
    if exog != "carry_forward":
        raise ValueError(f"future_stubs: exog must be 'carry_forward' or 'actual', not {exog!r}")
    # the latest row per key; equal timestamps resolved by the row's values
    last = history.groupBy(*keys).agg(F.max(F.struct(ts, *feats)).alias("__l"))
    stubs = last.select(
        *keys,
        F.explode(F.sequence(F.lit(1), F.lit(h))).alias("__k"),
        "__l",
    ).select(
        *keys,
        F.date_add(F.col(f"__l.{ts}"), F.col("__k")).alias(ts),
        F.lit(None).cast(history.schema[y].dataType).alias(y),
        *[F.col(f"__l.{c}").alias(c) for c in feats],
    )
    cols = [*keys, ts, y, *feats]
    return history.select(*cols).unionByName(stubs.select(*cols))


def scd_intervals(df: DataFrame, key, effective: str, valid_to: str = "valid_to") -> DataFrame:
    """Attribute history -> half-open validity intervals [effective, valid_to)."""
    w = Window.partitionBy(*_cols(key)).orderBy(effective)
    return df.withColumn(valid_to, F.lead(effective).over(w))


def intervals_to_labels(df: DataFrame, key: str, end: str, label: str = "failure") -> DataFrame:
    """Anomaly intervals -> one labelled event at the interval end."""
    return df.select(key, F.col(end).alias("date"), F.lit(1).alias(label))


def forecast(
    history_future: DataFrame,
    key: str,
    ts: str,
    y: str,
    coef: dict | None = None,
    cfg: dict | None = None,
    exog: tuple[str, ...] = (),
    out: str = "forecast",
    model=None,
    model_features: tuple[str, ...] = (),
) -> DataFrame:
    """Recursive forecast per key with a linear model, or a fitted one, on
    the features of ``ts_features`` plus exogenous columns.

    ``coef`` maps "intercept" and feature names (``<y>_lag_7``,
    ``<y>_lag7_roll7_mean``, ``<y>_expanding_mean``, ``day_of_week``, an
    ``exog`` column, ...) to weights; names without a weight count nothing.
    ``model`` (e.g. ``ml.TreeArrays``) predicts from rows of ``model_features``
    instead; it is sent with the tasks, so it must be bounded like a model is.
    The rows after a key's last known ``y`` are predicted in order, each
    prediction feeding the lags and windows of the next.  A feature that is
    NULL (too little history, a gap, a NULL exogenous value) makes the
    forecast NULL, never a changed number; NULLs inside the history stay
    unknown and are not forecast.  A key's group is its daily series, bounded
    by the calendar span, never raw events.
    """
    cfg = cfg or DEFAULT_TS_CONFIG
    kt = history_future.schema[key].dataType.simpleString()
    if (coef is None) == (model is None):
        raise ValueError("forecast: pass either coef or model")
    weights = {n: float(b) for n, b in (coef or {}).items() if n != "intercept"}
    b0 = float((coef or {}).get("intercept", 0.0))

    def predict(f: dict) -> float:
        if model is None:
            return b0 + sum(b * f.get(n, math.nan) for n, b in weights.items())
        x = np.array([[f.get(n, math.nan) for n in model_features]], float)
        return math.nan if np.isnan(x).any() else float(model.predict(x)[0])

    def features(vals: np.ndarray, i: int, day: pd.Timestamp, row: dict) -> dict:
        f = {f"{y}_lag_{n}": vals[i - n] if i >= n else math.nan for n in cfg["lags"]}
        for lag, win, stats in cfg["rolling"]:
            window = vals[max(0, i - lag - win + 1) : max(0, i - lag + 1)]
            full = len(window) == win and not np.isnan(window).any()
            if "mean" in stats:
                f[f"{y}_lag{lag}_roll{win}_mean"] = window.mean() if full else math.nan
            if "std" in stats:
                f[f"{y}_lag{lag}_roll{win}_std"] = window.std(ddof=1) if full and win > 1 else math.nan
        if cfg.get("expanding_lag"):
            past = vals[: max(0, i - cfg["expanding_lag"] + 1)]
            past = past[~np.isnan(past)]
            f[f"{y}_expanding_mean"] = past.mean() if len(past) else math.nan
        if cfg.get("calendar"):
            f |= {"day_of_week": day.weekday(), "month": day.month, "quarter": (day.month + 2) // 3, "week_of_year": day.isocalendar()[1]}
        return f | row

    def per_key(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ts)
        vals = pdf[y].astype("float64").to_numpy().copy()
        known = np.flatnonzero(~np.isnan(vals))
        first = known[-1] + 1 if len(known) else 0
        days = pd.to_datetime(pdf[ts])
        extra = {c: pdf[c].astype("float64").to_numpy() for c in exog}
        for i in range(first, len(vals)):
            f = features(vals, i, days.iloc[i], {c: v[i] for c, v in extra.items()})
            vals[i] = predict(f)
        return pd.DataFrame({key: pdf[key].to_numpy()[first:], ts: pdf[ts].to_numpy()[first:], out: vals[first:]})

    scored = (
        history_future.select(key, ts, y, *exog)
        .groupBy(key)
        .applyInPandas(per_key, schema=f"{key} {kt}, {ts} date, {out} double")
    )
    return scored.withColumn(out, F.when(~F.isnan(out), F.col(out)))

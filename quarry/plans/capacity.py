"""Pipeline F (utilisation forecast + monitoring) on the `events` table.

Stand-in series: one daily series per event type; y = number of events
that day; exogenous features = distinct active users and the day's value
sum.  Raw events are reduced to the daily series by a map-side partial
aggregate, so every per-series window afterwards holds one row per day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.functions.scalar import money, round_half_up, safe_div
from quarry.operators.monitor import attach_actuals, daily_psi, monitor_performance
from quarry.operators.timeseries import (
    DEFAULT_TS_CONFIG,
    forecast,
    forecast_errors,
    future_stubs,
    rolling_origin_cv,
    ts_features,
)
from quarry.plans.common import sql_r
from quarry.plans.registry import query
from quarry.session import scratch_path
from quarry.sources.sinks import materialize
from quarry.sources.tables import load

# Forecast horizon, number of CV windows, PSI bins and the
# baseline period of the drift monitor.
H = 5
N_WINDOWS = 3
PSI_BINS = 10
BASELINE_END = "2024-01-08"  # baseline = events before this day
EXOG = ["active_users", "value_sum"]


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events")
    return ev.groupBy(F.col("event_type").alias("series"), F.to_date("ts").alias("ds")).agg(
        F.count(F.lit(1)).alias("y"),
        F.count_distinct("user_id").alias("active_users"),
        F.sum(money("value")).cast("double").alias("value_sum"),
    )


SQL_DAILY = (
    "SELECT event_type AS series, CAST(ts AS DATE) AS ds, COUNT(*) AS y, "
    "COUNT(DISTINCT user_id) AS active_users, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value_sum "
    "FROM events GROUP BY 1, 2"
)


def _sql_ts_features(cfg=DEFAULT_TS_CONFIG) -> str:
    w = "PARTITION BY series ORDER BY ds"
    cols = [f"LAG(y, {n}) OVER ({w}) AS y_lag_{n}" for n in cfg["lags"]]
    for lag, win, stats in cfg["rolling"]:
        fr = f"({w} ROWS BETWEEN {lag + win - 1} PRECEDING AND {lag} PRECEDING)"
        n, s = f"COUNT(y) OVER {fr}", f"SUM(y) OVER {fr}"
        stem = f"y_lag{lag}_roll{win}"
        if "mean" in stats:
            cols.append(f"CASE WHEN {n} = {win} THEN CAST({s} AS DOUBLE) / {n} END AS {stem}_mean")
        if "std" in stats:
            ss = f"SUM(y * y) OVER {fr}"
            cols.append(
                f"CASE WHEN {n} = {win} AND {n} > 1 THEN SQRT(GREATEST(CAST({n} * {ss} - {s} * {s} AS DOUBLE), 0.0)"
                f" / CAST({n} * ({n} - 1) AS DOUBLE)) END AS {stem}_std"
            )
    fr = f"({w} ROWS BETWEEN UNBOUNDED PRECEDING AND {cfg['expanding_lag']} PRECEDING)"
    cols.append(f"CAST(SUM(y) OVER {fr} AS DOUBLE) / COUNT(y) OVER {fr} AS y_expanding_mean")
    cols += [
        "CAST(isodow(ds) - 1 AS INTEGER) AS day_of_week",
        "CAST(month(ds) AS INTEGER) AS month",
        "CAST(quarter(ds) AS INTEGER) AS quarter",
        "CAST(weekofyear(ds) AS INTEGER) AS week_of_year",
    ]
    return f"SELECT series, ds, y, active_users, value_sum, {', '.join(cols)} FROM ({SQL_DAILY}) d"


@query("ts_feature_frame", _sql_ts_features())
def ts_feature_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lags 1/7/14/28, rolling mean/std, expanding mean, calendar parts."""
    return ts_features(daily_series(spark, sf_dir), "series", "ds", "y")


BQ11_SQL = f"""
WITH d AS ({SQL_DAILY}),
l AS (SELECT series, arg_max(struct_pack(ds := ds, active_users := active_users, value_sum := value_sum), ds) AS r FROM d GROUP BY series)
SELECT series, ds, y, active_users, value_sum FROM d
UNION ALL
SELECT l.series, CAST(l.r.ds + CAST(k.k AS INTEGER) AS DATE) AS ds, CAST(NULL AS BIGINT) AS y,
       l.r.active_users AS active_users, l.r.value_sum AS value_sum
FROM l, range(1, {H + 1}) k(k)
"""


@query("bq11_forecast_input", BQ11_SQL)
def bq11_forecast_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BQ11 / M15: history plus H future stub rows per series."""
    return future_stubs(daily_series(spark, sf_dir), "series", "ds", "y", H, EXOG)


CV_SQL = f"""
WITH d AS ({SQL_DAILY}),
m AS (SELECT series, ds, y, MAX(ds) OVER (PARTITION BY series) AS mx FROM d),
f AS (SELECT m.*, k.fold, CAST(m.mx - CAST(k.fold * {H} AS INTEGER) AS DATE) AS cutoff FROM m, range(1, {N_WINDOWS + 1}) k(fold)),
r AS (SELECT *, CASE WHEN ds <= cutoff THEN 'train' WHEN ds <= cutoff + {H} THEN 'valid' END AS role FROM f)
SELECT series, fold, role, cutoff, COUNT(*) AS n_rows, MIN(ds) AS first_ds, MAX(ds) AS last_ds, CAST(SUM(y) AS BIGINT) AS y_total
FROM r WHERE role IS NOT NULL GROUP BY series, fold, role, cutoff
"""


@query("cv_folds", CV_SQL)
def cv_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolling-origin CV folds (3 windows, step = h), summarised."""
    f = rolling_origin_cv(daily_series(spark, sf_dir), "series", "ds", H, N_WINDOWS)
    return f.groupBy("series", F.col("fold").cast("bigint").alias("fold"), "role", "cutoff").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("ds").alias("first_ds"),
        F.max("ds").alias("last_ds"),
        F.sum("y").alias("y_total"),
    )


NAIVE_SQL = f"""
WITH d AS ({SQL_DAILY}),
p AS (SELECT series, ds, y, LAG(y, 7) OVER (PARTITION BY series ORDER BY ds) AS yhat,
             ROW_NUMBER() OVER (PARTITION BY series ORDER BY ds DESC) AS rd FROM d),
v AS (SELECT * FROM p WHERE rd <= {H} AND yhat IS NOT NULL)
SELECT series,
       {sql_r('SQRT(CAST(SUM((y - yhat) * (y - yhat)) AS DOUBLE) / COUNT(*))', 9)} AS rmse,
       {sql_r('AVG(CASE WHEN ABS(y) + ABS(yhat) = 0 THEN 0.0 ELSE ABS(y - yhat) / CAST(ABS(y) + ABS(yhat) AS DOUBLE) END)', 9)} AS smape,
       COUNT(*) AS n
FROM v GROUP BY series
"""


@query("forecast_errors_naive", NAIVE_SQL)
def forecast_errors_naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7 + M14: seasonal-naive (lag 7) forecast scored on the last H days."""
    d = daily_series(spark, sf_dir)
    w = Window.partitionBy("series").orderBy("ds")
    wd = Window.partitionBy("series").orderBy(F.col("ds").desc())
    p = d.withColumn("yhat", F.lag("y", 7).over(w)).withColumn("rd", F.row_number().over(wd))
    v = p.filter((F.col("rd") <= H) & F.col("yhat").isNotNull())
    per, _ = forecast_errors(v, "series", "y", "yhat")
    return per.select(
        "series", round_half_up("rmse", 9).alias("rmse"), round_half_up("smape", 9).alias("smape"), "n"
    )


def _sql_bin(col: str) -> str:
    return (
        f"CAST(CASE WHEN e.hi - e.lo <= 0 THEN 0 ELSE LEAST(GREATEST(FLOOR(({col} - e.lo) / (e.hi - e.lo) * {PSI_BINS}), 0), {PSI_BINS - 1}) END AS INTEGER)"
    )


# Versions of the forecast model: a line through (y a week before, y), fitted
# on the days up to each cutoff (fixed values).
CUTOFFS = {"v1": "2024-01-16", "v2": "2024-01-22"}
FIRST_SCORED = "2024-01-23"

_SQL_LINE = """
COUNT(*) AS n, SUM(x) AS sx, SUM(y) AS sy, SUM(x * y) AS sxy, SUM(x * x) AS sxx"""
_SQL_SLOPE = "CAST(n * sxy - sx * sy AS DOUBLE) / NULLIF(CAST(n * sxx - sx * sx AS DOUBLE), 0)"

BQ12_SQL = f"""
WITH d AS ({SQL_DAILY}),
xy AS (SELECT series, ds, y, LAG(y, 7) OVER (PARTITION BY series ORDER BY ds) AS x FROM d),
cut(model, day) AS (VALUES {', '.join(f"('{m}', DATE '{x}')" for m, x in CUTOFFS.items())}),
sums AS (SELECT model, {_SQL_LINE} FROM xy JOIN cut ON ds <= day WHERE x IS NOT NULL GROUP BY model),
line AS (SELECT model, b, (CAST(sy AS DOUBLE) - b * CAST(sx AS DOUBLE)) / CAST(n AS DOUBLE) AS a FROM (SELECT *, {_SQL_SLOPE} AS b FROM sums)),
pred AS (SELECT model, ds AS day, y, a + b * CAST(x AS DOUBLE) AS yhat FROM xy, line WHERE ds >= DATE '{FIRST_SCORED}' AND x IS NOT NULL AND b IS NOT NULL),
perf AS (
    SELECT day, model, COUNT(*) AS n, {sql_r('SQRT(AVG((y - yhat) * (y - yhat)))', 6)} AS rmse,
           {sql_r('AVG(CASE WHEN ABS(y) + ABS(yhat) = 0 THEN 0.0 ELSE ABS(y - yhat) / (ABS(y) + ABS(yhat)) END)', 6)} AS smape
    FROM pred GROUP BY day, model
),
e AS (SELECT MIN(value) AS lo, MAX(value) AS hi FROM events WHERE ts < TIMESTAMP '{BASELINE_END}'),
c AS (SELECT CAST(ts AS DATE) AS day, {_sql_bin('value')} AS bin, COUNT(*) AS k FROM events, e WHERE value IS NOT NULL GROUP BY 1, 2),
q AS (SELECT bin, SUM(k) / SUM(SUM(k)) OVER () AS q FROM c WHERE day < DATE '{BASELINE_END}' GROUP BY bin),
p AS (SELECT day, bin, k / SUM(k) OVER (PARTITION BY day) AS p FROM c),
grid AS (SELECT day, CAST(b.bin AS INTEGER) AS bin FROM (SELECT DISTINCT day FROM c), range({PSI_BINS}) b(bin)),
fl AS (SELECT g.day, GREATEST(COALESCE(p, 0.0), 1e-4) AS p, GREATEST(COALESCE(q, 0.0), 1e-4) AS q
       FROM grid g LEFT JOIN p ON g.day = p.day AND g.bin = p.bin LEFT JOIN q ON g.bin = q.bin),
drift AS (SELECT day, {sql_r('SUM((p - q) * LN(p / q))', 6)} AS psi_value FROM fl GROUP BY day)
SELECT perf.day, model, n, rmse, smape, psi_value FROM perf LEFT JOIN drift ON perf.day = drift.day
"""


def line_fit(df: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """Least-squares line ``y = a + b x`` per group from exact integer sums: (by, a, b)."""
    s = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(x).alias("sx"),
        F.sum(y).alias("sy"),
        F.sum(F.col(x) * F.col(y)).alias("sxy"),
        F.sum(F.col(x) * F.col(x)).alias("sxx"),
    )
    b = safe_div(F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy"), F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx"))
    s = s.withColumn("b", b)
    return s.select(*by, ((F.col("sy").cast("double") - F.col("b") * F.col("sx").cast("double")) / F.col("n").cast("double")).alias("a"), "b")


@query("bq12_drift_and_error", BQ12_SQL)
def bq12_drift_and_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BQ12: per day and model version, forecast error and feature drift.

    The versions are the same model fitted up to two cutoffs; both score the
    days after, joined to the actuals on renamed keys (M18/J3, M21), and each
    day's `value` distribution is compared with the baseline period by PSI
    (M20).  ``events`` is read three times: once for the daily series, which
    is written, once for the bin edges and once for the counts.
    """
    d = materialize(daily_series(spark, sf_dir).select("series", "ds", "y"), scratch_path(spark, "daily-series"))
    xy = d.withColumn("x", F.lag("y", 7).over(Window.partitionBy("series").orderBy("ds")))
    version = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(x).cast("date").alias("cutoff")) for m, x in CUTOFFS.items()]))
    fits = line_fit(xy.withColumn("v", version).filter(F.col("ds") <= F.col("v.cutoff")).withColumn("model", F.col("v.model")), ["model"], "x", "y")
    scored = xy.filter((F.col("ds") >= F.lit(FIRST_SCORED).cast("date")) & F.col("x").isNotNull())
    asked = scored.select("series", F.col("ds").alias("forecast_date"), "x", F.explode(F.array(*map(F.lit, CUTOFFS))).alias("model"))
    pred = asked.join(F.broadcast(fits.filter("b IS NOT NULL")), "model").select("series", "forecast_date", "model", (F.col("a") + F.col("b") * F.col("x").cast("double")).alias("predicted"))
    src = attach_actuals(pred, d, ["series", "forecast_date"], ["series", "ds"], "y")
    perf = monitor_performance(src, "forecast_date", "y", "predicted", by="model").select(
        "day", "model", "n", round_half_up("rmse", 6).alias("rmse"), round_half_up("smape", 6).alias("smape")
    )
    ev = load(spark, sf_dir, "events").select("ts", "value")
    drift = daily_psi(ev, "ts", "value", BASELINE_END, PSI_BINS).select("day", round_half_up("psi", 6).alias("psi_value"))
    return perf.join(drift, "day", "left")


# ---------------------------------------------------------------------------
# M13 with a model: per fold, the line is fitted on the training rows of all
# series and scored on the H days after the cutoff (their lag is history).
# ---------------------------------------------------------------------------
CV_SCORE_SQL = f"""
WITH d AS ({SQL_DAILY}),
xy AS (SELECT series, ds, y, LAG(y, 7) OVER (PARTITION BY series ORDER BY ds) AS x, MAX(ds) OVER (PARTITION BY series) AS mx FROM d),
f AS (SELECT xy.*, k.fold, ds <= mx - CAST(k.fold * {H} AS INTEGER) AS train, ds <= mx - CAST(k.fold * {H} AS INTEGER) + {H} AS kept FROM xy, range(1, {N_WINDOWS + 1}) k(fold)),
sums AS (SELECT fold, {_SQL_LINE} FROM f WHERE train AND x IS NOT NULL GROUP BY fold),
line AS (SELECT fold, b, (CAST(sy AS DOUBLE) - b * CAST(sx AS DOUBLE)) / CAST(n AS DOUBLE) AS a FROM (SELECT *, {_SQL_SLOPE} AS b FROM sums)),
s AS (SELECT f.fold, y, a + b * CAST(x AS DOUBLE) AS yhat FROM f JOIN line ON f.fold = line.fold WHERE kept AND NOT train AND x IS NOT NULL)
SELECT CAST(fold AS BIGINT) AS fold, COUNT(*) AS n, {sql_r('SQRT(AVG((y - yhat) * (y - yhat)))', 6)} AS rmse,
       {sql_r('AVG(CASE WHEN ABS(y) + ABS(yhat) = 0 THEN 0.0 ELSE ABS(y - yhat) / (ABS(y) + ABS(yhat)) END)', 6)} AS smape
FROM s GROUP BY fold
"""


@query("cv_model_scores", CV_SCORE_SQL)
def cv_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolling-origin CV that fits and scores a model on every fold."""
    d = daily_series(spark, sf_dir).select("series", "ds", "y")
    xy = d.withColumn("x", F.lag("y", 7).over(Window.partitionBy("series").orderBy("ds")))
    folds = materialize(rolling_origin_cv(xy, "series", "ds", H, N_WINDOWS), scratch_path(spark, "cv-folds"))
    fits = line_fit(folds.filter("role = 'train'"), ["fold"], "x", "y")
    valid = folds.filter("role = 'valid' AND x IS NOT NULL").join(F.broadcast(fits), "fold")
    valid = valid.withColumn("yhat", F.col("a") + F.col("b") * F.col("x").cast("double"))
    per, _ = forecast_errors(valid, "fold", "y", "yhat")
    return per.select(F.col("fold").cast("bigint").alias("fold"), "n", round_half_up("rmse", 6).alias("rmse"), round_half_up("smape", 6).alias("smape"))


# ---------------------------------------------------------------------------
# M16 with given weights: lag 1 (fed back), lag 7, the 7-row mean a week back,
# the weekday and a carried exogenous column; the oracle recurses day by day.
# ---------------------------------------------------------------------------
WEIGHTS = {"intercept": 2.0, "y_lag_1": 0.3, "y_lag_7": 0.25, "y_lag7_roll7_mean": 0.35, "day_of_week": 0.5, "active_users": 0.04}

GIVEN_SQL = f"""
WITH RECURSIVE d AS ({SQL_DAILY}),
l AS (SELECT series, MAX(ds) AS last, arg_max(y, ds) AS y, arg_max(active_users, ds) AS au FROM d GROUP BY series),
f(series, k, last, au, yhat) AS (
    SELECT series, 0, last, au, CAST(y AS DOUBLE) FROM l
    UNION ALL
    SELECT f.series, k + 1, last, au,
           {WEIGHTS['intercept']} + {WEIGHTS['y_lag_1']} * yhat + {WEIGHTS['active_users']} * au
           + {WEIGHTS['day_of_week']} * (isodow(last + k + 1) - 1)
           + {WEIGHTS['y_lag_7']} * (SELECT y FROM d WHERE d.series = f.series AND d.ds = f.last + f.k - 6)
           + {WEIGHTS['y_lag7_roll7_mean']} * (SELECT CASE WHEN COUNT(*) = 7 THEN AVG(y) END FROM d WHERE d.series = f.series AND d.ds BETWEEN f.last + f.k - 12 AND f.last + f.k - 6)
    FROM f WHERE k < {H}
)
SELECT series, CAST(last + k AS DATE) AS ds, {sql_r('yhat', 6)} AS forecast FROM f WHERE k > 0
"""


@query("forecast_given_weights", GIVEN_SQL)
def forecast_given_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    stubs = future_stubs(daily_series(spark, sf_dir), "series", "ds", "y", H, EXOG)
    f = forecast(stubs, "series", "ds", "y", WEIGHTS, exog=("active_users",))
    return f.withColumn("forecast", round_half_up("forecast", 6))


# ---------------------------------------------------------------------------
# W5/W6 on a long series: monthly net sales per brand, all features of the
# recipe (the 28 x 28 window needs 56 months).
# ---------------------------------------------------------------------------
SQL_MONTHLY = (
    "SELECT p_brand AS series, CAST(date_trunc('month', CAST(l_shipdate AS DATE)) AS DATE) AS ds, "
    "CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS y, COUNT(*) AS active_users, CAST(MAX(l_linenumber) AS DOUBLE) AS value_sum "
    "FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2"
)


@query("brand_monthly_features", _sql_ts_features().replace(SQL_DAILY, SQL_MONTHLY).replace("SELECT series, ds, y, active_users, value_sum,", "SELECT series, ds, y,"))
def brand_monthly_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate", "l_quantity")
    part = load(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("series"))
    month = F.trunc(F.to_date("l_shipdate"), "month").alias("ds")
    m = li.join(part, li.l_partkey == part.p_partkey).groupBy("series", month).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("y"))
    return ts_features(m, "series", "ds", "y")

"""Pipeline E (failure prediction) on the `events` table, plus the as-of join.

Stand-ins: machine = events.user_id; sensor i = mean `value` of one event
type per (machine, day); a failure = a (machine, day) with an 'error' event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalar import money, safe_div
from quarry.operators.asof import asof_join
from quarry.operators.features import make_spine, shift_label
from quarry.operators.monitor import weighted_prf
from quarry.functions.scalar import round_half_up
from quarry.operators.timeseries import compute_lag
from quarry.plans.registry import query
from quarry.sources.tables import load

# Event types standing in for the three sensors, the failure
# event, the lag depth and the training window.
SENSOR_TYPES = ["click", "view", "purchase"]
FAILURE_TYPE = "error"
N_LAGS = 3
TRAIN_START, TRAIN_END = "2024-01-04", "2024-01-30"

SENSOR_COLS = [f"s{i}_mean" for i in range(1, len(SENSOR_TYPES) + 1)]
LAG_COLS = [f"{c}_lag_{n}" for c in SENSOR_COLS for n in range(1, N_LAGS + 1)]


def daily_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_sensor_means(load(spark, sf_dir, "events"))


def daily_sensor_means(events: DataFrame) -> DataFrame:
    """Daily mean per machine and sensor; exact decimal sums, so the
    mean does not depend on summation order."""
    ev = events.filter(F.col("event_type").isin(SENSOR_TYPES))
    aggs = []
    for t, name in zip(SENSOR_TYPES, SENSOR_COLS):
        hit = F.col("event_type") == t
        aggs.append(safe_div(F.sum(F.when(hit, money("value"))), F.count(F.when(hit, F.col("value")))).alias(name))
    return ev.groupBy(F.col("user_id").alias("machine_id"), F.to_date("ts").alias("date")).agg(*aggs)


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G7-style labels: one row per (machine, day) with a failure event."""
    ev = load(spark, sf_dir, "events").filter(F.col("event_type") == FAILURE_TYPE)
    return (
        ev.select(F.col("user_id").alias("machine_id"), F.to_date("ts").alias("date"))
        .distinct()
        .withColumn("failure", F.lit(1))
    )


def _sql_daily() -> str:
    parts = []
    for t, name in zip(SENSOR_TYPES, SENSOR_COLS):
        parts.append(
            f"CAST(SUM(CASE WHEN event_type = '{t}' THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE)"
            f" / NULLIF(CAST(COUNT(CASE WHEN event_type = '{t}' THEN value END) AS DOUBLE), 0) AS {name}"
        )
    types = ", ".join(f"'{t}'" for t in SENSOR_TYPES)
    return (
        f"SELECT user_id AS machine_id, CAST(ts AS DATE) AS date, {', '.join(parts)} "
        f"FROM events WHERE event_type IN ({types}) GROUP BY 1, 2"
    )


SQL_FAILURES = (
    f"SELECT DISTINCT user_id AS machine_id, CAST(ts AS DATE) AS date, 1 AS failure "
    f"FROM events WHERE event_type = '{FAILURE_TYPE}'"
)

BQ8_SQL = f"""
WITH d AS ({_sql_daily()}), f AS ({SQL_FAILURES})
SELECT d.machine_id, d.date, {', '.join('d.' + c for c in SENSOR_COLS)}, f.failure
FROM d LEFT JOIN f ON d.machine_id = f.machine_id AND d.date = f.date
"""


@query("bq8_daily_sensor_failures", BQ8_SQL)
def bq8_daily_sensor_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BQ8: daily sensor means left-joined to failures (A15 + J2)."""
    return daily_sensors(spark, sf_dir).join(failures(spark, sf_dir), on=["machine_id", "date"], how="left")


def lag_features(spark: SparkSession, sf_dir: str, calendar: bool = False) -> DataFrame:
    d = daily_sensors(spark, sf_dir)
    return compute_lag(d, SENSOR_COLS, list(range(1, N_LAGS + 1)), "date", "machine_id", calendar=calendar).drop(
        *SENSOR_COLS
    )


def _sql_lags(calendar: bool) -> str:
    if not calendar:
        lags = ", ".join(
            f"LAG({c}, {n}) OVER (PARTITION BY machine_id ORDER BY date) AS {c}_lag_{n}"
            for c in SENSOR_COLS
            for n in range(1, N_LAGS + 1)
        )
        return f"SELECT machine_id, date, {lags} FROM ({_sql_daily()}) d"
    joins, cols = [], []
    for n in range(1, N_LAGS + 1):
        joins.append(
            f"LEFT JOIN ({_sql_daily()}) d{n} ON d{n}.machine_id = d.machine_id AND d{n}.date = d.date - {n}"
        )
        cols += [f"d{n}.{c} AS {c}_lag_{n}" for c in SENSOR_COLS]
    return f"SELECT d.machine_id, d.date, {', '.join(cols)} FROM ({_sql_daily()}) d {' '.join(joins)}"


@query("sensor_lags_calendar", _sql_lags(True))
def sensor_lags_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3 with calendar semantics: the value exactly n days earlier."""
    return lag_features(spark, sf_dir, calendar=True)


def _types_sql() -> str:
    return ", ".join(f"'{t}'" for t in SENSOR_TYPES)


BQ9_SQL = f"""
WITH lagf AS ({_sql_lags(False)}),
spine AS (
    SELECT DISTINCT user_id AS machine_id, CAST(ts AS DATE) AS date FROM events
    WHERE event_type IN ({_types_sql()})
      AND ts >= TIMESTAMP '{TRAIN_START}' AND ts < CAST(DATE '{TRAIN_END}' + 1 AS TIMESTAMP)
),
lab AS (
    SELECT DISTINCT user_id AS machine_id, CAST(ts AS DATE) - 1 AS date, 1 AS fails_next_day
    FROM events WHERE event_type = '{FAILURE_TYPE}'
),
sp AS (
    SELECT s.machine_id, s.date, COALESCE(l.fails_next_day, 0) AS fails_next_day
    FROM spine s LEFT JOIN lab l ON s.machine_id = l.machine_id AND s.date = l.date
)
SELECT sp.machine_id, sp.date, sp.fails_next_day, {', '.join('f.' + c for c in LAG_COLS)}
FROM sp ASOF LEFT JOIN lagf f ON sp.machine_id = f.machine_id AND sp.date >= f.date
"""


@query("bq9_training_dataset", BQ9_SQL)
def bq9_training_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BQ9: lag features + spine + next-day failure label + point-in-time join."""
    ev = load(spark, sf_dir, "events").filter(F.col("event_type").isin(SENSOR_TYPES))
    ev = ev.select(F.col("user_id").alias("machine_id"), "ts")
    labels = shift_label(failures(spark, sf_dir), "machine_id", "date", 1, "fails_next_day")
    spine = make_spine(ev, "machine_id", "ts", TRAIN_START, TRAIN_END, labels=labels, label_col="fails_next_day")
    return asof_join(spine, lag_features(spark, sf_dir), "machine_id", "date", "date", cols=LAG_COLS)


# ---------------------------------------------------------------------------
# J6 on the order tables: every sold line gets the customer's latest order
# (an attribute history with effective date o_orderdate) as of its ship date.
# Time-bucketed by month, so a customer with a third of all lines is spread
# over one task per month instead of one task.
# ---------------------------------------------------------------------------
ASOF_SQL = """
WITH sp AS (
    SELECT l.l_orderkey, l.l_linenumber, o.o_custkey AS customer_key, CAST(l.l_shipdate AS DATE) AS ship_date
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
), f AS (
    SELECT o_custkey AS customer_key, CAST(o_orderdate AS DATE) AS order_date,
           o_orderkey AS last_order_key, o_totalprice AS last_order_total, o_orderpriority AS last_order_priority
    FROM orders
    QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) = 1
)
SELECT sp.l_orderkey, sp.l_linenumber, sp.customer_key, sp.ship_date,
       f.last_order_key, f.last_order_total, f.last_order_priority, f.order_date AS last_order_date
FROM sp ASOF LEFT JOIN f ON sp.customer_key = f.customer_key AND sp.ship_date >= f.order_date
"""


@query("asof_customer_orders", ASOF_SQL)
def asof_customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = load(spark, sf_dir, "orders")
    spine = li.join(orders.select("o_orderkey", "o_custkey"), li.l_orderkey == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", F.col("o_custkey").alias("customer_key"), F.to_date("l_shipdate").alias("ship_date")
    )
    feats = orders.select(
        F.col("o_custkey").alias("customer_key"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_orderkey").alias("last_order_key"),
        F.col("o_totalprice").alias("last_order_total"),
        F.col("o_orderpriority").alias("last_order_priority"),
    )
    return asof_join(
        spine, feats, "customer_key", "ship_date", "order_date", time_bucket="month", keep_feature_ts="last_order_date"
    )


# ---------------------------------------------------------------------------
# J6 / W8 with hot keys: for every event the latest large one of its type so
# far.  The types are the keys, so each holds a fifth of all rows; their time
# lines are cut where the data are dense and the scan is carried across.
# ---------------------------------------------------------------------------
LARGE = 60.0
SEGMENT_ROWS = 2_000
LATEST_LARGE_SQL = f"""
WITH u AS (SELECT event_type, ts, 1 AS side, event_id, NULL AS large_id, NULL AS large_value FROM events
           UNION ALL SELECT event_type, ts, 0, event_id, event_id, value FROM events WHERE value >= {LARGE} AND event_type IS NOT NULL AND ts IS NOT NULL),
m AS (SELECT event_id, side, event_type, ts, last_value(large_id IGNORE NULLS) OVER w AS large_id, last_value(large_value IGNORE NULLS) OVER w AS large_value
      FROM u WINDOW w AS (PARTITION BY event_type ORDER BY ts, side, event_id ROWS UNBOUNDED PRECEDING))
SELECT event_id, event_type, CASE WHEN event_type IS NOT NULL AND ts IS NOT NULL THEN large_id END AS large_id,
       CASE WHEN event_type IS NOT NULL AND ts IS NOT NULL THEN large_value END AS large_value FROM m WHERE side = 1
"""


@query("latest_large_event", LATEST_LARGE_SQL)
def latest_large_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    large = ev.filter(F.col("value") >= LARGE).select("event_type", F.col("ts").alias("at"), F.col("event_id").alias("large_id"), F.col("value").alias("large_value"))
    found = asof_join(ev.select("event_id", "event_type", "ts"), large, "event_type", "ts", "at", segment_rows=SEGMENT_ROWS)
    return found.select("event_id", "event_type", "large_id", "large_value")


# ---------------------------------------------------------------------------
# M4 + M21: per-day classification quality of a naive failure predictor
# ("a machine that failed today fails tomorrow") on the training spine.
# ---------------------------------------------------------------------------
def _r9(x: str) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,10)), 9) AS DOUBLE)"


DAILY_PRF_SQL = f"""
WITH d AS ({BQ9_SQL}),
f AS (SELECT machine_id, date, 1 AS failed_today FROM ({SQL_FAILURES})),
p AS (SELECT d.date, d.fails_next_day AS y, COALESCE(f.failed_today, 0) AS p
      FROM d LEFT JOIN f ON d.machine_id = f.machine_id AND d.date = f.date),
conf AS (SELECT date, y, p, COUNT(*) AS n FROM p GROUP BY date, y, p),
cls AS (SELECT DISTINCT date, y AS c FROM conf UNION SELECT DISTINCT date, p FROM conf),
per AS (
    SELECT cls.date, cls.c,
           COALESCE((SELECT SUM(n) FROM conf WHERE conf.date = cls.date AND conf.y = cls.c AND conf.p = cls.c), 0) AS tp,
           COALESCE((SELECT SUM(n) FROM conf WHERE conf.date = cls.date AND conf.y = cls.c), 0) AS support,
           COALESCE((SELECT SUM(n) FROM conf WHERE conf.date = cls.date AND conf.p = cls.c), 0) AS predicted
    FROM cls
), m AS (
    SELECT date, support,
           CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS pr,
           CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rc
    FROM per
)
SELECT date AS day,
       {_r9('SUM(pr * support) / SUM(support)')} AS precision,
       {_r9('SUM(rc * support) / SUM(support)')} AS recall,
       {_r9('SUM(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END * support) / SUM(support)')} AS f1,
       CAST(SUM(support) AS BIGINT) AS n
FROM m GROUP BY date
"""


@query("failure_daily_quality", DAILY_PRF_SQL)
def failure_daily_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = bq9_training_dataset(spark, sf_dir).select("machine_id", "date", "fails_next_day")
    f = failures(spark, sf_dir).select("machine_id", "date", F.col("failure").alias("failed_today"))
    p = d.join(f, ["machine_id", "date"], "left").fillna(0, subset=["failed_today"])
    m = weighted_prf(p, "fails_next_day", "failed_today", by="date")
    return m.select(
        F.col("date").alias("day"),
        *[round_half_up(c, 9).alias(c) for c in ("precision", "recall", "f1")],
        F.col("n").cast("bigint").alias("n"),
    )


# ---------------------------------------------------------------------------
# F2 + F6/F7 + J7: a training dataset from two materialised feature views -
# the customer's order history (timestamped, as-of, month-bucketed) and the
# customer profile (static) - for every sold line at its ship date.
# ---------------------------------------------------------------------------
DATASET_SQL = """
WITH sp AS (
    SELECT l.l_orderkey, l.l_linenumber, o.o_custkey AS customer_key, CAST(l.l_shipdate AS DATE) AS ship_date
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
), h AS (
    SELECT o_custkey AS customer_key, CAST(o_orderdate AS DATE) AS order_date,
           o_totalprice AS last_order_total, o_orderpriority AS last_order_priority
    FROM orders
    QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE)
                               ORDER BY o_totalprice DESC, o_orderpriority DESC) = 1
)
SELECT sp.l_orderkey, sp.l_linenumber, sp.customer_key, sp.ship_date,
       h.last_order_total, h.last_order_priority,
       c.c_mktsegment AS segment, c.c_nationkey AS nation_key, c.c_acctbal AS acctbal
FROM sp ASOF LEFT JOIN h ON sp.customer_key = h.customer_key AND sp.ship_date >= h.order_date
LEFT JOIN customer c ON c.c_custkey = sp.customer_key
"""


@query("customer_feature_dataset", DATASET_SQL)
def customer_feature_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.operators.features import feature_view, generate_dataset
    from quarry.session import scratch_path

    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = load(spark, sf_dir, "orders")
    spine = li.join(orders.select("o_orderkey", "o_custkey"), li.l_orderkey == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", F.col("o_custkey").alias("customer_key"), F.to_date("l_shipdate").alias("ship_date")
    )
    history = orders.select(
        F.col("o_custkey").alias("customer_key"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("last_order_total"),
        F.col("o_orderpriority").alias("last_order_priority"),
    )
    profile = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_key"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation_key"),
        F.col("c_acctbal").alias("acctbal"),
    )
    root = scratch_path(spark, "feature-store")
    views = [
        feature_view(history, "customer_orders", "customer_key", "order_date", time_bucket="month").materialize(root),
        feature_view(profile, "customer_profile", "customer_key").materialize(root),
    ]
    return generate_dataset(spine, views, "ship_date")


# ---------------------------------------------------------------------------
# F8: latest feature values for given keys (every customer) from the order
# history view (newest order; same-day ties -> larger total, then priority)
# and the static profile view.
# ---------------------------------------------------------------------------
LATEST_FEATURES_SQL = """
WITH h AS (
    SELECT o_custkey AS customer_key, o_totalprice AS last_order_total, o_orderpriority AS last_order_priority
    FROM orders
    QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey
                               ORDER BY CAST(o_orderdate AS DATE) DESC, o_totalprice DESC, o_orderpriority DESC) = 1
)
SELECT c.c_custkey AS customer_key, h.last_order_total, h.last_order_priority,
       c.c_mktsegment AS segment, c.c_nationkey AS nation_key, c.c_acctbal AS acctbal
FROM customer c LEFT JOIN h ON h.customer_key = c.c_custkey
"""


@query("latest_customer_features", LATEST_FEATURES_SQL)
def latest_customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.operators.features import feature_view, latest_features

    orders = load(spark, sf_dir, "orders")
    history = orders.select(
        F.col("o_custkey").alias("customer_key"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("last_order_total"),
        F.col("o_orderpriority").alias("last_order_priority"),
    )
    profile = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_key"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation_key"),
        F.col("c_acctbal").alias("acctbal"),
    )
    keys = profile.select("customer_key")
    views = [
        feature_view(history, "customer_orders", "customer_key", "order_date"),
        feature_view(profile, "customer_profile", "customer_key"),
    ]
    return latest_features(keys, views)

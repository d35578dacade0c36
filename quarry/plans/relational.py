"""Single-operator queries over the order tables: calendar (G1), rate
sampling (P17/G3), key checks (S13/J12), latest row (W2), per-group top-n
(W1), rank pivot (A12), correlation matrix (A16), box summary (A17) and
histogram (A18)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalar import dow_sunday0, hash_int, is_us_holiday, round_half_up
from quarry.operators.calendar import available_days, calendar
from quarry.operators.relational import (
    box_summary,
    corr_matrix,
    exact_quantiles,
    first_n,
    histogram,
    latest_per_key,
    nth_value_cols,
    sample_by_rate,
    surrogate_key,
)
from quarry.plans.common import SQL_HOLIDAY, sql_r
from quarry.plans.registry import query
from quarry.sources.sinks import check_fk, check_unique
from quarry.sources.tables import load

# ---------------------------------------------------------------------------
# G1: the calendar dimension over the span of ship dates (derived from data).
# ---------------------------------------------------------------------------
CAL_SQL = f"""
WITH r AS (SELECT CAST(MIN(l_shipdate) AS DATE) AS lo, CAST(MAX(l_shipdate) AS DATE) AS hi FROM lineitem),
c AS (SELECT CAST(g.d AS DATE) AS d, r.lo FROM r, generate_series(CAST(r.lo AS TIMESTAMP), CAST(r.hi AS TIMESTAMP), INTERVAL 1 DAY) g(d))
SELECT CAST(date_diff('day', lo, d) + 1 AS BIGINT) AS date_key, d AS full_date, strftime(d, '%b') AS month,
       'Q' || CAST(quarter(d) AS VARCHAR) AS quarter, CAST(year(d) AS INTEGER) AS year,
       'FP' || lpad(CAST(month(d) AS VARCHAR), 2, '0') || '-' || CAST(year(d) AS VARCHAR) AS fiscal_period,
       {SQL_HOLIDAY} AS is_holiday, CAST(dayofweek(d) AS INTEGER) AS day_of_week
FROM c
"""


@query("calendar_dim", CAL_SQL)
def calendar_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    lo = li.agg(F.min("l_shipdate")).scalar()
    hi = li.agg(F.max("l_shipdate")).scalar()
    return calendar(spark, lo, hi)


# ---------------------------------------------------------------------------
# Rate-dependent deterministic sample of sales lines.
# Sampling rates in percent (holiday 25, weekend 15, other 8).
# ---------------------------------------------------------------------------
RATES = {"holiday": 25, "weekend": 15, "other": 8}

SAMPLE_SQL = f"""
WITH l AS (
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS d FROM lineitem
), t AS (
    SELECT *, CASE WHEN {SQL_HOLIDAY} THEN 'holiday' WHEN dayofweek(d) IN (0, 6) THEN 'weekend' ELSE 'other' END AS day_type
    FROM l
)
SELECT l_orderkey, l_linenumber, l_partkey, d AS ship_date, day_type
FROM t
WHERE CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey)), 1, 8) AS BIGINT) % 100
      < CASE day_type WHEN 'holiday' THEN {RATES['holiday']} WHEN 'weekend' THEN {RATES['weekend']} ELSE {RATES['other']} END
"""


@query("sales_rate_sample", SAMPLE_SQL)
def sales_rate_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("ship_date")
    )
    d = F.col("ship_date")
    li = li.withColumn(
        "day_type",
        F.when(is_us_holiday(d), "holiday").when(dow_sunday0(d).isin(0, 6), "weekend").otherwise("other"),
    )
    rate = F.when(F.col("day_type") == "holiday", RATES["holiday"]).when(
        F.col("day_type") == "weekend", RATES["weekend"]
    ).otherwise(RATES["other"])
    return sample_by_rate(li, ["l_orderkey", "l_linenumber", "l_partkey"], rate)


# ---------------------------------------------------------------------------
# Declared keys checked, violations counted.
# ---------------------------------------------------------------------------
KEYS_SQL = """
SELECT 'lineitem_pk_orderkey_linenumber' AS check_name, CAST(COUNT(*) AS BIGINT) AS violations
FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1)
UNION ALL SELECT 'lineitem_fk_orders', COUNT(*) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
UNION ALL SELECT 'lineitem_fk_part', COUNT(*) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)
UNION ALL SELECT 'lineitem_fk_supplier', COUNT(*) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_suppkey)
UNION ALL SELECT 'orders_fk_customer', COUNT(*) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
"""


@query("key_checks", KEYS_SQL)
def key_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    orders, part = load(spark, sf_dir, "orders"), load(spark, sf_dir, "part")
    sup, cust = load(spark, sf_dir, "supplier"), load(spark, sf_dir, "customer")

    def n(name, df):
        return df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")

    checks = [
        n("lineitem_pk_orderkey_linenumber", check_unique(li, ["l_orderkey", "l_linenumber"])),
        n("lineitem_fk_orders", check_fk(li.select("l_orderkey"), orders, [("l_orderkey", "o_orderkey")])),
        n("lineitem_fk_part", check_fk(li.select("l_partkey"), part, [("l_partkey", "p_partkey")])),
        n("lineitem_fk_supplier", check_fk(li.select("l_suppkey"), sup, [("l_suppkey", "s_suppkey")])),
        n("orders_fk_customer", check_fk(orders.select("o_custkey"), cust, [("o_custkey", "c_custkey")])),
    ]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


# ---------------------------------------------------------------------------
# Each customer's latest order (ties on the date -> larger order key).
# ---------------------------------------------------------------------------
LATEST_SQL = """
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice, o_orderstatus
FROM orders
QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
"""


@query("latest_order_per_customer", LATEST_SQL)
def latest_order_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_totalprice", "o_orderstatus"
    )
    return latest_per_key(o, "o_custkey", "o_orderdate", tiebreak="o_orderkey").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus"
    )


# ---------------------------------------------------------------------------
# The 3 largest lines per supplier.
# ---------------------------------------------------------------------------
TOPN_SQL = """
SELECT l_suppkey, CAST(rn AS INTEGER) AS rank, l_orderkey, l_linenumber, l_extendedprice
FROM (SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice,
             ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rn
      FROM lineitem)
WHERE rn <= 3
"""


@query("top_lines_per_supplier", TOPN_SQL)
def top_lines_per_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    order = [F.col("l_extendedprice").desc(), F.col("l_orderkey"), F.col("l_linenumber")]
    return first_n(li, "l_suppkey", order, 3, rank_col="rank")


# ---------------------------------------------------------------------------
# First three order dates per customer as columns.
# ---------------------------------------------------------------------------
PIVOT_SQL = """
SELECT o_custkey,
       MAX(CASE WHEN rn = 1 THEN d END) AS order_date_1,
       MAX(CASE WHEN rn = 2 THEN d END) AS order_date_2,
       MAX(CASE WHEN rn = 3 THEN d END) AS order_date_3
FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d,
             ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
WHERE rn <= 3 GROUP BY o_custkey
"""


@query("first_orders_pivot", PIVOT_SQL)
def first_orders_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("d"))
    return nth_value_cols(o, "o_custkey", [F.col("d"), F.col("o_orderkey")], "d", 3, prefix="order_date_")


# ---------------------------------------------------------------------------
# Correlation matrix of the numeric line columns, long form.
# ---------------------------------------------------------------------------
CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

CORR_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {sql_r(f'corr({a}, {b})', 9)} AS r FROM lineitem"
    for a in CORR_COLS
    for b in CORR_COLS
)


@query("line_corr_matrix", CORR_SQL)
def line_corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return corr_matrix(li, CORR_COLS).select("col_a", "col_b", round_half_up("r", 9).alias("r"))


# ---------------------------------------------------------------------------
# Exact five-number summary + mean of retail price per part type.
# ---------------------------------------------------------------------------
BOX_SQL = f"""
SELECT p_type, COUNT(*) AS n,
       {sql_r('MIN(p_retailprice)', 6)} AS min,
       {sql_r('quantile_cont(p_retailprice, 0.25)', 6)} AS q1,
       {sql_r('quantile_cont(p_retailprice, 0.5)', 6)} AS median,
       {sql_r('quantile_cont(p_retailprice, 0.75)', 6)} AS q3,
       {sql_r('MAX(p_retailprice)', 6)} AS max,
       {sql_r('AVG(p_retailprice)', 6)} AS mean
FROM part GROUP BY p_type
"""


@query("retail_price_box", BOX_SQL)
def retail_price_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    b = box_summary(p, "p_type", "p_retailprice")
    return b.select("p_type", "n", *[round_half_up(c, 6).alias(c) for c in ["min", "q1", "median", "q3", "max", "mean"]])


# ---------------------------------------------------------------------------
# 10-bin equal-width histogram of retail price per part type, edges
# from the data's min and max.
# ---------------------------------------------------------------------------
HIST_SQL = """
WITH e AS (SELECT MIN(p_retailprice) AS lo, MAX(p_retailprice) AS hi FROM part)
SELECT p_type,
       CAST(CASE WHEN e.hi - e.lo <= 0 THEN 0 ELSE LEAST(GREATEST(FLOOR((p_retailprice - e.lo) / (e.hi - e.lo) * 10), 0), 9) END AS INTEGER) AS bin,
       COUNT(*) AS n
FROM part, e WHERE p_retailprice IS NOT NULL GROUP BY 1, 2
"""


@query("retail_price_histogram", HIST_SQL)
def retail_price_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    lo = p.agg(F.min("p_retailprice")).scalar()
    hi = p.agg(F.max("p_retailprice")).scalar()
    return histogram(p, "p_type", "p_retailprice", lo, hi, 10)


# ---------------------------------------------------------------------------
# A global ROW_NUMBER() over (order date, order key) as a surrogate key,
# without funnelling the table through one window partition.
# ---------------------------------------------------------------------------
ROWNUM_SQL = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate,
       ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS order_seq
FROM orders
"""


@query("order_sequence_key", ROWNUM_SQL)
def order_sequence_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"))
    return surrogate_key(o, ["o_orderdate", "o_orderkey"], name="order_seq")


# ---------------------------------------------------------------------------
# Generated sales of the parts that are available.  Every part is sold
# from its own first day on; whether on a day, how many and at what mark-up
# are draws keyed by (part, day), so a lost task draws the same again.
# Draws of RATES above; at most 8, 5 or 3 pieces; mark-up 20 to 80 percent.
# ---------------------------------------------------------------------------
SOLD_FROM, LARGE_FROM, SOLD_TO = "1996-01-01", "1996-06-01", "1996-12-31"
MOST = {"holiday": 8, "weekend": 5, "other": 3}


def _sql_draw(seed: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', '{seed}', p_partkey, d)), 1, 8) AS BIGINT)"


GENERATED_SQL = f"""
WITH p AS (SELECT p_partkey, CAST(round(p_retailprice * 100) AS BIGINT) AS cents,
                  CASE WHEN p_size > 40 THEN DATE '{LARGE_FROM}' ELSE DATE '{SOLD_FROM}' END AS first_day FROM part),
c AS (SELECT CAST(unnest(generate_series(DATE '{SOLD_FROM}', DATE '{SOLD_TO}', INTERVAL 1 DAY)) AS DATE) AS d),
t AS (SELECT *, CASE WHEN {SQL_HOLIDAY} THEN 'holiday' WHEN dayofweek(d) IN (0, 6) THEN 'weekend' ELSE 'other' END AS day_type FROM c),
s AS (SELECT * FROM p JOIN t ON d >= first_day)
SELECT p_partkey, d AS day, day_type,
       1 + {_sql_draw('pieces')} % CASE day_type WHEN 'holiday' THEN {MOST['holiday']} WHEN 'weekend' THEN {MOST['weekend']} ELSE {MOST['other']} END AS pieces,
       cents * (120 + {_sql_draw('price')} % 61) // 100 AS unit_cents
FROM s
WHERE {_sql_draw('sale')} % 100 < CASE day_type WHEN 'holiday' THEN {RATES['holiday']} WHEN 'weekend' THEN {RATES['weekend']} ELSE {RATES['other']} END
"""


@query("generated_sales", GENERATED_SQL)
def generated_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part").select(
        "p_partkey",
        F.round(F.col("p_retailprice") * 100).cast("long").alias("cents"),
        F.when(F.col("p_size") > 40, F.lit(LARGE_FROM)).otherwise(F.lit(SOLD_FROM)).cast("date").alias("first_day"),
    )
    d = F.col("day")
    days = available_days(p, F.col("first_day"), SOLD_TO).withColumn(
        "day_type", F.when(is_us_holiday(d), "holiday").when(dow_sunday0(d).isin(0, 6), "weekend").otherwise("other")
    )

    def by_type(values: dict) -> Column:
        return F.when(F.col("day_type") == "holiday", values["holiday"]).when(F.col("day_type") == "weekend", values["weekend"]).otherwise(values["other"])

    def draw(seed: str) -> Column:
        return hash_int(F.lit(seed), F.col("p_partkey"), d)

    sold = sample_by_rate(days, ["p_partkey", "day"], by_type(RATES), seed="sale")
    return sold.select(
        "p_partkey",
        "day",
        "day_type",
        (1 + F.pmod(draw("pieces"), by_type(MOST))).cast("long").alias("pieces"),
        F.floor(F.col("cents") * (120 + F.pmod(draw("price"), F.lit(61))) / 100).cast("long").alias("unit_cents"),
    )


# ---------------------------------------------------------------------------
# A6, A17 on a continuous column: quartiles of the event values per type; each
# type holds a fifth of all rows, more than one task is meant to order.
# ---------------------------------------------------------------------------
ORDERED_AT_ONCE = 500
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
EVENT_QUARTILES_SQL = f"""
SELECT event_type, COUNT(value) AS n, {', '.join(f"{sql_r(f'quantile_cont(value, {q})', 6)} AS {n}" for n, q in QUARTILES.items())}
FROM events WHERE value IS NOT NULL GROUP BY event_type
"""


@query("event_value_quartiles", EVENT_QUARTILES_SQL)
def event_value_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = exact_quantiles(load(spark, sf_dir, "events").select("event_type", "value"), "value", "event_type", QUARTILES, ORDERED_AT_ONCE, bins=100)
    return q.select("event_type", "n", *[round_half_up(c, 6).alias(c) for c in QUARTILES])

"""Stand-in mappings from the reference's tables to the driver tables.

FACT_SALES  -> lineitem (joined to orders only when a customer is needed)
  date = l_shipdate, product = l_partkey, employee = l_suppkey,
  net sales = l_extendedprice * (1 - l_discount),
  discount amount = l_extendedprice * l_discount.
DIM_PRODUCT -> part: category / sub-category = p_type, brand = p_brand.
DIM_CUSTOMER -> customer: loyalty segment = c_mktsegment.
DIM_STORE region -> region of the customer's nation.
DIM_EMPLOYEE -> supplier.

Money is cast to DECIMAL before any multiplication or sum, so totals are
exact and independent of summation order (and equal to the SQL oracle's);
values are cast to DOUBLE only to divide, and rounded last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalar import HOLIDAYS, money
from quarry.sources.tables import load

# SQL fragments shared by the oracles (DuckDB dialect).
def sql_r(expr: str, digits: int = 2) -> str:
    """Oracle twin of ``round_half_up``: round on a decimal, return double."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def sql_money(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(18,2))"


SQL_NET = f"{sql_money('l_extendedprice')} * (1 - {sql_money('l_discount')})"
SQL_DISC_AMT = f"{sql_money('l_extendedprice')} * {sql_money('l_discount')}"

SQL_HOLIDAY = "(" + " OR ".join(
    f"(month(d) = {month} AND day(d) BETWEEN {first} AND {last}" + ("" if weekday is None else f" AND dayofweek(d) = {weekday}") + ")"
    for month, first, last, weekday in HOLIDAYS
) + ")"


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales fact as lineitem columns only (no join).

    Queries add exactly the dimensions they need; an unused inner join to
    orders would cost a full shuffle of the largest table.
    """
    li = load(spark, sf_dir, "lineitem")
    gross = money("l_extendedprice")
    disc = money("l_discount")
    return li.select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_partkey").alias("product_key"),
        F.col("l_suppkey").alias("employee_key"),
        F.to_date("l_shipdate").alias("sale_date"),
        money("l_quantity").alias("quantity"),
        gross.alias("gross"),
        disc.alias("discount"),
        (gross * disc).alias("discount_amount"),
        (gross * (F.lit(1) - disc)).alias("net_sales"),
    )

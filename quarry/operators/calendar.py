"""Generated dimensions.

A calendar is generated from one row by ``explode(sequence(start, end))``:
its size is the number of days in the span, never the size of the data, so
it is safe to broadcast.  ``start``/``end`` may be scalar columns computed
from the data (e.g. ``df.agg(F.min(d)).scalar()``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalar import dow_sunday0, is_us_holiday


def _date(x) -> Column:
    if isinstance(x, Column):
        return x.cast("date")
    if isinstance(x, (dt.date, str)):
        return F.lit(str(x)).cast("date")
    raise TypeError(x)


def calendar(spark: SparkSession, start, end, weekdays_only: bool = False) -> DataFrame:
    """One row per day in [start, end] with calendar attributes.

    ``date_key`` = days since ``start`` + 1 (the row number of the date in
    the calendar, computed without a global window); ``month`` is the
    three-letter month name; the holiday rule is ``is_us_holiday``.
    """
    s, e = _date(start), _date(end)
    days = spark.range(1).select(F.explode(F.sequence(s, e)).alias("full_date"))
    d = F.col("full_date")
    out = days.select(
        (F.datediff(d, s) + 1).cast("long").alias("date_key"),
        d,
        F.date_format(d, "MMM").alias("month"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter"),
        F.year(d).alias("year"),
        F.concat(F.lit("FP"), F.lpad(F.month(d).cast("string"), 2, "0"), F.lit("-"), F.year(d).cast("string")).alias(
            "fiscal_period"
        ),
        is_us_holiday(d).alias("is_holiday"),
        dow_sunday0(d).alias("day_of_week"),
    )
    if weekdays_only:
        out = out.filter(F.weekday("full_date") < 5)
    return out


def mod_label(key, labels: list[str], offset: int = 0) -> Column:
    """Attribute from ``key mod n`` (round-robin assignment)."""
    arr = F.array(*[F.lit(x) for x in labels])
    k = F.col(key) if isinstance(key, str) else key
    return F.element_at(arr, (F.pmod(k + F.lit(offset), F.lit(len(labels))) + 1).cast("int"))


def available_days(df: DataFrame, start: Column, end, day: str = "day") -> DataFrame:
    """Every row once per day from its own ``start`` to ``end``, both included; rows available later, or never, give none.

    No calendar is joined.  A row becomes hundreds, so the rows are dealt to all
    tasks before: a small table is one split, and one task would do all the work
    that follows.
    """
    last = _date(end)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.filter(start <= last).repartition(tasks).withColumn(day, F.explode(F.sequence(start, last)))

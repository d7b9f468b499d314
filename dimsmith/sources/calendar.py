"""Calendar dimension generator (int yyyyMMdd key, Monday = 1, Sat/Sun weekend).

``calendar_from_offsets`` numbers days from 1, so the first date is the day
after ``start`` (the model's row-number generator does the same); it uses
``spark.range`` and is generated in parallel. ``calendar_between`` covers an
inclusive date range whose ends may be scalar subqueries over the data; its
size is the number of days, never the data volume.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimsmith.functions.scalars import date_key, day_in_week, is_weekend


def _attributes(days: DataFrame, c: str = "calendar_date") -> DataFrame:
    d = F.col(c)
    return days.select(
        date_key(d).alias("calendar_sk"),
        d.alias("calendar_date"),
        F.year(d).alias("calendar_year"),
        F.month(d).alias("month_in_year"),
        F.dayofyear(d).alias("day_in_year"),
        F.dayofmonth(d).alias("day_in_month"),
        day_in_week(d).alias("day_in_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        is_weekend(d).alias("is_weekend"))


def _lit_date(d) -> Column:
    if isinstance(d, Column):
        return d
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d)))


def calendar_between(spark: SparkSession, start, end) -> DataFrame:
    days = spark.range(1).select(
        F.explode(F.sequence(_lit_date(start), _lit_date(end))).alias("calendar_date"))
    return _attributes(days)


def calendar_from_offsets(spark: SparkSession, start, n_days: int) -> DataFrame:
    days = spark.range(1, n_days + 1).select(
        F.date_add(_lit_date(start), F.col("id").cast("int")).alias("calendar_date"))
    return _attributes(days)

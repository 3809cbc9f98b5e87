"""Calendar dimension rows generated by Spark, never by a driver loop."""

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vigilo.functions.parse import date_key


def calendar_fields(d: Column) -> list[Column]:
    """date_key, full_date, year, quarter ('YYYYQn'), month, month_name, day,
    day_of_week (name), is_weekend (Saturday/Sunday -> 1)."""
    return [
        date_key(d, guard=False).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string")).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        F.dayofweek(d).isin(1, 7).cast("int").alias("is_weekend"),
    ]


def calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Every day from ``start`` to ``end`` inclusive, spread over ``spark.range``."""
    days = (end - start).days + 1
    d = F.date_add(F.lit(start), F.col("id").cast("int"))
    return spark.range(0, max(days, 0)).select(*calendar_fields(d))


def calendar_spanning(df: DataFrame, date_col: str) -> DataFrame:
    """Every day between the earliest and latest ``date_col`` of ``df``.

    Lazy: min/max is a partial aggregate, the one-row span is expanded with
    ``sequence`` + ``explode`` (bounded by the number of days, not of rows).
    """
    d = F.col(date_col).cast("date")
    span = df.agg(F.min(d).alias("lo"), F.max(d).alias("hi")).filter(F.col("lo").isNotNull())
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(*calendar_fields(F.col("d")))

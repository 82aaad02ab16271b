"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The season of each month; months not listed are Fall.
SEASONS = {"Winter": [12, 1, 2], "Spring": [3, 4, 5], "Summer": [6, 7, 8]}
OTHER_SEASON = "Fall"
HOLIDAY = (12, 25)


def season(day: Column) -> Column:
    expr = F
    for name, months in SEASONS.items():
        expr = expr.when(F.month(day).isin(months), name)
    return expr.otherwise(OTHER_SEASON)


def calendar_columns(day: Column) -> list[Column]:
    month, number = HOLIDAY
    return [
        F.date_format(day, "yyyyMMdd").alias("date_id"),
        day.alias("date"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.dayofmonth(day).alias("day_of_month"),
        F.date_format(day, "MMMM").alias("month"),
        F.month(day).alias("month_number"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        season(day).alias("season"),
        (F.weekday(day) >= 5).alias("is_weekend"),
        ((F.month(day) == month) & (F.dayofmonth(day) == number)).alias("is_holiday"),
    ]

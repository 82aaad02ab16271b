"""Dimension loads and the calendar."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill import schemas
from tiermill.functions.calendar import calendar_columns
from tiermill.functions.predicates import instant
from tiermill.sources.files import read_csv

DIMENSION_FILES = {
    "dim_colors": schemas.COLORS_CSV,
    "dim_branches": schemas.BRANCHES_CSV,
    "dim_employees": schemas.EMPLOYEES_CSV,
    "dim_customers": schemas.CUSTOMERS_CSV,
    "dim_treatments": schemas.TREATMENTS_CSV,
    "dim_date": schemas.DATE_CSV,
}


def load_dimension(
    spark: SparkSession,
    table: str,
    path: str,
    as_of: datetime | Column,
    infer_schema: bool = False,
) -> DataFrame:
    """A dimension from its CSV file, cast to the table's columns and stamped. Cells that do not fit
    their type are null, also where the types were inferred."""
    rows = read_csv(spark, path, None if infer_schema else DIMENSION_FILES[table])
    return schemas.conform(
        rows.withColumn("created_timestamp", instant(as_of)), schemas.TABLES[table], raw=True
    )


def calendar_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day between two date columns of the one-row DataFrame ``bounds``."""
    days = bounds.select(F.explode(F.sequence(F.col(first), F.col(last))).alias("day"))
    return days.select(calendar_columns(F.col("day")))


def build_dim_date(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included, as yyyy-MM-dd."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("first"), F.lit(end).cast("date").alias("last")
    )
    return calendar_between(bounds, "first", "last")

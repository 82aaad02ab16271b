"""Source files to bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tiermill import schemas
from tiermill.sources.files import read_csv


def bronze_instagram(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.INSTAGRAM_CSV)


def bronze_inventory(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.INVENTORY_CSV)

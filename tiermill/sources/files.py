"""CSV batches with a declared or an inferred schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """CSV with a header row. A cell that does not fit its type becomes null.

    Without ``schema`` the types are inferred, at the price of one more pass over the file.
    ``keep_corrupt`` adds a column with the text of every line that did not fit.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


def preview(df: DataFrame, rows: int = 5) -> None:
    """Print the schema and a few rows."""
    df.printSchema()
    df.show(rows, truncate=False)

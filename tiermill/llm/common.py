"""What several operators share: reading, bounded Arrow batches, checked broadcasts, places in groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiermill.session import written

# Rows handed to Python at once. Texts differ in length by a factor of thousands, so batches are
# kept short; the memory a task needs is this many texts.
BATCH_ROWS = 256

# Rows and bytes up to which a side may be broadcast.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 48 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def short_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def broadcast_if_small(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` marked for broadcasting if it was counted to be small enough; otherwise as it is, for
    the join that Spark chooses. ``df`` should be cheap to read (a written table)."""
    most = min(BROADCAST_ROWS, BROADCAST_BYTES // row_bytes)
    return F.broadcast(df) if df.count() <= most else df


def with_address(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once, with the file and the row in it as ``_file`` and ``_row``.

    The address tells apart rows that are equal in all columns, and stays the same when a task is
    run again.
    """
    return written(df, label).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )


def place_within(addressed: DataFrame, *keys: str, name: str = "place") -> DataFrame:
    """Numbers from 0 without gaps within each key, in the order of the addresses.

    Only the rows of one key in one file meet in a task; what the files before it hold is one row per
    key and file. So a key may hold a third of all rows.
    """
    held = addressed.groupBy(*keys, "_file").agg(F.count(F.lit(1)).alias("_held"))
    before = Window.partitionBy(*keys).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select(
        *keys, "_file", F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_before")
    )
    here = Window.partitionBy(*keys, "_file").orderBy("_row")
    numbered = addressed.withColumn("_here", F.row_number().over(here) - 1)
    same = [numbered[k].eqNullSafe(offsets[k]) for k in (*keys, "_file")]
    condition = same[0]
    for one in same[1:]:
        condition = condition & one
    return numbered.join(offsets, condition).select(
        *[numbered[c] for c in addressed.columns],
        (F.col("_here") + F.col("_before")).cast("bigint").alias(name),
    )


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")

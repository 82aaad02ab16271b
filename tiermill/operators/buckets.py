"""Tables cut into buckets by a hash of their key, of which an update rewrites those that it touches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.operators.lookups import HOT_KEY_ROWS, lookup_all
from tiermill.session import written
from tiermill.sources.tables import TableStore

BUCKET = "key_bucket"
# A power of two or not; many more than the tasks of a job, so that few updated keys touch few of them.
BUCKETS = 1024
PROPERTY = "tiermill.buckets"


def with_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def touched_buckets(df: DataFrame) -> list[int]:
    """The buckets of the rows, at most as many as the table has."""
    return sorted(row[0] for row in df.select(BUCKET).distinct().collect())


def create_bucketed(
    store: TableStore, df: DataFrame, table: str, key: str, buckets: int = BUCKETS
) -> None:
    """Create a table partitioned by the bucket of ``key``; the number of buckets is kept with it. Rows
    without a key have a bucket as well."""
    store.write(with_bucket(df, key, buckets), table, "create", partition_by=[BUCKET])
    store.set_property(table, PROPERTY, str(buckets))


def bucket_count(store: TableStore, table: str) -> int:
    found = store.property(table, PROPERTY)
    if found is None:
        raise ValueError(f"{table} is not cut into buckets; make it with create_bucketed")
    return int(found)


def rewrite_touched(
    store: TableStore, table: str, key: str, arrived: DataFrame, rebuild, hot_key_rows: int = HOT_KEY_ROWS
) -> list[int]:
    """Rewrite the buckets that hold keys of ``arrived``, and return their numbers.

    ``rebuild(stored, arrived)`` gives the new rows of the keys that ``arrived`` has from their stored
    ones; other rows of the same buckets are carried over. Files of other buckets are neither read nor
    written. Rows of ``arrived`` without a key are left out. Run again with the same rows after a
    failure, it finds some buckets new and some old; ``rebuild`` has to give the same for both.
    """
    buckets = bucket_count(store, table)
    arrived = written(with_bucket(arrived.filter(F.col(key).isNotNull()), key, buckets), "arrived")
    numbers = touched_buckets(arrived)
    if not numbers:
        return []
    stored = store.read(table).filter(F.col(BUCKET).isin(numbers)).drop(BUCKET)
    keys = arrived.select(key).distinct().withColumn("_arrived", F.lit(True))
    marked = lookup_all(stored, [(keys, [key])], "left", hot_key_rows=hot_key_rows, reused=True)
    renewed = rebuild(marked.filter("_arrived").drop("_arrived"), arrived.drop(BUCKET))
    carried = marked.filter("_arrived IS NULL").drop("_arrived")
    # The table is read to make the rows, so they are complete before its files are replaced.
    rows = written(with_bucket(carried.unionByName(renewed), key, buckets), "buckets")
    store.write(rows, table, "overwrite_partitions")
    return numbers

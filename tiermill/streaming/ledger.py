"""Which stored batches are in a table already, and which of its days a change reaches."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.schemas import TABLES
from tiermill.session import hadoop_path, written
from tiermill.sources.tables import NO_VALUE, TableStore, in_days
from tiermill.streaming.ratings import BATCH, DAY, RUN, STORED, read_batches

LEDGER = "bronze_ratings_batches"
# The file that ends a complete write.
COMPLETE = "_SUCCESS"


@dataclass(frozen=True)
class Batch:
    """A complete batch folder; ``stamp`` changes when it is written again."""

    run_id: str
    batch_id: int
    stamp: int


def _folders(spark: SparkSession, path: str, column: str) -> dict[str, str]:
    """Value and path of the partition folders of one column below ``path``."""
    folder, files = hadoop_path(spark, path)
    if not files.exists(folder):
        return {}
    found = {}
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{column}="):
            found[name.partition("=")[2]] = status.getPath().toString()
    return found


def complete_batches(spark: SparkSession, path: str) -> dict[Batch, str]:
    """The batches below ``path`` whose write has ended, with their folders. Only folders are listed:
    one call a batch, whatever the batches hold."""
    found = {}
    for run, of_run in _folders(spark, path, RUN).items():
        for number, folder in _folders(spark, of_run, BATCH).items():
            mark, files = hadoop_path(spark, f"{folder}/{COMPLETE}")
            if files.exists(mark):
                stamp = files.getFileStatus(mark).getModificationTime()
                found[Batch(run, int(number), stamp)] = folder
    return found


def _day(value: str) -> date | None:
    return None if value == NO_VALUE else date.fromisoformat(value)


def merge_batches(store: TableStore, path: str) -> dict[str, int]:
    """Bring ``bronze_ratings`` up to the complete batches of the stream below ``path``.

    The ledger holds a row for each merged batch and day. A batch that is not in it, was written again or
    is gone makes its days stale; only these are read, from all complete batches, and replaced as a
    whole, and days without a row left are dropped. The ledger is written last, so a run that was cut
    short is done again and gives the same rows. Without a change nothing is written. Returns how many
    batches and days were merged.
    """
    spark = store.spark
    for table in ("bronze_ratings", LEDGER):
        store.create(table)
    ledger = store.read(LEDGER)
    present = complete_batches(spark, path)
    # One row per batch: bounded by the number of triggers, not by the data.
    merged = {
        Batch(r[RUN], r[BATCH], r["stamp"])
        for r in ledger.filter("stamp IS NOT NULL").select(RUN, BATCH, "stamp").distinct().collect()
    }
    fresh, stale = set(present) - merged, merged - set(present)
    if not fresh and not stale:
        return {"batches": 0, "days": 0}
    entries = [
        (b.run_id, b.batch_id, _day(value), b.stamp)
        for b in fresh
        for value in _folders(spark, present[b], DAY)
    ]
    schema = TABLES[LEDGER]
    number = (ledger.agg(F.max("merge_id")).first()[0] or 0) + 1
    rows = [(*entry, number) for entry in entries]
    gone = spark.createDataFrame([(b.run_id, b.batch_id, b.stamp) for b in stale], _KEY)
    kept = ledger.join(F.broadcast(gone), [RUN, BATCH, "stamp"], "left_anti")
    left = ledger.join(F.broadcast(gone), [RUN, BATCH, "stamp"], "left_semi")
    lost = [r["event_date"] for r in left.select("event_date").distinct().collect()]
    days = sorted({day for _, _, day, _ in entries} | set(lost), key=str)
    # Days that were lost are kept with the number of this merge, for those who follow the ledger.
    rows += [(None, None, day, None, number) for day in lost]
    ledger = written(kept.unionByName(spark.createDataFrame(rows, schema)), "ledger")

    complete = ledger.filter("stamp IS NOT NULL").select(RUN, BATCH).distinct()
    stored = read_batches(spark, path, STORED).filter(in_days("event_date", days))
    stored = stored.join(F.broadcast(complete), [RUN, BATCH], "left_semi").drop(RUN, BATCH)
    if days:
        store.write(stored, "bronze_ratings", "overwrite_partitions")
    held = ledger.filter("stamp IS NOT NULL").filter(in_days("event_date", days))
    there = {r["event_date"] for r in held.select("event_date").distinct().collect()}
    empty = [day for day in days if day not in there]
    if empty:
        store.drop_partitions("bronze_ratings", empty)
    store.write(ledger, LEDGER, "replace")
    return {"batches": len(fresh) + len(stale), "days": len(days)}


_KEY = f"{RUN} string, {BATCH} bigint, stamp bigint"


def changed_days(store: TableStore, since: int) -> tuple[list[date | None], int]:
    """The days of ``bronze_ratings`` that merges after number ``since`` reached, and the number of the
    last merge, to ask with the next time."""
    ledger = store.read(LEDGER)
    days = ledger.filter(F.col("merge_id") > since).select("event_date").distinct()
    last = ledger.agg(F.max("merge_id")).first()[0] or since
    return sorted((r["event_date"] for r in days.collect()), key=str), last


def ledger(store: TableStore) -> DataFrame:
    """The merged batches, one row for each batch and day."""
    return store.read(LEDGER).filter("stamp IS NOT NULL")

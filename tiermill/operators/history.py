"""Type-2 histories: from dated events, and from attribute changes; as a whole, or kept up bucket by
bucket."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.functions.predicates import instant
from tiermill.operators.buckets import BUCKETS, create_bucketed, rewrite_touched
from tiermill.operators.cleaning import keep_newest
from tiermill.operators.numbering import (
    HOT_GROUP_ROWS,
    cut_groups,
    group_sizes,
    number_cut,
    number_within,
)
from tiermill.sources.tables import TableStore

ATTRIBUTES = ["first_name", "last_name", "email", "phone", "address", "city"]


def scd2_from_events(
    ratings: DataFrame, as_of: datetime | Column, hot_group_rows: int = HOT_GROUP_ROWS
) -> DataFrame:
    """One customer version per rating: it starts on the rating date and ends on the next one.

    Ratings of one day are ordered by ``rating_id``; all but the last of them start and end that day.
    The name and contact columns are null.
    """
    return _event_versions(ratings, instant(as_of), [], hot_group_rows)


def _event_versions(ratings, stamp: Column, more: list[str], hot_group_rows: int) -> DataFrame:
    versions = number_within(
        ratings.select("customer_id", "rating_date", "rating_id", stamp.alias("created_timestamp")),
        keys=["customer_id"],
        order=["rating_date", "rating_id"],
        number="version_id",
        following={"end_date": "rating_date"},
        hot_group_rows=hot_group_rows,
    )
    return versions.select(
        "customer_id",
        "version_id",
        *[F.lit(None).cast("string").alias(name) for name in ATTRIBUTES],
        F.col("rating_date").alias("start_date"),
        "end_date",
        F.col("end_date").isNull().alias("is_current"),
        "created_timestamp",
        *more,
    )


def create_event_history(
    store: TableStore, table: str, ratings: DataFrame, as_of: datetime | Column, buckets: int = BUCKETS
) -> None:
    """Store the versions of ``scd2_from_events`` by the bucket of the customer, with their
    ``rating_id``, so that ``update_event_history`` can go on."""
    rows = _event_versions(ratings, instant(as_of), ["rating_id"], HOT_GROUP_ROWS)
    create_bucketed(store, rows, table, "customer_id", buckets)


def update_event_history(
    store: TableStore,
    table: str,
    ratings: DataFrame,
    as_of: datetime | Column,
    hot_group_rows: int = HOT_GROUP_ROWS,
) -> list[int]:
    """Add ratings to a stored history, also late ones, and return the buckets that were rewritten.

    The versions of the customers concerned are numbered anew, as ``scd2_from_events`` over all ratings
    would; versions that were there keep their stamp. A rating that is there already (same customer, day
    and ``rating_id``) changes nothing.
    """

    def rebuild(stored: DataFrame, arrived: DataFrame) -> DataFrame:
        event = ["customer_id", "start_date", "rating_id"]
        known = stored.select(*event, "created_timestamp")
        new = arrived.select("customer_id", F.col("rating_date").alias("start_date"), "rating_id")
        every = known.unionByName(new.withColumn("created_timestamp", instant(as_of)))
        once = every.groupBy(*event).agg(F.min("created_timestamp").alias("created_timestamp"))
        once = once.withColumnRenamed("start_date", "rating_date")
        return _event_versions(once, F.col("created_timestamp"), ["rating_id"], hot_group_rows)

    return rewrite_touched(store, table, "customer_id", ratings, rebuild, hot_group_rows)


def create_history(
    store: TableStore, table: str, current: DataFrame, key: str, tracked: list[str], as_of, buckets=BUCKETS
) -> None:
    """Store a type-2 table by the bucket of its key, with all columns that updates maintain."""
    nothing = current.select(key, *tracked, F.col("start_date").alias("effective_date")).limit(0)
    whole = scd2_from_changes(current, nothing, key, tracked, as_of)
    create_bucketed(store, whole, table, key, buckets)


def update_history(
    store: TableStore,
    table: str,
    updates: DataFrame,
    key: str,
    tracked: list[str],
    as_of: datetime | Column,
    newest_by: list[str] | None = None,
    hot_group_rows: int = HOT_GROUP_ROWS,
) -> list[int]:
    """Apply attribute updates to a stored history as ``scd2_from_changes`` does, and return the buckets
    that were rewritten. Only versions of the keys that have updates are worked on, and applying the same
    updates again changes nothing."""

    def rebuild(stored: DataFrame, arrived: DataFrame) -> DataFrame:
        return scd2_from_changes(
            stored, arrived, key, tracked, as_of, newest_by, hot_group_rows
        ).select(stored.columns)

    return rewrite_touched(store, table, key, updates, rebuild, hot_group_rows)


VERSIONING = ["version_id", "start_date", "end_date", "is_current", "created_timestamp"]


def scd2_from_changes(
    current: DataFrame,
    updates: DataFrame,
    key: str,
    tracked: list[str],
    as_of: datetime | Column,
    newest_by: list[str] | None = None,
    hot_group_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Apply attribute updates to a type-2 table and return the whole new table.

    ``current`` holds key, tracked columns, version_id and start_date, and may hold end_date,
    created_timestamp and any other columns; ``updates`` holds key, tracked columns and effective_date.
    An update that repeats the version in force on its date changes nothing. Any other opens a version
    on its date, also when it is late and falls between two existing versions or after one that was
    closed. A version ends where the next one starts, or before that on a stored end date. Of several
    updates of a key with one date the highest by ``newest_by`` counts.

    Existing versions keep their number, their stamp and all other columns and are never removed; new
    ones are numbered after them by date. A column that ``updates`` lacks is taken from the key's
    newest existing version.
    """
    rest = [c for c in current.columns if c not in (key, *tracked, *VERSIONING)]
    now = instant(as_of)
    stamp = F.col("created_timestamp") if "created_timestamp" in current.columns else now
    old = F.col("version_id").cast("bigint").alias("_old")
    stored = current.select(
        key, *tracked, *rest, "start_date", F.lit(1).alias("_origin"), old,
        F.lit(0).alias("_closing"), stamp.alias("_stamp"),
    )
    events = stored
    if "end_date" in current.columns:
        # A stored end is an event of its own: it ends what is in force, whatever follows. It comes
        # before what starts on that day, but after a version of no length that it closes itself.
        nothing = [F.lit(None).cast(current.schema[c].dataType).alias(c) for c in (*tracked, *rest)]
        short = F.col("end_date") <= F.col("start_date")
        closings = current.filter("end_date IS NOT NULL").select(
            key, *nothing, F.greatest("start_date", "end_date").alias("start_date"),
            F.when(short, 1).otherwise(0).alias("_origin"), old, F.lit(1).alias("_closing"),
            F.lit(None).cast("timestamp").alias("_stamp"),
        )
        events = events.unionByName(closings)
    given = [c for c in rest if c in updates.columns]
    newest = F.struct("start_date", "version_id")
    held = current.groupBy(key).agg(
        F.max("version_id").cast("bigint").alias("_most"),
        *[F.max_by(F.struct(c), newest).alias(f"_rest_{c}") for c in rest if c not in given],
    )
    # Updates bring what a new version takes from the stored ones of its key, so that all rows can go
    # through the steps below together. No two have one date, so ``_old`` never orders them.
    dated = keep_newest(updates, [key, "effective_date"], newest_by or tracked)
    dated = dated.join(held, key, "left").select(
        key, *tracked, *given, *[F.col(f"_rest_{c}")[c].alias(c) for c in rest if c not in given],
        F.col("effective_date").alias("start_date"), F.lit(2).alias("_origin"),
        F.coalesce("_most", F.lit(0)).cast("bigint").alias("_old"), F.lit(0).alias("_closing"),
        now.alias("_stamp"),
    )
    # What is tracked comes last: rows without a number of their own always stand in the same order.
    in_time = ["start_date", "_origin", "_old", "_closing", *tracked]
    closes = F.col("end_date").isNotNull().cast("int") if "end_date" in current.columns else F.lit(0)
    keys = current.select(key, (closes + 1).alias("_rows")).unionAll(updates.select(key, F.lit(1)))
    # Nothing below adds rows to a group, so one cut of the groups serves all steps.
    sizes = group_sizes(keys, [key], F.col("_rows"))
    events = cut_groups(events.unionByName(dated), [key], in_time, hot_group_rows, sizes)
    state = F.when(F.col("_closing") == 0, F.struct(*tracked))
    compared = number_cut(events.withColumn("_state", state), [key], in_time, previous={"_before": "_state"})
    opened = F.col("_origin") == 2
    kept = compared.filter(~(opened & F.col("_before").eqNullSafe(F.col("_state")))).drop("_before", "_state")
    ended = number_cut(
        kept, [key], in_time, number="_nth", following={"_end": "start_date"}, counted=opened
    )
    return ended.filter("_closing = 0").select(
        key, F.when(opened, F.col("_old") + F.col("_nth")).otherwise(F.col("_old")).alias("version_id"),
        *tracked, *rest, "start_date", F.col("_end").alias("end_date"),
        F.col("_end").isNull().alias("is_current"), F.col("_stamp").alias("created_timestamp"),
    )

"""Row numbers over a table partitioned by days, kept when other days change."""

from __future__ import annotations

from datetime import date
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermill.operators.numbering import number_all
from tiermill.session import written
from tiermill.sources.tables import TableStore, in_days

PLACE = "day_place"


def _ledger(table: str) -> str:
    return f"{table}_days"


def _offsets(counts: dict[date | None, int]) -> dict[date | None, int]:
    """Rows before each day; a row without a day comes first, as nulls do when rows are sorted."""
    days = sorted(counts, key=lambda day: (day is not None, day or date.min))
    before = accumulate((counts[day] for day in days), initial=0)
    return dict(zip(days, before))


def renumber(
    store: TableStore,
    table: str,
    rows: DataFrame,
    days: list[date | None],
    day: str,
    order: list[str],
    number: str,
) -> dict[str, int]:
    """Replace ``days`` of a table by their rows in ``rows``, numbered as ``number_all`` by day and then
    ``order`` would number the whole table. Returns how many days were sorted, and how many shifted.

    A ledger keeps the rows of each day, so a day's numbers begin after those of the days before it
    without reading these. Of the other days, only those whose numbers move are rewritten: their places
    within the day are stored, and the new number is the day's offset and the place, however often this
    is done. Days of ``days`` without rows are dropped. The ledger is written last; a run that was cut
    short is repeated with the same days.
    """
    counts: dict[date | None, int] = {}
    if store.exists(_ledger(table)):
        # One row per day.
        counts = {r[0]: r[1] for r in store.read(_ledger(table)).collect()}
    before = _offsets(counts)
    sorted_rows = number_all(rows.filter(in_days(day, days)), [day, *order], "_nth")
    fresh = {r[0]: r[1] for r in sorted_rows.groupBy(day).count().collect()}
    gone = [d for d in days if d in counts and d not in fresh]
    counts = {d: n for d, n in counts.items() if d not in days} | fresh
    after = _offsets(counts)
    first = _offsets(fresh)
    moved = [d for d in counts if d not in fresh and after[d] != before[d]]

    kind = rows.schema[day].dataType
    fields = [T.StructField(day, kind), T.StructField("_offset", T.LongType())]
    schema = T.StructType([*fields, T.StructField("_first", T.LongType())])
    # One row per day that is written.
    starts = store.spark.createDataFrame(
        [(d, after[d], first.get(d, 0)) for d in [*fresh, *moved]], schema
    )
    same = [F.col(day).eqNullSafe(F.col("_day"))]
    starts = F.broadcast(starts.withColumnRenamed(day, "_day"))
    placed = sorted_rows.join(starts, same).withColumn(PLACE, F.col("_nth") - F.col("_first"))
    columns = [*rows.columns, PLACE, (F.col("_offset") + F.col(PLACE)).alias(number)]
    written_rows = placed.select(columns)
    if moved:
        shifted = store.read(table).drop(number).filter(in_days(day, moved)).join(starts, same)
        written_rows = written_rows.unionByName(shifted.select(columns))
    if fresh or moved:
        # The table may be read to make the rows, so they are complete before its files are replaced.
        store.write(written(written_rows, "numbered-days"), table, "overwrite_partitions", [day])
    if gone:
        store.drop_partitions(table, gone)
    held = T.StructType([fields[0], T.StructField("row_count", T.LongType())])
    ledger = store.spark.createDataFrame(list(counts.items()), held)
    store.write(ledger, _ledger(table), "replace")
    return {"sorted": len(fresh), "shifted": len(moved)}

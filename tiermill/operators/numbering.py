"""Row numbers that do not funnel rows through one task: over all rows, and within groups of any size.

Both run on range slices. A range partitioner cuts the sort order into slices of similar size
wherever the cut falls, also inside a hot group, as long as the order is total. Slice numbers depend
on sampled bounds, so the slices are written once to the shared folder before anything refers to them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiermill.session import written

# Rows of one group that one task may sort; also the aim for the rows of a slice.
HOT_GROUP_ROWS = 5_000_000

# The columns with the number of a row's slice, and whether its group may go on in another slice.
SLICE, CUT_OFF = "_slice", "_cut_off"

# monotonically_increasing_id() holds the task number above 33 bits of row position.
_POSITION_BITS = 33


def slices(df: DataFrame, rows: int) -> int:
    """Into how many range slices ``rows`` rows go: at most HOT_GROUP_ROWS or so each."""
    shuffle_tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(shuffle_tasks, math.ceil(rows / HOT_GROUP_ROWS))


def number_all(df: DataFrame, order: list[str], number: str, rows: int | None = None) -> DataFrame:
    """Add 1..n over the whole DataFrame in the order of ``order`` (runs a job to write the slices).

    Rows are range-partitioned and sorted; only one count per slice meets in a single task. The number
    of slices follows from ``rows``, an upper bound if the caller has one; else the rows are written
    and counted first. ``order`` should be a total order, or tied rows may swap numbers between runs.
    """
    if rows is None:
        df = written(df, "unnumbered")
        rows = df.count()
    sliced = df.repartitionByRange(slices(df, rows), *order).sortWithinPartitions(*order)
    placed = written(sliced.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    slice_no = F.shiftright("_place", _POSITION_BITS)
    position = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))

    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice: bounded by the number of write tasks, whatever the size of the data.
    starts = (
        placed.groupBy(slice_no.alias("_slice"))
        .agg(F.count("*").alias("_rows"))
        .select("_slice", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    return (
        placed.withColumn("_slice", slice_no)
        .join(F.broadcast(starts), "_slice")
        .withColumn(number, F.col("_before") + position + 1)
        .drop("_place", "_slice", "_before")
    )


def group_sizes(df: DataFrame, keys: list[str], rows: Column | None = None) -> tuple[int, int]:
    """Rows of the largest group, and of all groups (runs a job that reads the keys only). A row counts as
    ``rows`` rows, by default as one."""
    counts = df.groupBy(*keys).agg((F.count("*") if rows is None else F.sum(rows)).alias("n"))
    largest, total = counts.agg(F.max("n"), F.sum("n")).first()
    return largest or 0, total or 0


def number_within(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    number: str | None = None,
    previous: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
    hot_group_rows: int = HOT_GROUP_ROWS,
    sizes: tuple[int, int] | None = None,
) -> DataFrame:
    """Row number, previous and next values within each group, ascending by ``order``.

    ``previous`` and ``following`` map new column names to the columns to look up one row back or
    ahead. If no group has more than ``hot_group_rows`` rows this is an ordinary window; otherwise the
    groups are cut into slices and the numbers are carried over the cuts. Both give the same rows.
    ``sizes`` is an upper bound of ``group_sizes`` if the caller has one; else they are counted here
    (runs a job).
    """
    cut = cut_groups(df, keys, order, hot_group_rows, sizes)
    return number_cut(cut, keys, order, number, previous, following).drop(SLICE, CUT_OFF)


def cut_groups(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    hot_group_rows: int = HOT_GROUP_ROWS,
    sizes: tuple[int, int] | None = None,
) -> DataFrame:
    """The rows for ``number_cut``: as they are if no group has more than ``hot_group_rows`` rows, otherwise
    cut into range slices and written with the number of their slice in ``SLICE`` (runs jobs). All
    numberings of the rows, or of some of them, by the same keys and order can share one cut.

    ``CUT_OFF`` holds for the groups with a slice's lowest or highest first key, and those without one.
    Only they can reach over the ends of a slice.
    """
    largest, total = sizes or group_sizes(df, keys)
    if largest <= hot_group_rows:
        return df
    ranges = df.repartitionByRange(slices(df, total), *keys, *order)
    sliced = written(ranges.withColumn(SLICE, F.spark_partition_id()), "sliced")
    first = F.col(keys[0])
    ends = sliced.groupBy(SLICE).agg(F.min(first).alias("_low"), F.max(first).alias("_high"))
    cut_off = first.isNull() | (first == F.col("_low")) | (first == F.col("_high"))
    held = sliced.join(F.broadcast(written(ends, "slice-ends")), SLICE)
    return held.select(*sliced.columns, cut_off.alias(CUT_OFF))


def number_cut(
    cut: DataFrame,
    keys: list[str],
    order: list[str],
    number: str | None = None,
    previous: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
    counted: Column | None = None,
) -> DataFrame:
    """``number_within`` for rows from ``cut_groups``, which keep their slices; rows may have been dropped
    since. With ``counted`` only rows for which it holds count for ``number``; others repeat the number
    before theirs, from 0."""
    columns = (number, previous or {}, following or {}, counted)
    if SLICE in cut.columns:
        return _number_sliced_groups(cut, keys, order, *columns)
    return _number_whole_groups(cut, keys, order, *columns)


def _nth(window, counted: Column | None) -> Column:
    if counted is None:
        return F.row_number().over(window).cast("bigint")
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.count(F.when(counted, 1)).over(so_far)


def _number_whole_groups(df, keys, order, number, previous, following, counted):
    group = Window.partitionBy(*keys).orderBy(*order)
    columns = {name: F.lag(c).over(group) for name, c in previous.items()}
    columns |= {name: F.lead(c).over(group) for name, c in following.items()}
    if number:
        columns[number] = _nth(group, counted)
    return df.withColumns(columns)


def _number_sliced_groups(sliced, keys, order, number, previous, following, counted):
    # (slice, group) pieces are no larger than a slice, so no task gets a whole hot group. CUT_OFF splits
    # none of them; with it Spark filters by it before it makes the windows.
    piece = Window.partitionBy(SLICE, CUT_OFF, *keys).orderBy(*order)
    local = {f"_lag_{name}": F.lag(c).over(piece) for name, c in previous.items()}
    local |= {f"_lead_{name}": F.lead(c).over(piece) for name, c in following.items()}
    if previous:
        local["_first"] = F.lag(F.lit(True)).over(piece).isNull()
    if following:
        local["_last"] = F.lead(F.lit(True)).over(piece).isNull()
    if number:
        local["_nth"] = _nth(piece, counted)
    pieces = sliced.withColumns(local)
    looked_up = sorted({*previous.values(), *following.values()})
    edges = _slice_edges(pieces.filter(CUT_OFF), keys, order, looked_up, bool(number))
    joined = pieces.join(F.broadcast(edges), SLICE, "left")

    key, edge = F.struct(*keys), F.col("_edge")
    continued = key.eqNullSafe(edge["head_key"]) & key.eqNullSafe(edge["before"]["key"])
    continues = key.eqNullSafe(edge["tail_key"]) & key.eqNullSafe(edge["after"]["key"])
    out = [F.col(c) for c in sliced.columns]
    for name, c in previous.items():
        carried = F.when(F.col("_first") & continued, edge["before"]["values"][c])
        out.append(carried.otherwise(F.col(f"_lag_{name}")).alias(name))
    for name, c in following.items():
        carried = F.when(F.col("_last") & continues, edge["after"]["values"][c])
        out.append(carried.otherwise(F.col(f"_lead_{name}")).alias(name))
    if number:
        before = F.when(continued, edge["rows_before"]).otherwise(F.lit(0))
        out.append((before + F.col("_nth")).cast("bigint").alias(number))
    return joined.select(out)


def _slice_edges(pieces, keys, order, looked_up, numbered):
    """One row per slice: the groups at its two ends, and what the slices next to it hold of them. Of a
    slice only its first and its last row count; the last one's number is that of its group's rows. A
    slice without rows of groups that may be cut off has no row; its groups are whole."""
    rank = F.struct(*keys, *order, *(["_nth"] if numbered else []))
    row = [F.struct(*keys).alias("key"), F.struct(*(looked_up or keys)).alias("values")]
    row += [F.col("_nth").alias("rows")] if numbered else []
    ends = pieces.groupBy(SLICE).agg(
        F.min_by(F.struct(*row), rank).alias("head"), F.max_by(F.struct(*row), rank).alias("tail")
    )
    by_slice = Window.orderBy(SLICE)
    edge = [
        F.col("head")["key"].alias("head_key"),
        F.col("tail")["key"].alias("tail_key"),
        F.lag("tail").over(by_slice).alias("before"),
        F.lead("head").over(by_slice).alias("after"),
    ]
    if numbered:
        # A group that reaches into a slice is the tail of every slice before it that holds any of it.
        ends = ends.withColumn("tail_key", F.col("tail")["key"]).withColumn(
            "tail_total",
            F.sum(F.col("tail")["rows"]).over(Window.partitionBy("tail_key").orderBy(SLICE)),
        )
        edge.append(F.lag("tail_total").over(by_slice).alias("rows_before"))
    return ends.select(SLICE, F.struct(*edge).alias("_edge"))

"""Aggregates that are kept as partial states by day, and merged from those."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.session import written
from tiermill.sources.tables import TableStore, in_days

MONTH = "state_month"


@dataclass(frozen=True)
class Total:
    """The sum of a column."""

    name: str
    column: str

    def partial(self) -> list[Column]:
        return [F.sum(self.column).alias(self.name)]

    def merged(self) -> list[Column]:
        return [F.sum(self.name).alias(self.name)]

    def final(self) -> Column:
        return F.col(self.name)


@dataclass(frozen=True)
class Count(Total):
    """The number of rows in which a column is not null."""

    def partial(self) -> list[Column]:
        return [F.count(self.column).alias(self.name)]


@dataclass(frozen=True)
class Average:
    """The mean of a column, kept as its sum and count."""

    name: str
    column: str

    def partial(self) -> list[Column]:
        return [
            F.sum(F.col(self.column).cast("double")).alias(f"{self.name}_sum"),
            F.count(self.column).alias(f"{self.name}_count"),
        ]

    def merged(self) -> list[Column]:
        return [F.sum(f"{self.name}_{part}").alias(f"{self.name}_{part}") for part in ("sum", "count")]

    def final(self) -> Column:
        return (F.col(f"{self.name}_sum") / F.col(f"{self.name}_count")).alias(self.name)


@dataclass(frozen=True)
class Newest:
    """A column of the row that is the last one by ``by``, null being the lowest."""

    name: str
    column: str
    by: list[str] = field(hash=False)

    def partial(self) -> list[Column]:
        return [F.max(F.struct(*self.by, F.col(self.column).alias("_value"))).alias(self.name)]

    def merged(self) -> list[Column]:
        return [F.max(self.name).alias(self.name)]

    def final(self) -> Column:
        return F.col(self.name)["_value"].alias(self.name)


Measure = Total | Average | Newest


class DailyState:
    """One row per day and key in a table partitioned by days, and one per month and key in another.

    Both have the same partial states, so a change of some days reads these days of the source, and
    the days of their months from the state; the result is merged from the months.
    """

    def __init__(self, store: TableStore, table: str, day: str, keys: list[str], measures: list[Measure]):
        self.store, self.table, self.day, self.keys, self.measures = store, table, day, keys, measures
        self.months = f"{table}_months"

    def _parts(self, which: str) -> list[Column]:
        return [part for measure in self.measures for part in getattr(measure, which)()]

    def refresh(self, source: DataFrame, days: list[date | None] | None = None) -> None:
        """Take over the given days of ``source``, all if none are given: days with rows replace what was
        kept of them, days without are dropped. Cut short and run again it gives the same states."""
        rows = source if days is None else source.filter(in_days(self.day, days))
        partial = rows.groupBy(self.day, *self.keys).agg(*self._parts("partial"))
        partial = written(partial, "state")
        if days is None:
            for table in (self.table, self.months):
                self.store.drop(table)
        self.store.write(partial, self.table, "overwrite_partitions", [self.day])
        if days is not None:
            filled = {r[0] for r in partial.select(self.day).distinct().collect()}
            self.store.drop_partitions(self.table, [day for day in days if day not in filled])
        self._refresh_months(days)

    def _refresh_months(self, days: list[date | None] | None) -> None:
        month = F.date_format(self.day, "yyyy-MM")
        states = self.store.read(self.table)
        names = None
        if days is not None:
            names = sorted({None if day is None else f"{day:%Y-%m}" for day in days}, key=str)
            # An expression of the partition column: other months' folders are not read.
            states = states.filter(in_days(month, names))
        merged = states.groupBy(month.alias(MONTH), *self.keys).agg(*self._parts("merged"))
        self.store.write(merged, self.months, "overwrite_partitions", [MONTH])
        if names is not None:
            there = {r[0] for r in states.select(month).distinct().collect()}
            self.store.drop_partitions(self.months, [name for name in names if name not in there])

    def result(self) -> DataFrame:
        """The measures by key over all days."""
        merged = self.store.read(self.months).groupBy(*self.keys).agg(*self._parts("merged"))
        return merged.select(*self.keys, *[measure.final() for measure in self.measures])

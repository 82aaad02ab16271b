"""Row predicates shared by the cleaners and the quality checks."""

from __future__ import annotations

import operator
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
MIN_RATING = 1.0
MAX_RATING = 5.0
LOOKBACK = timedelta(days=730)


def instant(as_of: datetime | Column) -> Column:
    """The "now" of a run: a datetime, or a column for a type other than TIMESTAMP."""
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def all_present(columns: list[str]) -> Column:
    return reduce(operator.and_, [F.col(c).isNotNull() for c in columns])


def any_null(columns: list[str]) -> Column:
    return reduce(operator.or_, [F.col(c).isNull() for c in columns])


def rating_in_range(column: str = "rating_value") -> Column:
    return F.col(column).between(MIN_RATING, MAX_RATING) & ~F.isnan(column)


def positive(column: str) -> Column:
    return F.col(column) > 0


def non_negative(columns: list[str]) -> Column:
    return reduce(operator.and_, [F.col(c) >= 0 for c in columns])


def not_future(column: str, as_of: datetime | Column) -> Column:
    return F.col(column) <= instant(as_of)


def not_older(column: str, as_of: datetime | Column, lookback: timedelta = LOOKBACK) -> Column:
    return F.col(column) >= instant(as_of) - F.lit(lookback)

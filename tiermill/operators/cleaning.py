"""Row filters, defaults and "keep the newest" de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.functions.predicates import any_null


def require_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """The rows in which any of ``columns`` is null."""
    return df.filter(any_null(columns))


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    return df.fillna(defaults)


def keep_newest(df: DataFrame, keys: list[str], newest_by: list[str]) -> DataFrame:
    """One row per key: the one with the highest ``newest_by``, null being the lowest.

    Rows equal in all of these are told apart by their other columns, so the result never depends on
    the order of the rows. This is an aggregate rather than a ranking: Spark folds the rows of a key
    inside every task before the shuffle, so a key with a third of all rows sends one row per task.
    """
    others = [c for c in df.columns if c not in keys]
    ranked = [*newest_by, *[c for c in others if c not in newest_by]]
    newest = df.groupBy(*keys).agg(F.max(F.struct(*ranked)).alias("_newest"))
    return newest.select(
        [F.col(c) if c in keys else F.col("_newest")[c].alias(c) for c in df.columns]
    )

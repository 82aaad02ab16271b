"""Data-quality reports, each from one aggregation over its input."""

from __future__ import annotations

import operator
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tiermill.functions.comments import only_blanks
from tiermill.functions.predicates import (
    LOOKBACK,
    MAX_RATING,
    MIN_RATING,
    instant,
)
from tiermill.operators.cleaning import null_violations
from tiermill.schemas import SILVER_REQUIRED
from tiermill.session import written


def _unpivot(row: DataFrame, label: str, entries: dict[str, dict[str, Column]]) -> DataFrame:
    """One output row per entry out of a one-row DataFrame."""
    structs = [
        F.struct(F.lit(name).alias(label), *[c.alias(n) for n, c in columns.items()])
        for name, columns in entries.items()
    ]
    return row.select(F.inline(F.array(*structs)))


def _is_missing(df: DataFrame, column: str) -> Column:
    missing = F.col(column).isNull()
    if df.schema[column].dataType.typeName() in ("float", "double"):
        missing = missing | F.isnan(column)
    return missing


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, null_count, row_count); a NaN counts as null."""
    columns = columns or df.columns
    totals = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(_is_missing(df, c)).alias(c) for c in columns],
    )
    return _unpivot(
        totals,
        "column_name",
        {c: {"null_count": F.col(c), "row_count": F.col("_rows")} for c in columns},
    )


def column_minimum(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias(f"min_{column}"))


def observed(df: DataFrame, name: str, required: list[str]) -> tuple[DataFrame, Observation]:
    """Attach row and null counts to whatever action runs next, at no extra pass.

    Only for rows that the action takes as they are: if adaptive execution finds nothing left above the
    counts, say after a shuffle, they never arrive, and whoever asks for them waits for ever.
    """
    watch = Observation(name)
    metrics = [F.count_if(_is_missing(df, c)).alias(f"nulls_{c}") for c in required]
    return df.observe(watch, F.count(F.lit(1)).alias("rows"), *metrics), watch


def check_silver(name: str, df: DataFrame) -> DataFrame:
    """The rows of a silver table that break its not-null rule; empty when all is well."""
    return null_violations(df, SILVER_REQUIRED[name])


def layer_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count), all tables counted in one job."""
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def funnel(
    bronze: DataFrame, rules: list[tuple[str, Column]], unique_by: list[Column] | None = None
) -> DataFrame:
    """(step, rule, rows_in, rows_out, dropped) for rules applied one after the other.

    All rules are counted in one pass over bronze. With ``unique_by`` a last step counts what
    de-duplication on those expressions leaves.
    """
    passed, survivors = F.lit(True), []
    for _, keep in rules:
        passed = passed & F.coalesce(keep, F.lit(False))
        survivors.append(passed)
    totals = bronze.agg(
        F.count("*").alias("_0"),
        *[F.count_if(kept).alias(f"_{i}") for i, kept in enumerate(survivors, 1)],
    )
    steps = _unpivot(
        totals,
        "rule",
        {
            name: {
                "step": F.lit(i),
                "rows_in": F.col(f"_{i - 1}"),
                "rows_out": F.col(f"_{i}"),
            }
            for i, (name, _) in enumerate(rules, 1)
        },
    )
    if unique_by:
        named = [c.alias(f"_k{i}") for i, c in enumerate(unique_by)]
        distinct = (
            bronze.filter(passed)
            .groupBy(*named)
            .agg(F.count("*").alias("_n"))
            .agg(
                F.lit("duplicate").alias("rule"),
                F.lit(len(rules) + 1).alias("step"),
                F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_in"),
                F.count("*").alias("rows_out"),
            )
        )
        steps = steps.unionByName(distinct)
    return steps.withColumn("dropped", F.col("rows_in") - F.col("rows_out")).select(
        "step", "rule", "rows_in", "rows_out", "dropped"
    )


def clean_and_count(
    bronze: DataFrame,
    rules: list[tuple[str, Column]],
    keys: list[str],
    newest_by: list[str],
) -> tuple[DataFrame, DataFrame]:
    """The rows that pass all rules, the newest per key, and the ``funnel`` of how they came about, both
    from one scan and one shuffle of bronze (runs a job).

    Rows that a rule drops are folded into one group per rule beside the groups of the keys, so each task
    sends one row for them. The groups are written with their sizes before they are read twice. The
    counts are part of the rows, so a task that runs twice does not count twice, which a metric observed
    in passing would; and such a metric never arrives when nothing is left above it.
    """
    failed = F.coalesce(
        *[F.when(~F.coalesce(keep, F.lit(False)), F.lit(i)) for i, (_, keep) in enumerate(rules, 1)]
    )
    kept = F.col("_rule").isNull()
    marked = bronze.withColumn("_rule", failed).withColumns(
        {c: F.when(kept, F.col(c)) for c in bronze.columns}
    )
    others = [c for c in bronze.columns if c not in keys]
    ranked = [*newest_by, *[c for c in others if c not in newest_by]]
    newest = F.max(F.struct(*ranked)).alias("_newest")
    grouped = marked.groupBy("_rule", *keys).agg(newest, F.count(F.lit(1)).alias("_copies"))
    stored = written(grouped, "counted")
    rows = stored.filter(kept).select(
        [F.col(c) if c in keys else F.col("_newest")[c].alias(c) for c in bronze.columns]
    )
    copies = F.col("_copies")
    of_rule = {i: F.coalesce(F.sum(F.when(F.col("_rule") == i, copies)), F.lit(0)) for i in range(1, len(rules) + 1)}
    totals = stored.agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("_all"),
        *[count.alias(f"_dropped_{i}") for i, count in of_rule.items()],
        F.count_if(kept).alias("_rows"),
    )
    names = [name for name, _ in rules] + ["duplicate"]
    rows_in, steps = F.col("_all"), {}
    for i, name in enumerate(names, 1):
        rows_out = rows_in - F.col(f"_dropped_{i}") if i <= len(rules) else F.col("_rows")
        steps[name] = {"step": F.lit(i), "rows_in": rows_in, "rows_out": rows_out}
        rows_in = rows_out
    counts = _unpivot(totals, "rule", steps).withColumn("dropped", F.col("rows_in") - F.col("rows_out"))
    return rows, counts.select("step", "rule", "rows_in", "rows_out", "dropped")


RATING_KEYS = ["customer_id", "branch_id", "employee_id", "treatment_id", "timestamp"]


def rating_faults(
    as_of: datetime | Column, lookback: timedelta = LOOKBACK, strict_blank: bool = False
) -> dict[str, Column]:
    """What can be wrong with a raw rating, by name. Comments are blank by the cleaner's rule."""
    rating = F.col("rating_value")
    blank = F.coalesce(only_blanks(F.col("comment"), strict_blank), F.lit(False))
    return {
        "bad_rating": rating.isNull()
        | F.isnan(rating)
        | (rating < MIN_RATING)
        | (rating > MAX_RATING),
        "null_key": reduce(operator.or_, [F.col(c).isNull() for c in RATING_KEYS]),
        "blank_comment": blank,
        "future": F.col("timestamp") > instant(as_of),
        "old": F.col("timestamp") < instant(as_of) - F.lit(lookback),
    }


def classify_ratings(
    ratings: DataFrame,
    as_of: datetime | Column,
    lookback: timedelta = LOOKBACK,
    strict_blank: bool = False,
) -> DataFrame:
    """Add ``reasons``, the names of all faults of a row; an empty array means clean."""
    faults = rating_faults(as_of, lookback, strict_blank)
    named = F.array(*[F.when(fault, F.lit(name)) for name, fault in faults.items()])
    return ratings.withColumn("reasons", F.array_compact(named))


def reason_counts(
    ratings: DataFrame,
    as_of: datetime | Column,
    lookback: timedelta = LOOKBACK,
    strict_blank: bool = False,
) -> DataFrame:
    """(reason, row_count); a row with two faults counts for both."""
    faults = rating_faults(as_of, lookback, strict_blank)
    totals = ratings.agg(*[F.count_if(fault).alias(name) for name, fault in faults.items()])
    return _unpivot(totals, "reason", {name: {"row_count": F.col(name)} for name in faults})

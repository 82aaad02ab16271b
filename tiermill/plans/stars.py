"""Facts enriched with their dimensions: sessions, social posts, inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.operators.lookups import (
    BROADCAST_ROWS,
    HOT_KEY_ROWS,
    Lookup,
    colocated_join,
    lookup_all,
)


def _named(dim: DataFrame, key: str, **columns: str) -> DataFrame:
    return dim.select(key, *[F.col(c).alias(name) for name, c in columns.items()])


def _days(dim_date: DataFrame, *columns: str) -> DataFrame:
    return dim_date.select(F.col("date").alias("_day"), *columns)


def ratings_star(
    ratings: DataFrame,
    customers: DataFrame,
    branches: DataFrame,
    treatments: DataFrame,
    dim_date: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_key_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Ratings with the names of their current customer, branch and treatment, and the season."""
    names = _current_names(customers)
    lookups = [*_rating_lookups(branches, treatments, dim_date), (names, ["customer_id"])]
    joined = lookup_all(
        _rating_facts(ratings), lookups, broadcast_rows=broadcast_rows, hot_key_rows=hot_key_rows
    )
    return _ratings_star_columns(joined)


def ratings_star_colocated(
    ratings: DataFrame,
    customers: DataFrame,
    branches: DataFrame,
    treatments: DataFrame,
    dim_date: DataFrame,
) -> DataFrame:
    """``ratings_star`` over ratings and customers that lie in the same buckets by customer_id: the large
    join needs no shuffle, the other dimensions are measured as there."""
    named = colocated_join(_rating_facts(ratings), _current_names(customers), ["customer_id"])
    return _ratings_star_columns(lookup_all(named, _rating_lookups(branches, treatments, dim_date)))


def _current_names(customers: DataFrame) -> DataFrame:
    return customers.filter("is_current").select("customer_id", "first_name", "last_name")


def _rating_facts(ratings: DataFrame) -> DataFrame:
    return ratings.select(
        "customer_id",
        "branch_id",
        "treatment_id",
        "rating_value",
        F.to_date("timestamp").alias("_day"),
    )


def _rating_lookups(branches: DataFrame, treatments: DataFrame, dim_date: DataFrame) -> list[Lookup]:
    return [
        (_days(dim_date, "season"), ["_day"]),
        (_named(branches, "branch_id", branch_name="name"), ["branch_id"]),
        (_named(treatments, "treatment_id", treatment_name="name"), ["treatment_id"]),
    ]


def _ratings_star_columns(joined: DataFrame) -> DataFrame:
    return joined.select(
        "customer_id",
        "first_name",
        "last_name",
        "branch_name",
        "treatment_name",
        "rating_value",
        "season",
    )


def sessions_star(
    ratings: DataFrame,
    customers: DataFrame,
    branches: DataFrame,
    employees: DataFrame,
    treatments: DataFrame,
    dim_date: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_key_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """The session fact: the ratings star with employee, price and weekend flag."""
    current = customers.filter("is_current")
    facts = ratings.select(
        "customer_id",
        "branch_id",
        "employee_id",
        "treatment_id",
        "rating_value",
        F.to_date("timestamp").alias("_day"),
    )
    joined = lookup_all(
        facts,
        [
            (_days(dim_date, "season", "is_weekend"), ["_day"]),
            (_named(branches, "branch_id", branch_name="name"), ["branch_id"]),
            (_named(employees, "employee_id", employee_name="first_name"), ["employee_id"]),
            (
                _named(treatments, "treatment_id", treatment_name="name", price="price"),
                ["treatment_id"],
            ),
            (current.select("customer_id", "first_name", "last_name"), ["customer_id"]),
        ],
        broadcast_rows=broadcast_rows,
        hot_key_rows=hot_key_rows,
    )
    return joined.select(
        "customer_id",
        "first_name",
        "last_name",
        "branch_name",
        "employee_name",
        "treatment_name",
        "price",
        "rating_value",
        "season",
        "is_weekend",
    )


def social_star(posts: DataFrame, colors: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Posts with colour name and category, season and month."""
    facts = posts.select(
        "post_id", "color_id", "likes", "comments", F.col("post_date").alias("_day")
    )
    joined = lookup_all(
        facts,
        [
            (_days(dim_date, "season", "month"), ["_day"]),
            (
                _named(colors, "color_id", color_name="name", color_category="category"),
                ["color_id"],
            ),
        ],
    )
    return joined.select(
        "post_id", "color_name", "color_category", "likes", "comments", "season", "month"
    )


def inventory_star(
    inventory: DataFrame, colors: DataFrame, branches: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """Inventory use with colour and branch name, month and quarter."""
    facts = inventory.select(
        "record_id",
        "branch_id",
        "color_id",
        "quantity_used",
        F.to_date("timestamp").alias("_day"),
    )
    joined = lookup_all(
        facts,
        [
            (_days(dim_date, "month", "quarter"), ["_day"]),
            (_named(branches, "branch_id", branch_name="name"), ["branch_id"]),
            (_named(colors, "color_id", color_name="name"), ["color_id"]),
        ],
    )
    return joined.select(
        "record_id", "color_id", "color_name", "branch_name", "quantity_used", "month", "quarter"
    )

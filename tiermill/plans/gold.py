"""Silver to gold: branch, colour and customer metrics.

Facts are aggregated before they meet a dimension, so each join has one row per key on either side
and a key with many rows is folded inside the tasks that hold them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.operators.cleaning import fill_defaults
from tiermill.operators.partials import Average, Count, DailyState, Newest, Total
from tiermill.sources.tables import TableStore

# Fixed values.
VIP_RATINGS = 10
SCORE_EPSILON = 1e-6


def active_employees(employees: DataFrame) -> DataFrame:
    return (
        employees.filter("active")
        .groupBy("branch_id")
        .agg(F.count("*").alias("num_active_employees"))
    )


def gold_branch_kpis(
    ratings: DataFrame, employees: DataFrame, branches: DataFrame
) -> DataFrame:
    """Average rating, number of ratings and active staff per branch; an unknown branch has no name."""
    per_branch = ratings.groupBy("branch_id").agg(
        F.avg("rating_value").alias("avg_rating"),
        F.count("rating_id").alias("total_ratings"),
    )
    return branch_kpis(per_branch, employees, branches)


def branch_kpis(per_branch: DataFrame, employees: DataFrame, branches: DataFrame) -> DataFrame:
    """Figures per branch with its name and active staff."""
    names = branches.select("branch_id", F.col("name").alias("branch_name"))
    joined = per_branch.join(names, "branch_id", "left").join(
        active_employees(employees), "branch_id", "left"
    )
    return fill_defaults(joined, {"num_active_employees": 0})


def gold_color_engagement(inventory: DataFrame, instagram: DataFrame) -> DataFrame:
    """Use and engagement per colour; colours without posts score 0, colours only in posts are left out."""
    usage = inventory.groupBy("color_id").agg(
        F.count("record_id").alias("times_used"),
        F.sum("quantity_used").alias("total_quantity_used"),
    )
    social = instagram.groupBy("color_id").agg(
        F.sum("likes").alias("total_likes"), F.sum("comments").alias("total_comments")
    )
    return color_engagement(usage, social)


def color_engagement(usage: DataFrame, social: DataFrame) -> DataFrame:
    """The score of each colour in use, from figures per colour."""
    reactions = F.col("total_likes") + F.col("total_comments")
    scored = usage.join(social, "color_id", "left").withColumn(
        "engagement_score", reactions / (F.col("times_used") + F.lit(SCORE_EPSILON))
    )
    return fill_defaults(
        scored, {"total_likes": 0, "total_comments": 0, "engagement_score": 0.0}
    )


def gold_customer_metrics(ratings: DataFrame, vip_ratings: int = VIP_RATINGS) -> DataFrame:
    """Average, number and last of the ratings per customer; "last" is by time, then by rating_id."""
    per_customer = ratings.groupBy("customer_id").agg(
        F.avg("rating_value").alias("avg_rating"),
        F.count("rating_id").alias("total_ratings"),
        F.max_by("rating_value", F.struct("timestamp", "rating_id")).alias("last_rating"),
    )
    return customer_metrics(per_customer, vip_ratings)


def customer_metrics(per_customer: DataFrame, vip_ratings: int = VIP_RATINGS) -> DataFrame:
    return per_customer.withColumn("is_vip", F.col("total_ratings") >= F.lit(vip_ratings))


# The same figures kept as states by day, for tables of which some days change.


def branch_state(store: TableStore) -> DailyState:
    measures = [Average("avg_rating", "rating_value"), Count("total_ratings", "rating_id")]
    return DailyState(store, "state_branch_ratings", "rating_date", ["branch_id"], measures)


def customer_state(store: TableStore) -> DailyState:
    measures = [
        Average("avg_rating", "rating_value"),
        Count("total_ratings", "rating_id"),
        Newest("last_rating", "rating_value", ["timestamp", "rating_id"]),
    ]
    return DailyState(store, "state_customer_ratings", "rating_date", ["customer_id"], measures)


def usage_state(store: TableStore) -> DailyState:
    measures = [Count("times_used", "record_id"), Total("total_quantity_used", "quantity_used")]
    return DailyState(store, "state_color_usage", "report_date", ["color_id"], measures)


def social_state(store: TableStore) -> DailyState:
    measures = [Total("total_likes", "likes"), Total("total_comments", "comments")]
    return DailyState(store, "state_color_posts", "post_date", ["color_id"], measures)

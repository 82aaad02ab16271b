"""The given tables in the shape of the jobs' inputs.

Every row of a table is used. The remainders below only decide which rows get a fault (a null, a
blank comment, a repeated message) or which small dimension key a row refers to.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.plans.dimensions import build_dim_date, calendar_between

# The given timestamps have no zone, so the "now" of the queries has none either.
AS_OF_TEXT = "2024-01-25 00:00:00"
LOOKBACK = timedelta(days=20)
CALENDAR = ("1996-01-01", "2000-12-31")
RATINGS_CALENDAR = ("2024-01-01", "2024-12-31")


def as_of():
    return F.lit(AS_OF_TEXT).cast("timestamp_ntz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ratings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as bronze ratings, some sent twice (an hour apart), with nulls and blank comments."""
    copies = F.when(F.expr("event_id % 9 = 0"), F.array(F.lit(0), F.lit(1)))
    sent = table(spark, sf_dir, "events").withColumn(
        "dup", F.explode(copies.otherwise(F.array(F.lit(0))))
    )
    return sent.select(
        F.expr("CASE WHEN event_id % 17 = 0 THEN NULL ELSE user_id END").alias("customer_id"),
        F.expr("cast(event_id % 6 AS int)").alias("branch_id"),
        F.expr("cast(event_id % 10 + 1 AS int)").alias("employee_id"),
        F.expr("cast(event_id % 15 + 1 AS int)").alias("treatment_id"),
        F.expr("cast(value / 20 AS float)").alias("rating_value"),
        F.expr(
            "CASE WHEN event_id % 7 = 0 THEN '   ' WHEN event_id % 11 = 0 THEN NULL ELSE props END"
        ).alias("comment"),
        F.expr("ts + make_dt_interval(0, dup)").alias("timestamp"),
        as_of().alias("processed_timestamp"),
        F.lit("ratings").alias("_kafka_topic"),
        F.expr("cast(event_id % 4 AS int)").alias("_kafka_partition"),
        F.expr("event_id * 10 + dup").alias("_kafka_offset"),
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("record_id"),
        F.expr("cast(l_suppkey % 5 AS int)").alias("branch_id"),
        F.expr("cast(l_partkey % 42 AS int)").alias("color_id"),
        F.expr("cast(floor(l_quantity - 5) AS int)").alias("quantity_used"),
        F.col("l_shipdate").alias("timestamp"),
    )


def event_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as inventory records: a month of days, each a partition of the silver table."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("record_id"),
        F.expr("cast(event_id % 5 AS int)").alias("branch_id"),
        F.expr("cast(user_id % 42 AS int)").alias("color_id"),
        F.expr("cast(floor(value) AS int) - 5").alias("quantity_used"),
        F.col("ts").alias("timestamp"),
    )


def instagram(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("post_id"),
        F.expr("cast(o_custkey % 40 AS int)").alias("color_id"),
        F.expr("cast(floor(o_totalprice) AS int) % 1000 - 20").alias("likes"),
        F.expr("cast(o_custkey % 60 - 2 AS int)").alias("comments"),
        day.alias("post_date"),
        day.alias("ingestion_date"),
    )


def event_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as cleaned posts: a month of days."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("post_id"),
        F.expr("cast(user_id % 40 AS int)").alias("color_id"),
        F.expr("cast(floor(value) AS int)").alias("likes"),
        F.expr("cast(event_id % 60 AS int)").alias("comments"),
        F.to_date("ts").alias("post_date"),
    )


def post_calendar(spark: SparkSession) -> DataFrame:
    """Narrower than the posts, so that some of them fall outside."""
    return build_dim_date(spark, *CALENDAR)


def ratings_calendar(spark: SparkSession) -> DataFrame:
    return build_dim_date(spark, *RATINGS_CALENDAR)


def order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar from the first to the last order."""
    day = F.to_date("o_orderdate")
    bounds = table(spark, sf_dir, "orders").agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return calendar_between(bounds, "first", "last")


def branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("branch_id"), F.col("r_name").alias("name")
    )


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("employee_id"),
        F.col("c_name").alias("first_name"),
        F.expr("cast(c_nationkey % 4 AS int)").alias("branch_id"),
        (F.col("c_acctbal") > 0).alias("active"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer with an old and a current version."""
    return (
        table(spark, sf_dir, "customer")
        .withColumn("version_id", F.explode(F.array(F.lit(1), F.lit(2))))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("version_id").cast("bigint"),
            F.expr("CASE WHEN version_id = 2 THEN c_name ELSE 'old name' END").alias("first_name"),
            F.col("c_mktsegment").alias("last_name"),
            F.expr("date'1997-01-01' + cast((version_id - 1) * 365 AS int)").alias("start_date"),
            F.expr("CASE WHEN version_id = 1 THEN date'1998-01-01' END").alias("end_date"),
            (F.col("version_id") == 2).alias("is_current"),
        )
    )


def treatments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("treatment_id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
    )


def colors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("color_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
    )


def order_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as cleaned ratings: one rating per order."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("rating_id"),
        F.expr("cast(o_totalprice / 100000 AS float)").alias("rating_value"),
        F.col("o_orderdate").alias("timestamp"),
        F.to_date("o_orderdate").alias("rating_date"),
    )


def priority_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as an update of its customer's city, dated before, between and after versions."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("city"),
        F.to_date("o_orderdate").alias("effective_date"),
        F.col("o_orderkey").alias("sequence"),
    )


def city_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer with one or two versions of a city."""
    return (
        table(spark, sf_dir, "customer")
        .withColumn(
            "version_id",
            F.explode(
                F.when(F.col("c_acctbal") > 0, F.array(F.lit(1), F.lit(2))).otherwise(
                    F.array(F.lit(1))
                )
            ),
        )
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("version_id").cast("bigint"),
            F.expr("CASE WHEN version_id = 1 THEN '1-URGENT' ELSE c_mktsegment END").alias("city"),
            F.expr("date'1997-01-01' + cast((version_id - 1) * 365 AS int)").alias("start_date"),
        )
    )


def closed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The versions of ``city_versions`` with an email and a stamp; first versions of some customers
    were closed, with and without a later one."""
    return city_versions(spark, sf_dir).selectExpr(
        "*",
        "concat('customer', customer_id, '-', version_id) AS email",
        "CASE WHEN version_id = 1 AND customer_id % 3 = 0 THEN date'1997-07-20' END AS end_date",
        "timestamp'2020-01-01 00:00:00' AS created_timestamp",
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as message envelopes; some hold no JSON, some a rating that is no number."""
    body = F.to_json(
        F.struct(
            F.col("user_id").alias("customer_id"),
            F.expr("cast(event_id % 6 AS int)").alias("branch_id"),
            F.expr("cast(event_id % 10 + 1 AS int)").alias("employee_id"),
            F.expr("cast(event_id % 15 + 1 AS int)").alias("treatment_id"),
            F.expr("cast(value / 20 AS float)").alias("rating_value"),
            F.col("props").alias("comment"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        )
    )
    wrong_type = F.regexp_replace(body, r'"rating_value":[^,]*', '"rating_value":"five"')
    value = (
        F.when(F.expr("event_id % 13 = 0"), F.lit("no json"))
        .when(F.expr("event_id % 19 = 0"), wrong_type)
        .otherwise(body)
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit("ratings").alias("topic"),
        F.expr("cast(event_id % 4 AS int)").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )

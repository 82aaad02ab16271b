"""Column types of the tables, and the cast-on-write step.

Identifiers of unbounded entities (customers, posts, inventory records, ratings) and all counts are
BIGINT, because a 32-bit id runs out long before 100 TB; identifiers of small dimensions stay INT.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(ddl: str) -> T.StructType:
    fields = []
    for part in ddl.split(";"):
        name, kind = part.split()
        fields.append(T.StructField(name, _KINDS[kind], True))
    return T.StructType(fields)


_KINDS = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "price": T.DecimalType(10, 2),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}

# What arrives in the source files and messages.
INSTAGRAM_CSV = _schema(
    "post_id bigint; color_id int; likes int; comments int; post_date date; ingestion_date date"
)
INVENTORY_CSV = _schema(
    "record_id bigint; branch_id int; color_id int; quantity_used int; timestamp timestamp"
)
RATING_MESSAGE = _schema(
    "customer_id bigint; branch_id int; employee_id int; treatment_id int; rating_value float;"
    "comment string; timestamp timestamp"
)
COLORS_CSV = _schema("color_id int; name string; hex_code string; category string; active boolean")
BRANCHES_CSV = _schema(
    "branch_id int; name string; city string; address string; active boolean; opening_date date"
)
EMPLOYEES_CSV = _schema(
    "employee_id int; first_name string; last_name string; role string; experience_years int;"
    "active boolean; hire_date date; branch_id int"
)
CUSTOMERS_CSV = _schema(
    "customer_id bigint; version_id bigint; first_name string; last_name string; email string;"
    "phone string; address string; city string; start_date date; end_date date; is_current boolean"
)
TREATMENTS_CSV = _schema(
    "treatment_id int; name string; price price; duration_minutes int; active boolean"
)
DATE_CSV = _schema(
    "date_id string; date date; day_of_week string; day_of_month int; month string;"
    "month_number int; quarter int; year int; season string; is_weekend boolean; is_holiday boolean"
)

_CREATED = T.StructField("created_timestamp", T.TimestampType(), True)


def _dimension(source: T.StructType) -> T.StructType:
    return T.StructType([*source.fields, _CREATED])


TABLES: dict[str, T.StructType] = {
    "bronze_instagram": INSTAGRAM_CSV,
    "rejected_late_posts": INSTAGRAM_CSV,
    "bronze_inventory": INVENTORY_CSV,
    "bronze_ratings": T.StructType(
        [
            *RATING_MESSAGE.fields,
            *_schema(
                "processed_timestamp timestamp; _kafka_topic string; _kafka_partition int;"
                "_kafka_offset bigint; event_date date"
            ).fields,
        ]
    ),
    "refresh_jobs": _schema("run string; job string; finished timestamp"),
    "bronze_ratings_batches": _schema(
        "run_id string; batch_id bigint; event_date date; stamp bigint; merge_id bigint"
    ),
    "silver_instagram": _schema(
        "post_id bigint; color_id int; date_id int; likes int; comments int; post_date date;"
        "ingestion_date date; season string"
    ),
    "silver_inventory": _schema(
        "record_id bigint; branch_id int; color_id int; quantity_used int; report_date date;"
        "ingestion_time timestamp"
    ),
    "silver_ratings": T.StructType(
        [
            *RATING_MESSAGE.fields,
            *_schema(
                "processed_timestamp timestamp; _kafka_topic string; _kafka_partition int;"
                "_kafka_offset bigint; rating_id bigint; rating_date date; ingestion_time timestamp;"
                "data_quality_score double"
            ).fields,
        ]
    ),
    "gold_branch_kpis": _schema(
        "branch_id int; avg_rating double; total_ratings bigint; branch_name string;"
        "num_active_employees bigint"
    ),
    "gold_color_engagement": _schema(
        "color_id int; times_used bigint; total_quantity_used bigint; total_likes bigint;"
        "total_comments bigint; engagement_score double"
    ),
    "gold_customer_metrics": _schema(
        "customer_id bigint; avg_rating float; total_ratings bigint; last_rating float; is_vip boolean"
    ),
    "dim_colors": _dimension(COLORS_CSV),
    "dim_branches": _dimension(BRANCHES_CSV),
    "dim_employees": _dimension(EMPLOYEES_CSV),
    "dim_customers": _dimension(CUSTOMERS_CSV),
    "dim_treatments": _dimension(TREATMENTS_CSV),
    "dim_date": _dimension(DATE_CSV),
}
# Versions derived from ratings go to a table of their own, so that the attributes kept in
# dim_customers are not replaced by nulls.
TABLES["customer_rating_versions"] = TABLES["dim_customers"]

# Columns that must never be null in a silver table.
SILVER_REQUIRED: dict[str, list[str]] = {
    "silver_inventory": [f.name for f in TABLES["silver_inventory"].fields],
    "silver_instagram": [f.name for f in TABLES["silver_instagram"].fields],
    "silver_ratings": [
        "rating_id",
        "customer_id",
        "branch_id",
        "employee_id",
        "treatment_id",
        "rating_value",
        "comment",
        "rating_date",
        "timestamp",
        "ingestion_time",
        "data_quality_score",
    ],
}


def conform(df: DataFrame, schema: T.StructType, raw: bool = False) -> DataFrame:
    """Select the columns of ``schema`` by name and cast them; a missing column is an error. In ``raw``
    input, text that does not fit its type becomes null; elsewhere it is an error."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    cast = Column.try_cast if raw else Column.cast
    return df.select([cast(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])


def unfit_cells(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: how many cells of each column ``conform`` makes null in raw input."""
    return df.agg(
        *[
            F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(
                f.name
            )
            for f in schema.fields
        ]
    )

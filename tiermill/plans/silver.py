"""Bronze to silver: inventory, social posts and ratings."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.functions import predicates as p
from tiermill.functions.comments import normalize_comment, quality_score
from tiermill.operators.cleaning import keep_newest, require_not_null
from tiermill.operators.numbering import number_all
from tiermill.operators.quality import clean_and_count, funnel

INVENTORY_FIELDS = ["record_id", "branch_id", "color_id", "quantity_used", "timestamp"]
INVENTORY_KEY = ["record_id", "branch_id", "color_id"]
INSTAGRAM_FIELDS = [
    "post_id",
    "color_id",
    "date_id",
    "likes",
    "comments",
    "post_date",
    "ingestion_date",
    "season",
]
INSTAGRAM_KEY = ["post_id", "color_id", "date_id"]
RATING_FIELDS = [
    "customer_id",
    "branch_id",
    "employee_id",
    "treatment_id",
    "rating_value",
    "timestamp",
]
RATING_KEY = ["customer_id", "branch_id", "employee_id", "treatment_id", "rating_value", "comment"]
TOPIC_POSITION = ["_kafka_topic", "_kafka_partition", "_kafka_offset"]


def clean_inventory(bronze: DataFrame) -> DataFrame:
    valid = require_not_null(bronze, INVENTORY_FIELDS).filter(p.positive("quantity_used"))
    return keep_newest(valid, INVENTORY_KEY, ["timestamp", "quantity_used"])


def silver_inventory(bronze: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Complete records with a positive quantity, the newest per record, branch and colour."""
    return _inventory_columns(clean_inventory(bronze), as_of)


def _inventory_columns(cleaned: DataFrame, as_of: datetime | Column) -> DataFrame:
    return cleaned.select(
        *INVENTORY_KEY,
        "quantity_used",
        F.to_date("timestamp").alias("report_date"),
        p.instant(as_of).alias("ingestion_time"),
    )


def inventory_rules() -> list[tuple[str, Column]]:
    return [
        ("null_field", p.all_present(INVENTORY_FIELDS)),
        ("quantity", p.positive("quantity_used")),
    ]


def inventory_funnel(bronze: DataFrame) -> DataFrame:
    return funnel(bronze, inventory_rules(), [F.col(c) for c in INVENTORY_KEY])


def counted_inventory(bronze: DataFrame, as_of: datetime | Column) -> tuple[DataFrame, DataFrame]:
    """``silver_inventory`` and ``inventory_funnel`` from one scan (runs a job)."""
    rows, counts = clean_and_count(
        bronze.select(INVENTORY_FIELDS), inventory_rules(), INVENTORY_KEY, ["timestamp", "quantity_used"]
    )
    return _inventory_columns(rows, as_of), counts


def with_calendar(posts: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Every post with the id and season of its day, null outside the calendar.

    No hint: a calendar is far below Spark's own broadcast limit, and above it the join is shuffled.
    """
    days = dim_date.select(
        F.col("date_id").cast("int").alias("date_id"),
        F.col("date").cast("date").alias("post_date"),
        "season",
    )
    return posts.join(days, "post_date", "left").select(INSTAGRAM_FIELDS)


def silver_instagram(bronze: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Complete posts within the calendar, the last ingested per post, colour and day."""
    valid = require_not_null(with_calendar(bronze, dim_date), INSTAGRAM_FIELDS).filter(
        p.non_negative(["likes", "comments"])
    )
    return keep_newest(valid, INSTAGRAM_KEY, ["ingestion_date", "likes", "comments"])


def instagram_rules() -> list[tuple[str, Column]]:
    """The rules for posts with their calendar columns."""
    from_csv = [c for c in INSTAGRAM_FIELDS if c not in ("date_id", "season")]
    return [
        ("null_field", p.all_present(from_csv)),
        ("outside_calendar", p.all_present(["date_id", "season"])),
        ("negative_count", p.non_negative(["likes", "comments"])),
    ]


def instagram_funnel(bronze: DataFrame, dim_date: DataFrame) -> DataFrame:
    keys = [F.col(c) for c in INSTAGRAM_KEY]
    return funnel(with_calendar(bronze, dim_date), instagram_rules(), keys)


def counted_instagram(bronze: DataFrame, dim_date: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``silver_instagram`` and ``instagram_funnel`` from one scan (runs a job)."""
    posts = with_calendar(bronze, dim_date)
    return clean_and_count(
        posts, instagram_rules(), INSTAGRAM_KEY, ["ingestion_date", "likes", "comments"]
    )


def rating_rules(
    as_of: datetime | Column, lookback: timedelta = p.LOOKBACK
) -> list[tuple[str, Column]]:
    """The row filters of the ratings cleaner, in the order in which they apply."""
    return [
        ("null_field", p.all_present(RATING_FIELDS)),
        ("rating_range", p.rating_in_range()),
        ("future", p.not_future("timestamp", as_of)),
        ("old", p.not_older("timestamp", as_of, lookback)),
    ]


def clean_ratings(
    bronze: DataFrame,
    as_of: datetime | Column,
    lookback: timedelta = p.LOOKBACK,
    strict_blank: bool = False,
    unicode_words: bool = False,
    position: list[str] = TOPIC_POSITION,
) -> DataFrame:
    """Valid ratings with a normalised comment, the newest of those that say the same."""
    if "event_date" in bronze.columns:
        # The day folders of bronze: lets the scan skip what the time rules would drop anyway. A day
        # more on each side, as the writer may have had another time zone.
        now = p.instant(as_of)
        oldest = F.date_sub(F.to_date(now - F.lit(lookback)), 1)
        newest = F.date_add(F.to_date(now), 1)
        bronze = bronze.filter(F.col("event_date").between(oldest, newest))
    for _, keep in rating_rules(as_of, lookback):
        bronze = bronze.filter(keep)
    cleaned = bronze.withColumn(
        "comment", normalize_comment("comment", strict_blank, unicode_words)
    )
    return keep_newest(cleaned, RATING_KEY, ["timestamp", *position])


def silver_ratings(
    bronze: DataFrame,
    as_of: datetime | Column,
    lookback: timedelta = p.LOOKBACK,
    strict_blank: bool = False,
    unicode_words: bool = False,
    position: list[str] = TOPIC_POSITION,
) -> DataFrame:
    """Cleaned ratings with rating_id, date and quality score (runs a job for the ids).

    ``rating_id`` counts from 1 by time and customer and is given anew on every run; it is not a
    lasting key. ``position`` names the columns that tell two messages apart.
    """
    cleaned = clean_ratings(bronze, as_of, lookback, strict_blank, unicode_words, position)
    return _numbered_ratings(cleaned, as_of, position)


def _numbered_ratings(
    cleaned: DataFrame, as_of: datetime | Column, position: list[str]
) -> DataFrame:
    numbered = number_all(cleaned, ["timestamp", "customer_id", *position], "rating_id")
    return numbered.withColumns(
        {
            "rating_date": F.to_date("timestamp"),
            "ingestion_time": p.instant(as_of),
            "data_quality_score": quality_score("comment"),
        }
    ).drop("event_date")


def counted_ratings(
    bronze: DataFrame,
    as_of: datetime | Column,
    lookback: timedelta = p.LOOKBACK,
    position: list[str] = TOPIC_POSITION,
) -> tuple[DataFrame, DataFrame]:
    """``silver_ratings`` and ``ratings_funnel`` from one scan (runs jobs for the counts and the ids). All
    days are read, as the funnel counts them."""
    named = bronze.withColumn("comment", normalize_comment("comment"))
    rules = rating_rules(as_of, lookback)
    rows, counts = clean_and_count(named, rules, RATING_KEY, ["timestamp", *position])
    return _numbered_ratings(rows, as_of, position), counts


def ratings_funnel(
    bronze: DataFrame, as_of: datetime | Column, lookback: timedelta = p.LOOKBACK
) -> DataFrame:
    keys = [F.col(c) for c in RATING_KEY if c != "comment"]
    return funnel(bronze, rating_rules(as_of, lookback), [*keys, normalize_comment("comment")])


def merge_late_posts(
    stored: DataFrame, arrived: DataFrame, as_of: datetime | Column, hours: int = 48
) -> tuple[DataFrame, DataFrame]:
    """Bronze posts with late arrivals merged in, the last ingested per post and colour, and the
    arrivals that are more than ``hours`` late.

    Only the days within the window are read and returned, as a whole, to overwrite their partitions:
    the table has to be partitioned by ``post_date``. Arrivals without a day are too late as well.
    """
    since = F.to_date(p.instant(as_of) - F.lit(timedelta(hours=hours)))
    in_time = F.coalesce(F.col("post_date") >= since, F.lit(False))
    recent = stored.unionByName(arrived).filter(in_time)
    key = ["post_id", "color_id", "post_date"]
    merged = keep_newest(recent, key, ["ingestion_date", "likes", "comments"])
    return merged, arrived.filter(~in_time)

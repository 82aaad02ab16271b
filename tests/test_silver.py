from datetime import date, datetime, timedelta

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from tiermill import schemas
from tiermill.operators.quality import check_silver, null_counts
from tiermill.plans import silver
from tiermill.plans.dimensions import build_dim_date

NOW = datetime(2025, 6, 1, 12, 0, 0)
T = datetime(2025, 5, 1, 10, 0, 0)

GOOD = (1, 2, 3, 4, 4.5, "fine", T)
BRONZE_SCHEMA = (
    "customer_id bigint, branch_id int, employee_id int, treatment_id int, rating_value float,"
    "comment string, timestamp timestamp, processed_timestamp timestamp, _kafka_topic string,"
    "_kafka_partition int, _kafka_offset bigint"
)


def bronze(spark, ratings):
    data = [(*r, NOW, "ratings", i % 3, i) for i, r in enumerate(ratings)]
    return spark.createDataFrame(data, BRONZE_SCHEMA)


def changed(**values):
    names = "customer_id branch_id employee_id treatment_id rating_value comment timestamp".split()
    return tuple(values.get(n, v) for n, v in zip(names, GOOD))


DIRTY = (
    [changed(**{c: None}) for c in silver.RATING_FIELDS]
    + [changed(rating_value=x) for x in (0.0, 0.5, 5.5, 6.0, 10.0, -1.0, 999.0, float("nan"))]
    + [changed(timestamp=NOW + timedelta(seconds=1))]
    + [changed(timestamp=NOW - timedelta(days=730, seconds=1))]
)


def test_dirty_ratings_are_dropped(spark):
    kept = [GOOD, changed(rating_value=1.0), changed(rating_value=5.0)]
    kept += [changed(customer_id=9, timestamp=NOW - timedelta(days=730))]
    got = silver.silver_ratings(bronze(spark, DIRTY + kept), NOW)
    assert rows(got, "rating_id", "customer_id", "rating_value") == [
        (1, 9, 4.5),
        (2, 1, 5.0),  # equal times: by topic position
        (3, 1, 4.5),
        (4, 1, 1.0),
    ]
    assert check_silver("silver_ratings", got).count() == 0
    assert [f.name for f in schemas.conform(got, schemas.TABLES["silver_ratings"]).schema] == [
        f.name for f in schemas.TABLES["silver_ratings"]
    ]


def test_ratings_saying_the_same_keep_the_newest(spark):
    later, latest = T + timedelta(hours=1), T + timedelta(hours=2)
    data = [
        changed(comment="fine!*"),
        changed(comment="fine!", timestamp=later),
        changed(comment="  fine!~ ", timestamp=latest),
        changed(comment=None),
        changed(comment="   ", timestamp=later),
        # equal times: the higher topic position stays
        changed(customer_id=5),
        changed(customer_id=5),
    ]
    got = silver.silver_ratings(bronze(spark, data), NOW)
    assert rows(got, "customer_id", "comment", "timestamp", "_kafka_offset", "data_quality_score") == [
        (1, "No comment provided", later, 4, 0.8),
        (1, "fine!", latest, 2, 1.0),
        (5, "fine", T, 5, 1.0),
    ]


def test_ratings_do_not_depend_on_partitioning(spark):
    data = [
        (i % 7, i % 3, i % 2, 1, float(i % 5 + 1), "x" * (i % 4), T + timedelta(minutes=i % 9))
        for i in range(300)
    ]
    results = {
        str(rows(silver.silver_ratings(bronze(spark, data).repartition(n), NOW).drop("_place")))
        for n in (1, 3, 7)
    }
    assert len(results) == 1


def test_no_ratings_give_an_empty_table(spark):
    assert silver.silver_ratings(bronze(spark, []), NOW).count() == 0


def test_day_folders_are_pruned(spark, tmp_path):
    df = bronze(spark, [changed(timestamp=T - timedelta(days=300 * i)) for i in range(5)])
    path = str(tmp_path / "bronze")
    df.withColumn("event_date", F.to_date("timestamp")).write.partitionBy("event_date").parquet(path)
    cleaned = silver.clean_ratings(spark.read.parquet(path), NOW)
    scan = [line for line in plan(cleaned).splitlines() if "FileScan" in line][0]
    assert "PartitionFilters: [isnotnull(event_date" in scan
    assert "PushedFilters: [IsNotNull(customer_id)" in scan
    assert cleaned.count() == 1  # the others are too old, or say the same as a newer one


def test_inventory(spark):
    t1, t2, t3 = T, T + timedelta(minutes=30), T + timedelta(hours=2)
    full = (1, 1, 1, 5, t1)
    nulls = [tuple(None if i == j else v for j, v in enumerate(full)) for i in range(5)]
    data = nulls + [(2, 1, 1, -5, t1), (2, 1, 1, -2, t1), (2, 1, 1, 0, t1)]
    data += [(3, 1, 1, 7, t1), (3, 1, 1, 8, t2)]
    data += [(4, 1, 1, 1, t1), (4, 1, 1, 3, t3), (4, 1, 1, 2, t2)]
    data += [(5, 1, 1, 4, t1), (5, 1, 1, 6, t1), (5, 2, 1, 9, t1)]
    df = spark.createDataFrame(
        data, "record_id int, branch_id int, color_id int, quantity_used int, timestamp timestamp"
    )
    got = silver.silver_inventory(df, NOW)
    assert rows(got) == [
        (3, 1, 1, 8, T.date(), NOW),
        (4, 1, 1, 3, T.date(), NOW),
        (5, 1, 1, 6, T.date(), NOW),
        (5, 2, 1, 9, T.date(), NOW),
    ]
    assert rows(silver.inventory_funnel(df)) == [
        (1, "null_field", 16, 11, 5),
        (2, "quantity", 11, 8, 3),
        (3, "duplicate", 8, 4, 4),
    ]


DAY = date(2025, 6, 1)
POSTS = (
    [(1, 10, 2, 5, DAY, DAY)]
    + [tuple(None if i == j else v for j, v in enumerate((9, 10, 2, 5, DAY, DAY))) for i in range(6)]
    + [(7, 10, -5, 2, DAY, DAY), (8, 10, 2, -1, DAY, DAY)]
    + [(9, 10, 0, 2, DAY, DAY), (10, 10, 2, 0, DAY, DAY)]
    + [(1, 10, 2, 5, DAY, DAY), (1, 10, 3, 5, DAY, DAY + timedelta(days=1))]
    + [(11, 10, 1, 1, date(2019, 12, 31), DAY), (12, 10, 1, 1, date(2026, 1, 1), DAY)]
)


def test_instagram(spark):
    df = spark.createDataFrame(POSTS, schemas.INSTAGRAM_CSV)
    calendar = build_dim_date(spark, "2020-01-01", "2025-12-31")
    got = silver.silver_instagram(df, calendar)
    assert rows(got, "post_id", "date_id", "likes", "comments", "ingestion_date", "season") == [
        (1, 20250601, 3, 5, DAY + timedelta(days=1), "Summer"),
        (10, 20250601, 2, 0, DAY, "Summer"),
        (9, 20250601, 0, 2, DAY, "Summer"),
    ]
    assert "BroadcastHashJoin" in plan(got)
    assert rows(silver.instagram_funnel(df, calendar)) == [
        (1, "null_field", 15, 9, 6),
        (2, "outside_calendar", 9, 7, 2),
        (3, "negative_count", 7, 5, 2),
        (4, "duplicate", 5, 3, 2),
    ]


def test_late_posts_touch_the_last_two_days_only(spark):
    stored = spark.createDataFrame(
        [(1, 1, 5, 5, date(2025, 5, 20), DAY), (2, 1, 5, 5, date(2025, 5, 31), date(2025, 5, 31))],
        schemas.INSTAGRAM_CSV,
    )
    late = spark.createDataFrame(
        [(2, 1, 9, 5, date(2025, 5, 31), DAY), (3, 1, 1, 1, date(2025, 5, 30), DAY),
         (4, 1, 1, 1, date(2025, 5, 29), DAY), (5, 1, 1, 1, None, DAY)],
        schemas.INSTAGRAM_CSV,
    )
    got, too_late = silver.merge_late_posts(stored, late, NOW)
    assert rows(got, "post_id", "likes") == [(2, 9), (3, 1)]
    assert rows(too_late, "post_id") == [(4,), (5,)]


def test_ratings_funnel_counts_against_bronze(spark):
    df = bronze(spark, [*DIRTY, GOOD, changed(comment="fine*")])
    assert rows(silver.ratings_funnel(df, NOW)) == [
        (1, "null_field", 18, 12, 6),
        (2, "rating_range", 12, 4, 8),
        (3, "future", 4, 3, 1),
        (4, "old", 3, 2, 1),
        (5, "duplicate", 2, 1, 1),
    ]


def test_null_counts_take_nan_for_null(spark):
    df = bronze(spark, [GOOD, *DIRTY])
    got = dict((r[0], r[1:]) for r in rows(null_counts(df)))
    assert got["rating_value"] == (2, 17)
    assert got["customer_id"] == (1, 17) and got["comment"] == (0, 17)


@pytest.mark.parametrize("strict, left", [(False, 2), (True, 1)])
def test_strict_blank_merges_kinds_of_blank(spark, strict, left):
    df = bronze(spark, [changed(comment="\n"), changed(comment=None)])
    assert silver.clean_ratings(df, NOW, strict_blank=strict).count() == left

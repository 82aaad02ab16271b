import random
from datetime import date, datetime, timedelta

import pytest
from conftest import rows

from tiermill.operators import numbering
from tiermill.operators.history import scd2_from_changes, scd2_from_events
from tiermill.schemas import TABLES, conform

NOW = datetime(2025, 6, 1)
D = [date(2024, 1, 1) + timedelta(days=i) for i in range(40)]


@pytest.mark.parametrize("hot_group_rows", [10**9, 0])
def test_versions_from_ratings(spark, hot_group_rows):
    df = spark.createDataFrame(
        [(1, D[0], 1), (1, D[5], 3), (1, D[5], 2), (2, D[3], 4)],
        "customer_id int, rating_date date, rating_id int",
    )
    got = scd2_from_events(df, NOW, hot_group_rows)
    columns = ("customer_id", "version_id", "start_date", "end_date", "is_current")
    assert rows(got, *columns) == [
        (1, 1, D[0], D[5], False),
        (1, 2, D[5], D[5], False),
        (1, 3, D[5], None, True),
        (2, 1, D[3], None, True),
    ]
    assert got.filter("first_name IS NOT NULL OR city IS NOT NULL").count() == 0


CURRENT = [
    (1, 1, "Bronx", "x", D[0], D[10], False),
    (1, 2, "Queens", "x", D[10], None, True),
    (2, 1, "Bronx", "x", D[0], None, True),
    (3, 1, "Bronx", None, D[0], None, True),
    (4, 1, "Bronx", "x", D[0], None, True),
]
CURRENT_SCHEMA = (
    "customer_id int, version_id int, city string, phone string, start_date date, end_date date,"
    "is_current boolean"
)
UPDATES = [
    (1, "Brooklyn", "x", D[5], 1),  # late: splits the first version
    (1, "Queens", "x", D[20], 2),  # repeats the current version
    (2, "Queens", "x", D[7], 3),  # new version
    (2, "Queens", "x", D[9], 4),  # repeats the update before it
    (2, "Bronx", "x", D[12], 5),  # back again
    (3, "Bronx", None, D[3], 6),  # null equals null
    (3, "Bronx", "y", D[4], 7),  # null to a value
    (5, "Harlem", "x", D[2], 8),  # new customer
    (5, "Inwood", "x", D[2], 9),  # same day: the later message counts
]


@pytest.mark.parametrize("hot_group_rows", [10**9, 0])
def test_versions_from_changes(spark, hot_group_rows):
    current = spark.createDataFrame(CURRENT, CURRENT_SCHEMA)
    updates = spark.createDataFrame(
        UPDATES, "customer_id int, city string, phone string, effective_date date, seq int"
    )
    got = scd2_from_changes(
        current,
        updates,
        "customer_id",
        ["city", "phone"],
        NOW,
        newest_by=["seq"],
        hot_group_rows=hot_group_rows,
    )
    columns = "customer_id version_id city phone start_date end_date is_current".split()
    assert rows(got, *columns) == [
        (1, 1, "Bronx", "x", D[0], D[5], False),
        (1, 2, "Queens", "x", D[10], None, True),
        (1, 3, "Brooklyn", "x", D[5], D[10], False),
        (2, 1, "Bronx", "x", D[0], D[7], False),
        (2, 2, "Queens", "x", D[7], D[12], False),
        (2, 3, "Bronx", "x", D[12], None, True),
        (3, 1, "Bronx", None, D[0], D[4], False),
        (3, 2, "Bronx", "y", D[4], None, True),
        (4, 1, "Bronx", "x", D[0], None, True),
        (5, 1, "Inwood", "x", D[2], None, True),
    ]


@pytest.mark.parametrize("hot_group_rows", [10**9, 0])
def test_stored_ends_stamps_numbers_and_other_columns_are_kept(spark, hot_group_rows):
    then = datetime(2020, 1, 1)
    current = spark.createDataFrame(
        [
            (1, 7, "Bronx", "a@x", D[0], D[4], False, then),  # closed, with a gap after it
            (1, 9, "Queens", "b@x", D[10], None, True, then),
            (2, 3, "Bronx", "c@x", D[0], D[5], False, then),  # closed for good
            (3, 1, "Bronx", "d@x", D[2], D[2], False, then),  # of no length
        ],
        "customer_id int, version_id int, city string, email string, start_date date,"
        "end_date date, is_current boolean, created_timestamp timestamp",
    )
    updates = spark.createDataFrame(
        [
            (1, "Harlem", D[2], 1),  # within the closed version: ends where that did
            (1, "Bronx", D[6], 2),  # in the gap: no version is in force, so it counts
            (2, "Bronx", D[9], 3),  # opens the closed customer again
            (3, "Inwood", D[2], 4),
        ],
        "customer_id int, city string, effective_date date, seq int",
    )
    got = scd2_from_changes(
        current, updates, "customer_id", ["city"], NOW, ["seq"], hot_group_rows=hot_group_rows
    )
    columns = "customer_id version_id city email start_date end_date is_current created_timestamp"
    assert rows(got, *columns.split()) == [
        (1, 10, "Harlem", "b@x", D[2], D[4], False, NOW),
        (1, 11, "Bronx", "b@x", D[6], D[10], False, NOW),
        (1, 7, "Bronx", "a@x", D[0], D[2], False, then),
        (1, 9, "Queens", "b@x", D[10], None, True, then),
        (2, 3, "Bronx", "c@x", D[0], D[5], False, then),
        (2, 4, "Bronx", "c@x", D[9], None, True, NOW),
        (3, 1, "Bronx", "d@x", D[2], D[2], False, then),
        (3, 2, "Inwood", "d@x", D[2], None, True, NOW),
    ]


def test_changes_fit_the_customer_table(spark):
    schema = TABLES["dim_customers"]
    current = spark.createDataFrame(
        [(1, 1, "Nia", "O", "n@o", "5", "2 Elm", "Bronx", D[0], None, True, NOW)], schema
    )
    updates = spark.createDataFrame([(1, "Queens", D[3])], "customer_id long, city string, effective_date date")
    got = conform(scd2_from_changes(current, updates, "customer_id", ["city"], NOW), schema)
    assert rows(got, "version_id", "first_name", "city", "end_date") == [
        (1, "Nia", "Bronx", D[3]),
        (2, "Nia", "Queens", None),
    ]


def test_applying_updates_twice_changes_nothing(spark):
    rng = random.Random(3)
    updates = spark.createDataFrame(
        [(rng.randrange(5), rng.choice("abc"), D[rng.randrange(30)], i) for i in range(120)],
        "customer_id int, city string, effective_date date, seq int",
    )
    none = spark.createDataFrame([], "customer_id int, version_id int, city string, start_date date")

    def apply(current):
        return scd2_from_changes(
            current, updates, "customer_id", ["city"], NOW, newest_by=["seq"]
        )

    once = apply(none)
    assert rows(apply(once)) == rows(once)
    open_versions = once.filter("is_current").groupBy("customer_id").count()
    assert {r["count"] for r in open_versions.collect()} == {1}


def test_all_steps_of_a_change_share_one_cut(spark, monkeypatch):
    labels = []

    def written(df, label, write=numbering.written):
        labels.append(label)
        return write(df, label)

    monkeypatch.setattr(numbering, "written", written)
    monkeypatch.setattr(numbering, "HOT_GROUP_ROWS", 20)
    rng = random.Random(5)
    data = [(rng.choice([1, 1, 2, 3, None]), rng.choice("ab"), D[rng.randrange(40)], i) for i in range(200)]
    updates = spark.createDataFrame(data, "customer_id int, city string, effective_date date, seq int")
    current = spark.createDataFrame(CURRENT, CURRENT_SCHEMA)

    def apply(**options):
        got = scd2_from_changes(current, updates, "customer_id", ["city"], NOW, ["seq"], **options)
        return rows(got)

    sliced = apply(hot_group_rows=0)
    assert labels.count("sliced") == 1
    assert sliced == apply(hot_group_rows=10**9) and labels.count("sliced") == 1

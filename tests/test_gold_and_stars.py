from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import plan, rows

from tiermill.plans import gold, stars
from tiermill.plans.dimensions import build_dim_date

T = [datetime(2024, 1, d) for d in range(1, 20)]


def ratings(spark, data):
    return spark.createDataFrame(
        data,
        "customer_id int, branch_id int, employee_id int, treatment_id int, rating_value float,"
        "timestamp timestamp, rating_id int",
    )


def test_branch_kpis(spark):
    df = ratings(spark, [(1, 1, 1, 1, 4.0, T[0], 1), (2, 1, 1, 1, 5.0, T[0], 2)]
                 + [(1, 2, 1, 1, 3.0, T[0], 3), (1, 9, 1, 1, 1.0, T[0], 4)])
    employees = spark.createDataFrame(
        [(1, 1, True), (2, 1, True), (3, 1, False), (4, 2, False), (5, 1, None)],
        "employee_id int, branch_id int, active boolean",
    )
    branches = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "branch_id int, name string")
    got = gold.gold_branch_kpis(df, employees, branches)
    assert rows(got) == [(1, 4.5, 2, "a", 2), (2, 3.0, 1, "b", 0), (9, 1.0, 1, None, 0)]


def test_color_engagement(spark):
    inventory = spark.createDataFrame(
        [(1, 1, 5), (2, 1, 6), (3, 2, 1)], "record_id int, color_id int, quantity_used int"
    )
    posts = spark.createDataFrame(
        [(1, 10, 2), (1, 4, 0), (3, 100, 100)], "color_id int, likes int, comments int"
    )
    got = gold.gold_color_engagement(inventory, posts)
    assert rows(got) == [(1, 2, 11, 14, 2, 16 / (2 + 1e-6)), (2, 1, 1, 0, 0, 0.0)]
    assert plan(got).count("Exchange hashpartitioning") == 2  # the join reuses both


def test_customer_metrics_take_the_last_by_time_then_id(spark):
    many = [(1, 1, 1, 1, 3.0, T[i], i) for i in range(10)]
    ties = [(2, 1, 1, 1, 1.0, T[3], 30), (2, 1, 1, 1, 2.0, T[3], 31), (2, 1, 1, 1, 5.0, T[1], 99)]
    df = ratings(spark, many + ties)
    for parts in (1, 7):
        got = gold.gold_customer_metrics(df.repartition(parts))
        assert rows(got) == [(1, 3.0, 10, 3.0, True), (2, pytest.approx(8 / 3), 3, 2.0, False)]
    assert rows(gold.gold_customer_metrics(df, 11), "is_vip") == [(False,), (False,)]


@pytest.mark.parametrize("options", [{}, {"broadcast_rows": 0, "hot_key_rows": 2}])
def test_rating_stars(spark, options):
    df = ratings(
        spark,
        [(1, 1, 1, 1, 4.0, T[5], i) for i in range(9)]
        + [(2, 1, 1, 1, 4.0, T[0], 50), (1, 8, 1, 1, 4.0, T[0], 51), (7, 1, 1, 1, 4.0, T[0], 52)]
        + [(1, 1, 1, 1, 4.0, datetime(2020, 1, 1), 53)],
    )
    customers = spark.createDataFrame(
        [(1, "old", "x", False), (1, "new", "x", True), (2, "two", "y", True)],
        "customer_id int, first_name string, last_name string, is_current boolean",
    )
    branches = spark.createDataFrame([(1, "b")], "branch_id int, name string")
    employees = spark.createDataFrame([(1, "e")], "employee_id int, first_name string")
    treatments = spark.createDataFrame(
        [(1, "t", Decimal("25.00"))], "treatment_id int, name string, price decimal(10,2)"
    )
    days = build_dim_date(spark, "2024-01-01", "2024-12-31")
    got = stars.ratings_star(df, customers, branches, treatments, days, **options)
    assert rows(got) == sorted(
        [(1, "new", "x", "b", "t", 4.0, "Winter")] * 9 + [(2, "two", "y", "b", "t", 4.0, "Winter")]
    )
    got = stars.sessions_star(df, customers, branches, employees, treatments, days, **options)
    assert rows(got) == sorted(
        [(1, "new", "x", "b", "e", "t", Decimal("25.00"), 4.0, "Winter", True)] * 9
        + [(2, "two", "y", "b", "e", "t", Decimal("25.00"), 4.0, "Winter", False)]
    )


def test_social_and_inventory_stars(spark):
    days = build_dim_date(spark, "2024-01-01", "2024-12-31")
    colors = spark.createDataFrame(
        [(1, "red", "Red")], "color_id int, name string, category string"
    )
    branches = spark.createDataFrame([(1, "b")], "branch_id int, name string")
    posts = spark.createDataFrame(
        [(1, 1, 5, 6, date(2024, 7, 4)), (2, 2, 5, 6, date(2024, 7, 4))],
        "post_id int, color_id int, likes int, comments int, post_date date",
    )
    assert rows(stars.social_star(posts, colors, days)) == [
        (1, "red", "Red", 5, 6, "Summer", "July")
    ]
    used = spark.createDataFrame(
        [(1, 1, 1, 5, datetime(2024, 10, 4, 23, 59)), (2, 9, 1, 5, datetime(2024, 10, 4))],
        "record_id int, branch_id int, color_id int, quantity_used int, timestamp timestamp",
    )
    assert rows(stars.inventory_star(used, colors, branches, days)) == [
        (1, 1, "red", "b", 5, "October", 4)
    ]


def test_calendar(spark):
    days = {r["date"]: r for r in build_dim_date(spark, "2020-01-01", "2025-12-31").collect()}
    assert len(days) == 2192
    xmas = days[date(2021, 12, 25)]
    assert xmas.asDict() == {
        "date_id": "20211225",
        "date": date(2021, 12, 25),
        "day_of_week": "Saturday",
        "day_of_month": 25,
        "month": "December",
        "month_number": 12,
        "quarter": 4,
        "year": 2021,
        "season": "Winter",
        "is_weekend": True,
        "is_holiday": True,
    }
    assert sum(r["is_holiday"] for r in days.values()) == 6
    seasons = {d.month: r["season"] for d, r in days.items()}
    assert [seasons[m] for m in (2, 3, 5, 6, 8, 9, 11, 12)] == (
        "Winter Spring Spring Summer Summer Fall Fall Winter".split()
    )

from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tiermill.functions.comments import DEFAULT_COMMENT, normalize_comment
from tiermill.operators import quality

NOW = datetime(2025, 6, 1)
GOOD = (1, 1, 1, 1, 4.0, "ok", NOW - timedelta(days=1))
SCHEMA = (
    "customer_id int, branch_id int, employee_id int, treatment_id int, rating_value float,"
    "comment string, timestamp timestamp"
)


def test_reasons(spark):
    data = [
        GOOD,
        (1, 1, 1, 1, None, "ok", GOOD[6]),
        (None, 1, 1, 1, 9.0, "ok", GOOD[6]),
        (1, 1, 1, 1, 4.0, "\n", NOW + timedelta(days=1)),
        (1, 1, 1, 1, 4.0, None, NOW - timedelta(days=731)),
        (1, 1, 1, 1, float("nan"), "ok", None),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    reasons = [r["reasons"] for r in quality.classify_ratings(df, NOW).collect()]
    assert sorted(reasons) == sorted(
        [
            [],
            ["bad_rating"],
            ["bad_rating", "null_key"],
            ["future"],
            ["old"],
            ["bad_rating", "null_key"],
        ]
    )
    assert dict(rows(quality.reason_counts(df, NOW))) == {
        "bad_rating": 3,
        "null_key": 2,
        "blank_comment": 0,
        "future": 1,
        "old": 1,
    }


@pytest.mark.parametrize("strict", [False, True])
def test_blank_means_what_the_cleaner_replaces(spark, strict):
    texts = ["", " ", "  ", "    ", "\n", "\t", " \n ", "ok", " ok ", None]
    data = [(*GOOD[:5], text, GOOD[6]) for text in texts]
    df = spark.createDataFrame(data, SCHEMA)
    found = quality.classify_ratings(df, NOW, strict_blank=strict)
    told = found.select(
        F.array_contains("reasons", "blank_comment").alias("blank"),
        (normalize_comment("comment", strict) == DEFAULT_COMMENT).alias("replaced"),
    ).filter("comment IS NOT NULL")
    assert told.count() == len(texts) - 1 and told.filter("blank <> replaced").count() == 0


def test_layer_counts_and_minimum(spark):
    a, b = spark.range(5), spark.range(0)
    assert rows(quality.layer_counts({"a": a, "b": b})) == [("a", 5), ("b", 0)]
    assert rows(quality.column_minimum(a, "id")) == [(0,)]


def test_observed_counts_ride_on_the_write(spark):
    df = spark.createDataFrame([(1, None), (2, float("nan")), (3, 1.0)], "a int, b double")
    watched, watch = quality.observed(df, "check", ["a", "b"])
    watched.write.format("noop").mode("overwrite").save()
    assert watch.get == {"rows": 3, "nulls_a": 0, "nulls_b": 2}


def test_check_silver_returns_offending_rows(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, 1, None, NOW), (2, 1, 1, 1, NOW.date(), NOW)],
        "record_id int, branch_id int, color_id int, quantity_used int, report_date date,"
        "ingestion_time timestamp",
    )
    assert rows(quality.check_silver("silver_inventory", df), "record_id") == [(1,)]

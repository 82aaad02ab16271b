from datetime import date, datetime, timedelta

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from tiermill.functions import predicates as p
from tiermill.operators.cleaning import keep_newest
from tiermill.operators.quality import clean_and_count, funnel
from tiermill.plans import silver

NOW = datetime(2025, 6, 1)
SCHEMA = "k long, q int, t timestamp, note string"
T = [NOW - timedelta(hours=i) for i in range(10)]
RULES = ["null_field", "quantity"]


def rules():
    return [("null_field", p.all_present(["k", "q"])), ("quantity", p.positive("q"))]


def both(df):
    got, counts = clean_and_count(df, rules(), ["k"], ["t", "q"])
    valid = df
    for _, keep in rules():
        valid = valid.filter(keep)
    assert rows(got) == rows(keep_newest(valid, ["k"], ["t", "q"]))
    assert got.columns == df.columns and got.dtypes == df.dtypes
    assert rows(counts) == rows(funnel(df, rules(), [F.col("k")]))
    return got, counts


def test_rows_and_funnel_are_those_of_two_scans(spark):
    data = [(1, 5, T[3], "a"), (1, 6, T[1], None), (1, 6, T[1], "b"), (2, 0, T[0], "x"), (2, -1, T[2], "x"),
            (None, 1, T[0], "x"), (3, None, T[0], "x"), (4, 9, None, "y"), (4, 9, None, "y")]
    got, counts = both(spark.createDataFrame(data, SCHEMA))
    assert rows(got, "k", "note") == [(1, "b"), (4, "y")]
    assert rows(counts) == [
        (1, "null_field", 9, 7, 2), (2, "quantity", 7, 5, 2), (3, "duplicate", 5, 2, 3)
    ]


@pytest.mark.parametrize("keep", ["false", "q > 100", "k IS NULL"])
def test_nothing_or_only_faults(spark, keep):
    data = [(1, 5, T[3], "a"), (None, 5, T[3], "a"), (2, 0, T[1], "a")]
    got, _ = both(spark.createDataFrame(data, SCHEMA).filter(keep))
    assert got.count() == 0


def test_bronze_is_scanned_once(spark, tmp_path):
    """The scans of the bronze files in the plans of all jobs: one, and the funnel and the rows read
    what it gathered."""
    path = str(tmp_path / "bronze")
    data = [(i % 7, i % 4, T[i % 10], "n") for i in range(50)]
    spark.createDataFrame(data, SCHEMA).write.parquet(path)
    got, counts = clean_and_count(spark.read.parquet(path), rules(), ["k"], ["t", "q"])
    for df in (got, counts):
        assert path not in plan(df) and "counted-" in df.inputFiles()[0]
    assert "Exchange" not in plan(got)


def test_silver_tables_with_counts_equal_those_without(spark):
    used = [(1, 1, 1, 5, T[1]), (1, 1, 1, 7, T[0]), (2, 1, 1, 0, T[0]), (3, None, 1, 1, T[0])]
    bronze = spark.createDataFrame(
        used, "record_id long, branch_id int, color_id int, quantity_used int, timestamp timestamp"
    )
    got, counts = silver.counted_inventory(bronze, NOW)
    assert rows(got) == rows(silver.silver_inventory(bronze, NOW))
    assert rows(counts) == rows(silver.inventory_funnel(bronze))
    said = ["ok", " ", None, "ok!", "späß"]
    ratings = spark.createDataFrame(
        [(i % 3, 1, 1, 1, 1.0 + i % 6, said[i % 5], T[i % 10], T[0], "t", 0, i, date(2025, 6, 1)) for i in range(40)],
        "customer_id long, branch_id int, employee_id int, treatment_id int, rating_value float, comment string,"
        "timestamp timestamp, processed_timestamp timestamp, _kafka_topic string, _kafka_partition int,"
        "_kafka_offset long, event_date date",
    )
    ratings = ratings.withColumn("event_date", F.to_date("timestamp"))
    got, counts = silver.counted_ratings(ratings, NOW)
    assert rows(got, *sorted(got.columns)) == rows(silver.silver_ratings(ratings, NOW), *sorted(got.columns))
    assert rows(counts) == rows(silver.ratings_funnel(ratings, NOW))

import random
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from tiermill.operators import history
from tiermill.operators.buckets import BUCKET, bucket_count, create_bucketed, rewrite_touched, with_bucket
from tiermill.sources.tables import TableStore

NOW = datetime(2025, 6, 1)
LATER = datetime(2025, 6, 2)
D = [date(2024, 1, 1) + timedelta(days=i) for i in range(60)]
UPDATE = "customer_id long, city string, effective_date date, seq int"
CURRENT = "customer_id long, city string, email string, start_date date, version_id long"
RATING = "customer_id long, rating_date date, rating_id long"


@pytest.fixture
def store(spark, tmp_path):
    made = TableStore(spark, str(tmp_path / "store"), database="tiermill_bucket_tests")
    for table in made.tables():
        made.drop(table)
    return made


def files(store, table):
    """Data files by bucket, with the time of their last change."""
    found = {}
    for path in Path(store.root, table).rglob("*.parquet"):
        bucket = int(path.parent.name.partition("=")[2])
        found.setdefault(bucket, set()).add((path.name, path.stat().st_mtime_ns))
    return found


def current(spark, customers=200):
    data = [(c, "Kiel", f"{c}@x", D[0], 1) for c in range(customers)]
    return spark.createDataFrame(data, CURRENT)


def updates(spark, seed, day, customers):
    r = random.Random(seed)
    data = [(c, r.choice(["Kiel", "Husum", "Jever"]), D[day], i) for i, c in enumerate(customers)]
    return spark.createDataFrame(data, UPDATE)


def test_a_day_of_updates_rewrites_only_its_buckets(spark, store):
    base = current(spark)
    history.create_history(store, "h", base, "customer_id", ["city"], NOW, buckets=32)
    assert bucket_count(store, "h") == 32 and len(files(store, "h")) > 25
    whole, before = base, files(store, "h")
    every = None
    for day, customers in ((5, [3, 4, 5, 3]), (6, [4, 900]), (2, [3])):
        day_updates = updates(spark, day, day, customers)
        touched = history.update_history(store, "h", day_updates, "customer_id", ["city"], NOW, ["seq"])
        wanted = with_bucket(day_updates, "customer_id", 32).select(BUCKET).distinct()
        assert touched == sorted(r[0] for r in wanted.collect()) and 1 <= len(touched) <= 3
        after = files(store, "h")
        assert {b for b in after if after[b] != before.get(b)} == set(touched)
        before = after
        every = day_updates if every is None else every.union(day_updates)
    whole = history.scd2_from_changes(base, every, "customer_id", ["city"], NOW, ["seq"])
    columns = [c for c in whole.columns if c != "version_id"]
    assert rows(store.read("h"), *columns) == rows(whole, *columns)
    # A late update is numbered after those that were there before it.
    numbers = store.read("h").filter("customer_id = 3").select("version_id").collect()
    assert sorted(r[0] for r in numbers) == list(range(1, len(numbers) + 1))


def test_the_same_updates_again_change_nothing(spark, store):
    history.create_history(store, "h", current(spark), "customer_id", ["city"], NOW, buckets=8)
    day = updates(spark, 1, 9, [1, 2, 3, 500])
    history.update_history(store, "h", day, "customer_id", ["city"], NOW, ["seq"])
    first = rows(store.read("h"))
    history.update_history(store, "h", day, "customer_id", ["city"], LATER, ["seq"])
    assert rows(store.read("h")) == first


def test_a_hot_key_is_cut_into_slices(spark, store):
    hot = [(7, f"c{i % 3}", D[1] + timedelta(days=i), i) for i in range(300)]
    others = [(c, "Jever", D[3], c) for c in range(40)]
    all_updates = spark.createDataFrame(hot + others, UPDATE)
    base = current(spark, 40)
    history.create_history(store, "h", base, "customer_id", ["city"], NOW, buckets=4)
    history.update_history(
        store, "h", all_updates, "customer_id", ["city"], NOW, ["seq"], hot_group_rows=50
    )
    whole = history.scd2_from_changes(base, all_updates, "customer_id", ["city"], NOW, ["seq"])
    assert rows(store.read("h").drop(BUCKET), *whole.columns) == rows(whole)


def test_only_touched_buckets_are_read(spark, store):
    history.create_history(store, "h", current(spark), "customer_id", ["city"], NOW, buckets=32)
    seen = []

    def rebuild(stored, arrived):
        seen.append(plan(stored))
        return stored

    rewrite_touched(store, "h", "customer_id", updates(spark, 1, 1, [3]), rebuild)
    assert "PartitionFilters: [" in seen[0] and f"{BUCKET}#" in seen[0].split("PartitionFilters: [")[1]


def test_updates_without_key_or_rows(spark, store):
    history.create_history(store, "h", current(spark), "customer_id", ["city"], NOW, buckets=8)
    before = files(store, "h")
    nobody = updates(spark, 1, 1, [None, None])
    assert history.update_history(store, "h", nobody, "customer_id", ["city"], NOW) == []
    assert history.update_history(store, "h", nobody.limit(0), "customer_id", ["city"], NOW) == []
    assert files(store, "h") == before
    store.write(spark.range(1), "plain", "create")
    with pytest.raises(ValueError, match="buckets"):
        bucket_count(store, "plain")


@pytest.mark.parametrize("hot_group_rows", [10**9, 3])
def test_event_histories_are_kept_up(spark, store, hot_group_rows):
    r = random.Random(4)
    data = [(r.randrange(6), D[r.randrange(20)], i) for i in range(60)]
    parts = [data[:25], data[25:40], data[30:60]]  # the last one repeats some
    history.create_event_history(store, "e", spark.createDataFrame(parts[0], RATING), NOW, buckets=4)
    for part in parts[1:]:
        arrived = spark.createDataFrame(part, RATING)
        history.update_event_history(store, "e", arrived, LATER, hot_group_rows)
    whole = history.scd2_from_events(spark.createDataFrame(data, RATING), NOW)
    columns = ["customer_id", "version_id", "start_date", "end_date", "is_current"]
    got = store.read("e")
    assert rows(got, *columns) == rows(whole, *columns)
    stamps = {r["rating_id"]: r["created_timestamp"] for r in got.collect()}
    assert {i for i, stamp in stamps.items() if stamp == NOW} == set(range(25))
    assert got.filter(F.col("city").isNotNull()).count() == 0


def test_rows_without_a_key_stay(spark, store):
    df = spark.createDataFrame([(None, 1), (1, 2)], "k long, x long")
    create_bucketed(store, df, "t", "k", 4)
    arrived = spark.createDataFrame([(1, 5), (None, 9)], "k long, x long")
    rewrite_touched(store, "t", "k", arrived, lambda old, new: new)
    assert rows(store.read("t"), "k", "x") == [(1, 5), (None, 1)]

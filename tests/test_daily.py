import random
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from tiermill.operators.daily_numbers import PLACE, renumber
from tiermill.operators.numbering import number_all
from tiermill.operators.partials import Average, Count, DailyState, Newest, Total
from tiermill.sources.tables import TableStore, in_days

D = [date(2024, 1, 20) + timedelta(days=i) for i in range(30)]
SCHEMA = "day date, key long, value float, seq long"


@pytest.fixture
def store(spark, tmp_path):
    made = TableStore(spark, str(tmp_path / "store"), database="tiermill_daily_tests")
    for table in made.tables():
        made.drop(table)
    return made


def facts(spark, days, count=150, seed=1):
    r = random.Random(seed)
    data = [
        (r.choice(days), r.choice([1, 1, 1, 2, 3, None]), r.choice([None, r.randrange(50) / 4]), i)
        for i in range(count)
    ]
    return spark.createDataFrame(data, SCHEMA)


def files(store, table):
    found = {}
    for path in Path(store.root, table).rglob("*.parquet"):
        found.setdefault(path.parent.name, set()).add((path.name, path.stat().st_mtime_ns))
    return found


def changed(before, after):
    return {folder for folder in after if after[folder] != before.get(folder)}


MEASURES = [Average("mean", "value"), Count("n", "value"), Total("sum", "value"), Newest("last", "value", ["seq"])]


def whole(df):
    return df.groupBy("key").agg(
        F.avg("value").alias("mean"), F.count("value").alias("n"), F.sum("value").alias("sum"),
        F.max_by("value", "seq").alias("last"),
    )


def test_states_follow_late_rows_and_deleted_days(spark, store):
    state = DailyState(store, "state", "day", ["key"], MEASURES)
    first = facts(spark, [*D, None])
    state.refresh(first)
    assert rows(state.result()) == rows(whole(first))
    before, months = files(store, "state"), files(store, "state_months")
    late = facts(spark, [D[3], D[4]], 10, seed=2).withColumn("seq", F.col("seq") + 500)
    second = first.union(late)
    state.refresh(second, [D[3], D[4]])
    assert rows(state.result()) == rows(whole(second))
    after = files(store, "state")
    assert changed(before, after) == {f"day={D[3]}", f"day={D[4]}"}
    assert changed(months, files(store, "state_months")) == {"state_month=2024-01"}
    third = second.filter(~F.col("day").eqNullSafe(F.lit(D[20])))
    for _ in range(2):  # also when it is repeated
        state.refresh(third, [D[20], None])
        assert rows(state.result()) == rows(whole(third))
    assert f"day={D[20]}" not in files(store, "state")
    nothing = third.filter(F.col("day").isNull())
    state.refresh(nothing, D)
    assert rows(state.result()) == rows(whole(nothing))
    assert set(files(store, "state_months")) == {"state_month=__HIVE_DEFAULT_PARTITION__"}
    state.refresh(nothing.limit(0), [None])
    assert state.result().count() == 0


def test_only_the_given_days_of_the_source_are_read(spark, store):
    store.write(facts(spark, D), "facts", "create", ["day"])
    read = plan(store.read("facts").filter(in_days("day", [D[3], None])))
    assert "PartitionFilters: [(" in read and "day#" in read.split("PartitionFilters: [(")[1]


def check_numbers(store, df):
    order = ["day", "seq", "key"]
    wanted = number_all(df, order, "number").select("number", "seq")
    assert rows(store.read("numbered"), "number", "seq") == rows(wanted)


def test_numbers_last_where_nothing_before_them_changes(spark, store):
    def number(df, days):
        return renumber(store, "numbered", df, days, "day", ["seq", "key"], "number")

    data = facts(spark, [*D[:10], None])
    assert number(data, [*D[:10], None]) == {"sorted": 11, "shifted": 0}
    check_numbers(store, data)
    before = files(store, "numbered")
    late = facts(spark, [D[6]], 4, seed=3).withColumn("seq", F.col("seq") + 1000)
    more = data.union(late)
    assert number(more, [D[6]]) == {"sorted": 1, "shifted": 3}
    check_numbers(store, more)
    assert changed(before, files(store, "numbered")) == {f"day={d}" for d in D[6:10]}

    # The same number of rows: nothing after the day moves.
    before = files(store, "numbered")
    other = more.withColumn("seq", F.when(F.col("day") == F.lit(D[2]), -F.col("seq")).otherwise(F.col("seq")))
    assert number(other, [D[2]]) == {"sorted": 1, "shifted": 0}
    check_numbers(store, other)
    assert changed(before, files(store, "numbered")) == {f"day={D[2]}"}

    fewer = other.filter(F.col("day").isNull() | (F.col("day") != F.lit(D[4])))
    assert number(fewer, [D[4]]) == {"sorted": 0, "shifted": 5}
    check_numbers(store, fewer)
    grown = fewer.union(facts(spark, [D[12]], 3, seed=5))
    assert number(grown, [D[12], D[29]]) == {"sorted": 1, "shifted": 0}
    check_numbers(store, grown)
    assert store.read("numbered").filter(F.col(PLACE) < 1).count() == 0


def test_a_numbering_cut_short_is_repeated(spark, store, monkeypatch):
    def number(df, days):
        return renumber(store, "numbered", df, days, "day", ["seq", "key"], "number")

    data = facts(spark, D[:5])
    number(data, D[:5])
    more = data.union(facts(spark, [D[1]], 7, seed=9).withColumn("seq", F.col("seq") + 1000))
    write = store.write

    def fail(df, table, *rest):
        if table == "numbered_days":
            raise RuntimeError("lost")
        write(df, table, *rest)

    monkeypatch.setattr(store, "write", fail)
    with pytest.raises(RuntimeError):
        number(more, [D[1]])
    monkeypatch.undo()
    number(more, [D[1]])
    check_numbers(store, more)


def test_tables_are_read_by_time(spark, store):
    def at(day, hour):
        return datetime(2024, 5, day, hour)

    raw = [(1, at(1, 23)), (2, at(2, 1)), (3, at(2, 12)), (4, at(4, 0))]
    ratings = spark.createDataFrame(raw, "_kafka_offset long, timestamp timestamp").select(
        *[F.lit(None).cast(t).alias(c) for c, t in (("customer_id", "long"), ("branch_id", "int"),
          ("employee_id", "int"), ("treatment_id", "int"), ("rating_value", "float"), ("comment", "string"),
          ("processed_timestamp", "timestamp"), ("_kafka_topic", "string"), ("_kafka_partition", "int"))],
        "_kafka_offset", "timestamp", F.to_date("timestamp").alias("event_date"),
    )
    store.write(ratings, "bronze_ratings", "create")
    got = store.read("bronze_ratings", since=at(2, 0), until=at(2, 12))
    assert rows(got, "_kafka_offset") == [(2,), (3,)]
    filters = plan(got).split("PartitionFilters: [")[1].split("]")[0]
    assert "2024-05-01" in filters and "2024-05-03" in filters
    posts = spark.createDataFrame(
        [(i, 1, 1, 1, date(2024, 5, i), date(2024, 5, i)) for i in (1, 2, 3)],
        "post_id long, color_id int, likes int, comments int, post_date date, ingestion_date date",
    )
    store.write(posts, "bronze_instagram", "create")
    got = store.read("bronze_instagram", since=at(2, 13))
    assert rows(got, "post_id") == [(2,), (3,)] and "PartitionFilters: [isnotnull" in plan(got)
    used = spark.createDataFrame(
        [(i, 1, 1, 1, date(2024, 5, i), at(1, 1)) for i in (1, 2, 3)],
        "record_id long, branch_id int, color_id int, quantity_used int, report_date date, ingestion_time timestamp",
    )
    store.write(used, "silver_inventory", "create")
    got = store.read("silver_inventory", until=date(2024, 5, 1))
    assert rows(got, "record_id") == [(1,)] and "PartitionFilters: [isnotnull" in plan(got)
    store.write(spark.range(1), "plain", "create")
    with pytest.raises(ValueError, match="partitioned"):
        store.read("plain", since=at(1, 1))


def test_counts_come_from_footers(spark, store):
    df = facts(spark, [*D[:3], None])
    for table, partitions in (("plain", None), ("daily", ["day"])):
        store.write(df, table, "create", partitions)
        counts = store.footer_counts(table, ["key", "value"])
        wanted = df.selectExpr("count(*)", "count_if(key IS NULL)", "count_if(value IS NULL)")
        assert rows(counts) == rows(wanted)
        text = counts._jdf.queryExecution().executedPlan().toString()
        pushed = counts._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        assert "BatchScan" in text and "PushedAggregation: [COUNT(*), COUNT(key), COUNT(value)]" in pushed
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_overwriting_partitions_leaves_the_session_alone(spark, store):
    mode = "spark.sql.sources.partitionOverwriteMode"
    store.write(facts(spark, D[:3]), "daily", "create", ["day"])
    before = spark.conf.get(mode)
    one = facts(spark, [D[1]], 2, seed=8)
    store.write(one, "daily", "overwrite_partitions")
    assert spark.conf.get(mode) == before == "STATIC"
    assert store.read("daily").filter(F.col("day") == F.lit(D[1])).count() == 2
    assert store.read("daily").select("day").distinct().count() == 3
    store.drop_partitions("daily", [D[1], D[9], None])
    assert store.read("daily").select("day").distinct().count() == 2

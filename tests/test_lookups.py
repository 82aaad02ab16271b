import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from tiermill.operators import lookups
from tiermill.operators.lookups import hot_keys, lookup_all, salted_join

FACTS = [(i, 1 if i % 3 == 0 else (None if i % 11 == 0 else i % 20)) for i in range(300)]
DIM = [(k, f"name {k}") for k in range(15)] + [(1, "second name")]


def _frames(spark):
    fact = spark.createDataFrame(FACTS, "id int, key int").repartition(5)
    return fact, spark.createDataFrame(DIM, "key int, name string")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_rows", [1, 10, 1000])
def test_salted_join_equals_the_plain_join(spark, how, hot_rows):
    fact, dim = _frames(spark)
    got = salted_join(fact, dim, ["key"], hot_keys(fact, ["key"], hot_rows), how)
    want = fact.join(dim, ["key"], how)
    assert rows(got, "id", "key", "name") == rows(want, "id", "key", "name")


def test_salted_join_of_equal_rows(spark):
    fact = spark.range(500).select(F.lit(1).alias("key"))
    dim = spark.createDataFrame(DIM, "key int, name string")
    got = salted_join(fact, dim, ["key"], hot_keys(fact, ["key"], 10))
    assert rows(got.groupBy("name").count()) == [("name 1", 500), ("second name", 500)]


def test_hot_keys_say_into_how_many_parts(spark):
    fact, _ = _frames(spark)
    n = sum(1 for _, k in FACTS if k == 1)
    assert rows(hot_keys(fact, ["key"], 50)) == [(1, -(-n // 50))]


def test_other_salting_is_refused(spark):
    fact, dim = _frames(spark)
    with pytest.raises(ValueError):
        salted_join(fact, dim, ["key"], hot_keys(fact, ["key"]), "full")


def test_wide_dimensions_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", 10_000)
    narrow = spark.range(20).select("id", F.lit("x").alias("s"), F.array(F.lit(1)).alias("a"))
    wide = spark.range(20).select("id", F.expr("repeat('x', 1000)").alias("s"))
    nested = spark.range(20).select("id", F.expr("array_repeat(repeat('x', 500), 2)").alias("a"))
    assert lookups._measured_small([narrow, wide, nested], 100) == [True, False, False]
    assert lookups._measured_small([narrow], 10) == [False]


def test_broadcast_only_when_measured_small(spark):
    fact, dim = _frames(spark)
    small = lookup_all(fact, [(dim, ["key"])])
    large = lookup_all(fact, [(dim, ["key"])], broadcast_rows=3)
    assert "BroadcastHashJoin" in plan(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(large)
        assert "SortMergeJoin" in text and "_salt" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(small, "id", "key", "name") == rows(large, "id", "key", "name")


def test_a_reused_result_of_a_shuffle_is_written(spark):
    fact, dim = _frames(spark)
    kept = lookup_all(fact, [(dim, ["key"])], broadcast_rows=3, reused=True)
    assert "Join" not in plan(kept)
    assert rows(kept, "id", "key", "name") == rows(fact.join(dim, "key"), "id", "key", "name")

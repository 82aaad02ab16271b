from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tiermill import schemas, session
from tiermill.plans.bronze import bronze_instagram, bronze_inventory
from tiermill.plans.dimensions import build_dim_date, load_dimension
from tiermill.sources.files import preview, read_csv
from tiermill.sources.tables import TableStore

NOW = datetime(2025, 6, 1, 12)


def _file(tmp_path, text):
    path = tmp_path / "data.csv"
    path.write_text(text)
    return str(path)


def test_bad_cells_become_null(spark, tmp_path):
    path = _file(
        tmp_path,
        "record_id,branch_id,color_id,quantity_used,timestamp\n"
        "1,2,3,4,2025-05-01T10:00:00.123456\n"
        "x,2,3,4,2025-05-01 10:00:00\n"
        "2,,3,many,never\n",
    )
    t = datetime(2025, 5, 1, 10)
    assert rows(bronze_inventory(spark, path)) == [
        (1, 2, 3, 4, t.replace(microsecond=123456)),
        (2, None, 3, None, None),
        (None, 2, 3, 4, t),
    ]
    kept = read_csv(spark, path, schemas.INVENTORY_CSV, keep_corrupt=True).cache()
    assert kept.filter("_corrupt_record IS NOT NULL").count() == 2


def test_instagram_csv(spark, tmp_path, capsys):
    path = _file(
        tmp_path,
        "post_id,color_id,likes,comments,post_date,ingestion_date\n"
        "7,3,41,6,2023-02-03,2023-02-05\n,4,2,5,2023-03-01,2023-03-01\n",
    )
    df = bronze_instagram(spark, path)
    assert rows(df) == [
        (7, 3, 41, 6, date(2023, 2, 3), date(2023, 2, 5)),
        (None, 4, 2, 5, date(2023, 3, 1), date(2023, 3, 1)),
    ]
    preview(df)
    assert "post_id: long" in capsys.readouterr().out


@pytest.mark.parametrize("infer", [True, False])
def test_dimensions_are_cast_to_the_declared_types(spark, tmp_path, infer):
    path = _file(
        tmp_path, "treatment_id,name,price,duration_minutes,active\n1,Basic,25.0,30,True\n"
    )
    df = load_dimension(spark, "dim_treatments", path, NOW, infer_schema=infer)
    assert df.dtypes == [
        (f.name, f.dataType.simpleString()) for f in schemas.TABLES["dim_treatments"].fields
    ]
    assert rows(df) == [(1, "Basic", Decimal("25.00"), 30, True, NOW)]


def test_open_customer_versions_and_text_date_ids(spark, tmp_path):
    path = _file(
        tmp_path,
        "customer_id,version_id,first_name,last_name,email,phone,address,city,start_date,end_date,"
        "is_current\n1,2,G,E,g@e,+1,1 Oak,Bronx,2020-10-14,,True\n",
    )
    df = load_dimension(spark, "dim_customers", path, NOW)
    assert rows(df, "start_date", "end_date", "is_current") == [(date(2020, 10, 14), None, True)]

    days = str(tmp_path / "days")
    build_dim_date(spark, "2024-01-01", "2024-01-31").write.option("header", True).csv(days)
    for infer in (True, False):
        df = load_dimension(spark, "dim_date", days, NOW, infer_schema=infer)
        assert df.schema["date_id"].dataType.simpleString() == "string"
        assert df.filter("date_id = '20240131' AND season = 'Winter'").count() == 1


def test_conform_refuses_missing_columns(spark):
    with pytest.raises(ValueError, match="likes"):
        schemas.conform(spark.range(1), schemas.INSTAGRAM_CSV)


@pytest.fixture
def store(spark, tmp_path):
    made = TableStore(spark, str(tmp_path / "store"), database="tiermill_tests")
    for table in made.tables():
        made.drop(table)
    return made


def _used(spark, *data):
    return spark.createDataFrame(
        [(i, 1, 1, q, d, NOW) for i, q, d in data], schemas.TABLES["silver_inventory"]
    )


def test_create_fails_on_an_existing_table(spark, store):
    df = spark.range(3)
    store.write(df, "plain", "create")
    with pytest.raises(AnalysisException):
        store.write(df, "plain", "create")
    assert store.read("plain").count() == 3 and store.tables() == ["plain"]
    assert store.count("plain").first()["total_rows"] == 3
    with pytest.raises(ValueError):
        store.write(df, "plain", "merge")
    store.drop("plain")
    store.drop("plain")
    assert store.tables() == []


def test_append_and_replace(spark, store):
    store.write(spark.range(3), "plain", "append")
    store.write(spark.range(2), "plain", "append")
    assert store.read("plain").count() == 5
    # a table may be replaced by a query that reads it
    store.write(store.read("plain").filter("id > 1"), "plain", "replace")
    assert rows(store.read("plain")) == [(2,)]
    with pytest.raises(ValueError, match="no partitions"):
        store.write(spark.range(1), "plain", "overwrite_partitions")
    assert rows(store.read("plain")) == [(2,)]


def test_a_replacement_may_have_other_columns(spark, store):
    store.write(spark.range(3), "plain", "create")
    store.write(spark.createDataFrame([("a", 1.5)], "s string, value double"), "plain", "replace")
    assert store.read("plain").columns == ["s", "value"]
    assert rows(store.read("plain")) == [("a", 1.5)] and store.tables() == ["plain"]


def test_a_replacement_that_was_cut_short_is_completed(spark, store, monkeypatch):
    day = date(2025, 1, 1)
    store.write(_used(spark, (1, 1, day)), "silver_inventory", "create")

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(store, "_rename", fail)
    with pytest.raises(RuntimeError):
        store.write(_used(spark, (2, 2, day)), "silver_inventory", "replace")
    monkeypatch.undo()
    assert store.tables() == ["silver_inventory"]
    assert rows(store.read("silver_inventory"), "record_id") == [(2,)]


def test_a_failed_write_keeps_the_old_rows(spark, store):
    day = date(2025, 1, 1)
    store.write(_used(spark, (1, 1, day)), "silver_inventory", "create")
    broken = _used(spark, (2, 2, day)).withColumn("record_id", F.raise_error(F.lit("broken")).cast("long"))
    with pytest.raises(Exception, match="broken"):
        store.write(broken, "silver_inventory", "replace")
    assert rows(store.read("silver_inventory"), "record_id") == [(1,)]


def test_dropped_tables_leave_no_files(spark, store, tmp_path):
    store.write(spark.range(3), "plain", "create")
    store.drop("plain")
    assert not (tmp_path / "store" / "plain").exists()


def test_files_of_replaced_versions_can_be_dropped(spark, store, tmp_path):
    for n in (3, 2, 4):
        store.write(spark.range(n), "plain", "replace")
    # the version before stays for its readers
    assert len(list((tmp_path / "store" / "plain").glob("v-*"))) == 2
    store.drop_old_files("plain")
    assert len(list((tmp_path / "store" / "plain").glob("v-*"))) == 1
    assert store.read("plain").count() == 4


def test_rows_are_cast_on_write(spark, store):
    df = spark.createDataFrame(
        [(1, 4.25, 3, 5.0, True)],
        "customer_id int, avg_rating double, total_ratings int, last_rating double, is_vip boolean",
    )
    store.write(df.select(*reversed(df.columns)), "gold_customer_metrics", "replace")
    assert store.read("gold_customer_metrics").schema == schemas.TABLES["gold_customer_metrics"]
    assert rows(store.read("gold_customer_metrics")) == [(1, 4.25, 3, 5.0, True)]


def test_partitioned_table(spark, store):
    d1, d2, d3 = date(2025, 1, 1), date(2025, 1, 2), date(2025, 1, 3)
    table = "silver_inventory"
    store.create(table)
    store.create(table)
    assert store.read(table).count() == 0
    store.write(_used(spark, (1, 1, d1), (2, 2, d2)), table, "append")
    store.write(_used(spark, (3, 3, d2)), table, "append")
    assert rows(store.read(table), "record_id") == [(1,), (2,), (3,)]
    store.write(_used(spark, (4, 4, d2), (5, 5, d3)), table, "overwrite_partitions")
    assert rows(store.read(table), "record_id", "report_date") == [(1, d1), (4, d2), (5, d3)]
    one_day = store.read(table).filter(F.col("report_date") == d3)
    assert "report_date" in one_day._jdf.queryExecution().executedPlan().toString()
    assert rows(one_day, "record_id") == [(5,)]
    store.write(_used(spark, (6, 6, d3)), table, "replace")
    assert rows(store.read(table), "record_id", "report_date") == [(6, d3)]
    store.write(_used(spark, (7, 7, d1)), table, "overwrite_partitions")
    assert rows(store.read(table), "record_id") == [(6,), (7,)]


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.new_path(spark, "x") != session.new_path(spark, "x")

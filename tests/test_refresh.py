from dataclasses import replace
from datetime import datetime
from pathlib import Path
from threading import Event, Thread

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tiermill import schemas
from tiermill.plans.dimensions import build_dim_date
from tiermill.plans import refresh as plans
from tiermill.plans.refresh import JOBS, NEEDS, Sources, refresh, run_job
from tiermill.session import intermediates, shared_dir, written
from tiermill.sources.envelope import ENVELOPE
from tiermill.sources.tables import TableStore
from tiermill.streaming.ratings import parse_ratings, write_batch

NOW = datetime(2025, 6, 1, 12)

FILES = {
    "dim_branches": "branch_id,name,city,address,active,opening_date\n1,Harbour,Kiel,4 Quay,True,2019-04-01\n",
    "dim_employees": "employee_id,first_name,last_name,role,experience_years,active,hire_date,"
    "branch_id\n1,Ole,T,Trainee,1,True,2021-02-01,1\n2,Ida,W,Lead,9,False,2018-02-01,1\n",
    "dim_colors": "color_id,name,hex_code,category,active\n1,Teal,#008080,Blue,True\n",
    "dim_treatments": "treatment_id,name,price,duration_minutes,active\n1,Short,17.5,20,True\n",
    "dim_customers": "customer_id,version_id,first_name,last_name,email,phone,address,city,start_date,"
    "end_date,is_current\n1,1,Lea,K,l@k,+9,3 Lime,Husum,2021-11-02,,True\n",
    "inventory": "record_id,branch_id,color_id,quantity_used,timestamp\n"
    "1,1,1,5,2025-05-01 10:00:00\n1,1,1,6,2025-05-01 11:00:00\n2,1,1,0,2025-05-02 10:00:00\n",
    "instagram": "post_id,color_id,likes,comments,post_date,ingestion_date\n"
    "1,1,10,2,2025-05-01,2025-05-02\n2,1,-1,2,2025-05-01,2025-05-02\n",
}


@pytest.fixture
def sources(spark, tmp_path):
    for name, text in FILES.items():
        (tmp_path / f"{name}.csv").write_text(text)
    build_dim_date(spark, "2020-01-01", "2025-12-31").write.option("header", True).csv(
        str(tmp_path / "dim_date.csv")
    )
    messages = [
        (None, text.encode(), "ratings", 0, i, NOW)
        for i, text in enumerate(
            [
                '{"customer_id":1,"branch_id":1,"employee_id":1,"treatment_id":1,"rating_value":4.0,'
                '"comment":"ok","timestamp":"2025-05-01T10:00:00"}',
                '{"customer_id":1,"branch_id":1,"employee_id":1,"treatment_id":1,"rating_value":5.0,'
                '"comment":"","timestamp":"2025-05-02T10:00:00"}',
                "no json",
            ]
        )
    ]
    parsed = parse_ratings(spark.createDataFrame(messages, ENVELOPE))
    write_batch(parsed, 0, str(tmp_path / "ratings"), ["event_date"])
    dims = [name for name in schemas.TABLES if name.startswith("dim_")]
    return Sources(
        inventory_csv=str(tmp_path / "inventory.csv"),
        instagram_csv=str(tmp_path / "instagram.csv"),
        dimension_files={name: str(tmp_path / f"{name}.csv") for name in dims},
        ratings_path=str(tmp_path / "ratings"),
    )


@pytest.fixture
def store(spark, tmp_path):
    made = TableStore(spark, str(tmp_path / "store"), database="tiermill_refresh_tests")
    for table in made.tables():
        made.drop(table)
    return made


def test_refresh_twice_gives_the_same_tables(store, sources):
    wanted = [
        ("bronze_instagram", 2),
        ("bronze_inventory", 3),
        ("bronze_ratings", 3),
        ("customer_rating_versions", 2),
        ("gold_branch_kpis", 1),
        ("gold_color_engagement", 1),
        ("gold_customer_metrics", 1),
        ("silver_instagram", 1),
        ("silver_inventory", 1),
        ("silver_ratings", 2),
    ]
    for _ in range(2):
        assert rows(refresh(store, sources, NOW)) == wanted
    assert rows(store.read("gold_branch_kpis")) == [(1, 4.5, 2, "Harbour", 1)]
    assert rows(store.read("gold_color_engagement"))[0][:5] == (1, 1, 6, 10, 2)
    assert rows(store.read("gold_customer_metrics")) == [(1, 4.5, 2, 5.0, False)]
    assert store.read("dim_customers").filter("first_name = 'Lea'").count() == 1
    assert store.read("dim_date").count() == 2192
    for table in store.tables():
        assert dict(store.read(table).dtypes) == {
            f.name: f.dataType.simpleString() for f in schemas.TABLES[table].fields
        }, table


def test_jobs_leave_no_intermediates(store, sources):
    folder = Path(shared_dir(store.spark)) / "tiermill"
    before = set(folder.glob("*"))
    run_job("silver_ratings", store, sources, NOW)
    assert set(folder.glob("*")) == before


def test_silver_jobs_count_during_the_write(store, sources):
    run_job("bronze_inventory", store, sources, NOW)
    metrics = run_job("silver_inventory", store, sources, NOW)
    assert metrics["rows"] == 1 and metrics["nulls_record_id"] == 0
    assert metrics["dropped_quantity"] == 1 and metrics["dropped_duplicate"] == 1
    assert run_job("dimensions", store, sources, NOW) == {}


def test_a_failing_job_raises(store, sources):
    with pytest.raises(Exception, match="bronze_inventory"):
        run_job("silver_inventory", store, sources, NOW)


def test_ratings_come_from_the_table_without_a_stream(store, sources):
    metrics = run_job("silver_ratings", store, Sources(), NOW)
    assert metrics["dropped_future"] == 0
    assert store.read("silver_ratings").count() == 0
    assert list(JOBS)[0] == "dimensions"


def test_intermediates_are_deleted_after_the_block(spark):
    with intermediates(spark):
        df = written(spark.range(3), "probe")
        path = df.inputFiles()[0]
        assert df.count() == 3
    assert not Path(path.removeprefix("file://")).exists()
    kept = written(spark.range(3).withColumn("x", F.lit(1)), "probe")
    assert kept.count() == 3


def test_late_posts_are_merged_kept_or_set_aside(store, sources, tmp_path):
    head = "post_id,color_id,likes,comments,post_date,ingestion_date\n"
    (tmp_path / "late.csv").write_text(
        head + "9,1,5,1,2025-05-31,2025-06-01\n8,1,5,1,2025-04-01,2025-06-01\n"
    )
    run_job("bronze_instagram", store, sources, NOW)
    late = replace(sources, late_instagram_csv=str(tmp_path / "late.csv"))
    for _ in range(2):
        assert run_job("late_instagram", store, late, NOW) == {"arrived": 2, "too_late": 1}
        assert rows(store.read("bronze_instagram"), "post_id") == [(1,), (2,), (9,)]
    assert rows(store.read("rejected_late_posts"), "post_id") == [(8,)]


def test_blocks_in_two_threads_keep_their_own_files(spark):
    first_is_open, second_is_done, found = Event(), Event(), []

    def outer():
        with intermediates(spark):
            df = written(spark.range(5), "outer")
            first_is_open.set()
            second_is_done.wait(60)
            found.append(df.count())

    thread = Thread(target=outer)
    thread.start()
    first_is_open.wait(60)
    with intermediates(spark):
        assert written(spark.range(3), "inner").count() == 3
    second_is_done.set()
    thread.join(60)
    assert found == [5]


def test_independent_jobs_overlap_and_needed_ones_come_first(store, monkeypatch):
    """Jobs that note when they run: the independent ones meet, and nothing starts before what it needs."""
    started, ended, together = [], [], Event()

    def job(name):
        def run(*_):
            started.append((name, list(ended)))
            if len({n for n, _ in started} - set(ended)) >= 3:
                together.set()
            assert name not in ("dimensions", "bronze_inventory") or together.wait(60)
            ended.append(name)

        return run

    monkeypatch.setattr(plans, "JOBS", {name: job(name) for name in JOBS})
    plans._run_graph(store, Sources(), NOW, None, set(), 4)
    assert sorted(ended) == sorted(JOBS) and together.is_set()
    for name, before in started:
        assert set(NEEDS.get(name, ())) <= set(before)


def test_a_failed_run_goes_on_with_the_jobs_that_are_missing(store, sources, monkeypatch):
    ran = []

    def watched(name, broken):
        def run(*args):
            ran.append(name)
            if name == broken:
                raise RuntimeError("lost")
            return JOBS[name](*args)

        return run

    monkeypatch.setattr(plans, "JOBS", {name: watched(name, "silver_ratings") for name in JOBS})
    with pytest.raises(RuntimeError, match="lost"):
        refresh(store, sources, NOW, run="monday")
    noted = {r["job"] for r in store.read("refresh_jobs").collect()}
    assert "silver_ratings" in ran and "gold_branch_kpis" not in ran
    assert noted == set(ran) - {"silver_ratings"}
    ran.clear()
    monkeypatch.setattr(plans, "JOBS", {name: watched(name, None) for name in JOBS})
    assert refresh(store, sources, NOW, run="monday").count() == 10
    assert sorted([*ran, *noted]) == sorted(JOBS)
    ran.clear()
    refresh(store, sources, NOW, run="monday")
    assert ran == []


def test_silver_jobs_that_keep_nothing_end(spark, store, tmp_path):
    (tmp_path / "bad.csv").write_text(
        "record_id,branch_id,color_id,quantity_used,timestamp\n2,1,1,0,2025-05-02 10:00:00\n"
    )
    (tmp_path / "bad_posts.csv").write_text(
        "post_id,color_id,likes,comments,post_date,ingestion_date\n2,1,-1,2,2025-05-01,2025-05-02\n"
    )
    build_dim_date(spark, "2025-01-01", "2025-12-31").write.option("header", True).csv(str(tmp_path / "days"))
    bad = Sources(
        inventory_csv=str(tmp_path / "bad.csv"), instagram_csv=str(tmp_path / "bad_posts.csv"),
        dimension_files={"dim_date": str(tmp_path / "days")},
    )
    found = {}

    def run():
        for name in ("dimensions", "bronze_inventory", "bronze_instagram", "silver_inventory", "silver_instagram"):
            found[name] = run_job(name, store, bad, NOW)

    thread = Thread(target=run, daemon=True)
    thread.start()
    thread.join(120)
    assert found["silver_inventory"]["rows"] == 0 and found["silver_inventory"]["dropped_quantity"] == 1
    assert found["silver_inventory"]["nulls_record_id"] == 0
    assert found["silver_instagram"]["rows"] == 0 and found["silver_instagram"]["dropped_negative_count"] == 1

"""The registered queries."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermill.operators import quality
from tiermill.operators.cleaning import null_violations
from tiermill.operators.buckets import BUCKET
from tiermill.operators.daily_numbers import renumber
from tiermill.operators.history import (
    create_event_history,
    create_history,
    scd2_from_changes,
    scd2_from_events,
    update_event_history,
    update_history,
)
from tiermill.plans import gold, silver, stars
from tiermill.plans.bronze import bronze_instagram, bronze_inventory
from tiermill.plans.dimensions import load_dimension
from tiermill.plans.refresh import Sources, refresh, run_job
from tiermill.session import new_path
from tiermill.sources.envelope import read_envelope_files
from tiermill.sources.tables import TableStore
from tiermill.streaming import ratings as stream
from tiermill.streaming.ledger import ledger
from tiermill.streaming.progress import BatchMetrics, read_metrics, totals
from workload import views as v

Query = Callable[[SparkSession, str], DataFrame]

RATING_IDS = ("customer_id", "branch_id", "employee_id", "treatment_id")


def presented(df: DataFrame, as_text: tuple[str, ...] = (), **rounded: int) -> DataFrame:
    """Dates and times as ISO text, fractions as doubles (rounded where their sum has no fixed order)
    and the integer columns that hold nulls as text, so that rows compare equal whichever client
    fetches them."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, (T.FloatType, T.DecimalType)):
            column = column.cast("double")
        if field.name in as_text:
            column = column.cast("string")
        if field.name in rounded:
            column = F.round(column, rounded[field.name])
        columns.append(column.alias(field.name))
    return df.select(columns)


# Silver


def _silver_ratings(spark, sf_dir):
    return silver.silver_ratings(v.ratings_raw(spark, sf_dir), v.as_of(), v.LOOKBACK)


def _silver_inventory(spark, sf_dir):
    return silver.silver_inventory(v.inventory(spark, sf_dir), v.as_of())


def _silver_instagram(spark, sf_dir):
    return silver.silver_instagram(v.instagram(spark, sf_dir), v.post_calendar(spark))


def silver_ratings(spark, sf_dir):
    return presented(_silver_ratings(spark, sf_dir))


def silver_inventory(spark, sf_dir):
    return presented(_silver_inventory(spark, sf_dir))


def silver_instagram(spark, sf_dir):
    return presented(_silver_instagram(spark, sf_dir))


def late_posts(spark, sf_dir):
    """Every post arrives again as a late copy with more likes."""
    posts = v.instagram(spark, sf_dir)
    later = posts.withColumns(
        {
            "likes": F.col("likes") + 1000,
            "ingestion_date": F.date_add("ingestion_date", 1),
        }
    )
    return presented(silver.merge_late_posts(posts, later, _late_at())[0])


def _late_at():
    return F.lit("1998-01-03 00:00:00").cast("timestamp_ntz")


def _late_store(spark, sf_dir) -> TableStore:
    """All posts stored, then merged by the job with a late copy of each."""
    store = TableStore(spark, new_path(spark, "store"), database=_new_database("late"))
    posts = v.instagram(spark, sf_dir)
    store.write(posts, "bronze_instagram", "create")
    later = posts.withColumns(
        {"likes": F.col("likes") + 1000, "ingestion_date": F.date_add("ingestion_date", 1)}
    )
    sources = Sources(late_instagram_csv=_as_csv(later, "late-csv"))
    run_job("late_instagram", store, sources, _late_at())
    return store


def late_posts_stored(spark, sf_dir):
    return presented(_late_store(spark, sf_dir).read("bronze_instagram"))


def late_posts_rejected(spark, sf_dir):
    return presented(_late_store(spark, sf_dir).read("rejected_late_posts"))


# Gold


def gold_branch_kpis(spark, sf_dir):
    # Without ids: counting needs the cleaned ratings only.
    ratings = silver.clean_ratings(v.ratings_raw(spark, sf_dir), v.as_of(), v.LOOKBACK)
    result = gold.gold_branch_kpis(
        ratings.withColumn("rating_id", F.col("_kafka_offset")),
        v.employees(spark, sf_dir),
        v.branches(spark, sf_dir),
    )
    return presented(result, avg_rating=6)


def gold_color_engagement(spark, sf_dir):
    result = gold.gold_color_engagement(
        _silver_inventory(spark, sf_dir), _silver_instagram(spark, sf_dir)
    )
    return presented(result, engagement_score=6)


def gold_customer_metrics(spark, sf_dir):
    return presented(gold.gold_customer_metrics(v.order_ratings(spark, sf_dir)), avg_rating=6)


def _daily_ratings(spark, sf_dir):
    """Cleaned ratings with a day and an id."""
    cleaned = silver.clean_ratings(v.ratings_raw(spark, sf_dir), v.as_of(), v.LOOKBACK)
    return cleaned.withColumns(
        {"rating_date": F.to_date("timestamp"), "rating_id": F.col("_kafka_offset")}
    )


WRONG_DAY = date(2024, 1, 10)


def _kept_up(state, rows, late):
    """States over all rows but the late ones; then the late rows arrive, and a day is deleted."""
    state.refresh(rows.filter(~late))
    kept = rows.filter(F.col(state.day) != F.lit(WRONG_DAY))
    days = [r[0] for r in kept.filter(late).select(state.day).distinct().collect()]
    state.refresh(kept, [*days, WRONG_DAY])
    return state.result()


def _late(day: str, id_column: str):
    return (F.col(day) >= F.lit(date(2024, 1, 20))) & (F.col(id_column) % 5 == 0)


def _state_store(spark):
    return TableStore(spark, new_path(spark, "store"), database=_new_database("state"))


def gold_customer_state(spark, sf_dir):
    state = gold.customer_state(_state_store(spark))
    per_customer = _kept_up(state, _daily_ratings(spark, sf_dir), _late("rating_date", "rating_id"))
    return presented(gold.customer_metrics(per_customer), avg_rating=6)


def gold_branch_state(spark, sf_dir):
    state = gold.branch_state(_state_store(spark))
    per_branch = _kept_up(state, _daily_ratings(spark, sf_dir), _late("rating_date", "rating_id"))
    result = gold.branch_kpis(per_branch, v.employees(spark, sf_dir), v.branches(spark, sf_dir))
    return presented(result, avg_rating=6)


def gold_color_state(spark, sf_dir):
    store = _state_store(spark)
    used = silver.silver_inventory(v.event_inventory(spark, sf_dir), v.as_of())
    usage = _kept_up(gold.usage_state(store), used, _late("report_date", "record_id"))
    posts = v.event_posts(spark, sf_dir)
    social = _kept_up(gold.social_state(store), posts, _late("post_date", "post_id"))
    return presented(gold.color_engagement(usage, social), engagement_score=6)


def numbers_updated(spark, sf_dir):
    """Ratings numbered without the late ones and with a day that is deleted later; then the days that
    changed are numbered anew."""
    store, ratings = _state_store(spark), _daily_ratings(spark, sf_dir).drop("rating_id")
    late = _late("rating_date", "_kafka_offset")
    order = ["timestamp", "customer_id", *silver.TOPIC_POSITION]

    def number(rows, days):
        renumber(store, "ratings", rows, days, "rating_date", order, "rating_id")

    days = [r[0] for r in ratings.select("rating_date").distinct().collect()]
    number(ratings.filter(~late), days)
    kept = ratings.filter(F.col("rating_date") != F.lit(WRONG_DAY))
    changed = [r[0] for r in kept.filter(late).select("rating_date").distinct().collect()]
    number(kept, [*changed, WRONG_DAY])
    stored = store.read("ratings")
    return presented(stored.select("rating_id", "customer_id", "timestamp", "_kafka_offset", "rating_date"))


# Dimensions and histories


def dim_date(spark, sf_dir):
    return presented(v.order_calendar(spark, sf_dir))


def scd2_events(spark, sf_dir):
    return presented(scd2_from_events(v.order_ratings(spark, sf_dir), v.as_of()))


def scd2_events_sliced(spark, sf_dir):
    """The same with every customer treated as too large for one task."""
    ratings = v.order_ratings(spark, sf_dir)
    return presented(scd2_from_events(ratings, v.as_of(), hot_group_rows=0))


def _changes(spark, sf_dir, **options):
    result = scd2_from_changes(
        v.city_versions(spark, sf_dir),
        v.priority_updates(spark, sf_dir),
        "customer_id",
        ["city"],
        v.as_of(),
        newest_by=["sequence"],
        **options,
    )
    return presented(result)


def scd2_changes(spark, sf_dir):
    return _changes(spark, sf_dir)


def scd2_changes_sliced(spark, sf_dir):
    return _changes(spark, sf_dir, hot_group_rows=0)


def scd2_closed(spark, sf_dir):
    """Updates on versions with stored ends, gaps, stamps and a column that updates lack."""
    result = scd2_from_changes(
        v.closed_versions(spark, sf_dir),
        v.priority_updates(spark, sf_dir),
        "customer_id",
        ["city"],
        v.as_of(),
        newest_by=["sequence"],
    )
    return presented(result)


def _applied(spark, sf_dir, buckets=16, **options):
    """The updates in five parts by time, each applied to the buckets it touches; the last part twice."""
    store = TableStore(spark, new_path(spark, "store"), database=_new_database("history"))
    key, tracked = "customer_id", ["city"]
    create_history(store, "versions", v.closed_versions(spark, sf_dir), key, tracked, v.as_of(), buckets)
    updates = v.priority_updates(spark, sf_dir)
    for first, last in (("1900", "1994"), ("1995", "1995"), ("1996", "1997"), ("1998", "2100"), ("1998", "2100")):
        part = updates.filter(F.year("effective_date").between(int(first), int(last)))
        update_history(
            store, "versions", part, key, tracked, v.as_of(), newest_by=["sequence"], **options
        )
    return presented(store.read("versions").drop(BUCKET))


def scd2_updated(spark, sf_dir):
    return _applied(spark, sf_dir)


def scd2_updated_hot(spark, sf_dir):
    """The same with every customer treated as too large for one task."""
    return _applied(spark, sf_dir, buckets=4, hot_group_rows=0)


def scd2_events_updated(spark, sf_dir):
    """Half of the ratings stored, then the others added, among them many before stored ones."""
    store = TableStore(spark, new_path(spark, "store"), database=_new_database("history"))
    ratings = v.order_ratings(spark, sf_dir)
    create_event_history(store, "versions", ratings.filter("rating_id % 2 = 0"), v.as_of(), 16)
    for part in ("rating_id % 4 = 1", "rating_id % 2 = 1"):
        update_event_history(store, "versions", ratings.filter(part), v.as_of())
    return presented(store.read("versions").drop(BUCKET, "rating_id"))


# Stars


def _ratings_for_stars(spark, sf_dir):
    return silver.clean_ratings(v.ratings_raw(spark, sf_dir), v.as_of(), v.LOOKBACK)


def _ratings_star(spark, sf_dir, **options):
    return presented(
        stars.ratings_star(
            _ratings_for_stars(spark, sf_dir),
            v.customers(spark, sf_dir),
            v.branches(spark, sf_dir),
            v.treatments(spark, sf_dir),
            v.ratings_calendar(spark),
            **options,
        )
    )


def ratings_star(spark, sf_dir):
    return _ratings_star(spark, sf_dir)


def ratings_star_salted(spark, sf_dir):
    """The same with no dimension small enough to broadcast and many hot keys."""
    return _ratings_star(spark, sf_dir, broadcast_rows=0, hot_key_rows=20)


def ratings_star_all_hot(spark, sf_dir):
    """The same with every key taken to be hot."""
    return _ratings_star(spark, sf_dir, broadcast_rows=0, hot_key_rows=0)


def _bucketed(spark, sf_dir) -> TableStore:
    """Raw ratings and customers in the same buckets by customer."""
    store = TableStore(spark, new_path(spark, "store"), database=_new_database("buckets"))
    store.write_bucketed(v.ratings_raw(spark, sf_dir), "raw_ratings", ["customer_id"], 16)
    store.write_bucketed(v.customers(spark, sf_dir), "versions", ["customer_id"], 16)
    return store


def ratings_star_colocated(spark, sf_dir):
    """Cleaning, keeping the newest and the join to the customers without a shuffle."""
    store = _bucketed(spark, sf_dir)
    ratings = silver.clean_ratings(store.read_bucketed("raw_ratings"), v.as_of(), v.LOOKBACK)
    return presented(
        stars.ratings_star_colocated(
            ratings,
            store.read_bucketed("versions"),
            v.branches(spark, sf_dir),
            v.treatments(spark, sf_dir),
            v.ratings_calendar(spark),
        )
    )


def silver_ratings_colocated(spark, sf_dir):
    """The newest ratings from a bucketed table."""
    rows = silver.clean_ratings(_bucketed(spark, sf_dir).read_bucketed("raw_ratings"), v.as_of(), v.LOOKBACK)
    return presented(rows.select("customer_id", "rating_value", "comment", "timestamp", "_kafka_offset"))


def sessions_star(spark, sf_dir):
    return presented(
        stars.sessions_star(
            _ratings_for_stars(spark, sf_dir),
            v.customers(spark, sf_dir),
            v.branches(spark, sf_dir),
            v.employees(spark, sf_dir),
            v.treatments(spark, sf_dir),
            v.ratings_calendar(spark),
        )
    )


def social_star(spark, sf_dir):
    return presented(
        stars.social_star(
            _silver_instagram(spark, sf_dir).drop("season"),
            v.colors(spark, sf_dir),
            v.post_calendar(spark),
        )
    )


def inventory_star(spark, sf_dir):
    return presented(
        stars.inventory_star(
            v.inventory(spark, sf_dir),
            v.colors(spark, sf_dir),
            v.branches(spark, sf_dir),
            v.post_calendar(spark),
        )
    )


# Quality


def dq_null_counts(spark, sf_dir):
    return quality.null_counts(v.ratings_raw(spark, sf_dir))


def dq_min_quantity(spark, sf_dir):
    return quality.column_minimum(silver.clean_inventory(v.inventory(spark, sf_dir)), "quantity_used")


def dq_null_rows(spark, sf_dir):
    required = [*silver.RATING_FIELDS, "comment"]
    rows = null_violations(v.ratings_raw(spark, sf_dir), required)
    return presented(rows, as_text=("customer_id",))


def dq_check_silver(spark, sf_dir):
    """Posts joined to a calendar that misses some days break the not-null rule there."""
    posts = silver.with_calendar(v.instagram(spark, sf_dir), v.post_calendar(spark))
    return presented(quality.check_silver("silver_instagram", posts), as_text=("date_id",))


def dq_funnel_ratings(spark, sf_dir):
    return silver.ratings_funnel(v.ratings_raw(spark, sf_dir), v.as_of(), v.LOOKBACK)


def dq_funnel_inventory(spark, sf_dir):
    return silver.inventory_funnel(v.inventory(spark, sf_dir))


def dq_funnel_instagram(spark, sf_dir):
    return silver.instagram_funnel(v.instagram(spark, sf_dir), v.post_calendar(spark))


def dq_counted_ratings(spark, sf_dir):
    """The funnel from the scan that makes the silver rows."""
    return silver.counted_ratings(v.ratings_raw(spark, sf_dir), v.as_of(), v.LOOKBACK)[1]


def dq_counted_inventory(spark, sf_dir):
    return silver.counted_inventory(v.inventory(spark, sf_dir), v.as_of())[1]


def dq_counted_instagram(spark, sf_dir):
    return silver.counted_instagram(v.instagram(spark, sf_dir), v.post_calendar(spark))[1]


def silver_ratings_counted(spark, sf_dir):
    """The rows that go with the funnel."""
    return presented(silver.counted_ratings(v.ratings_raw(spark, sf_dir), v.as_of(), v.LOOKBACK)[0])


def dq_footer_counts(spark, sf_dir):
    """Rows of stored tables, counted from the footers of their files."""
    store = TableStore(spark, new_path(spark, "store"), database=_new_database("footers"))
    tables = {
        "raw_posts": v.instagram(spark, sf_dir),
        "silver_inventory": silver.silver_inventory(v.event_inventory(spark, sf_dir), v.as_of()),
        "raw_ratings": v.ratings_raw(spark, sf_dir),
    }
    counts = []
    for name, rows in tables.items():
        store.write(rows, name, "create")
        columns = ["customer_id", "comment"] if name == "raw_ratings" else []
        row = store.footer_counts(name, columns).first()
        nulls = [row[f"nulls_{c}"] for c in columns] or [0, 0]
        counts.append((name, row["row_count"], *nulls))
    schema = "table_name string, row_count long, null_customers long, null_comments long"
    return spark.createDataFrame(counts, schema)


def table_since(spark, sf_dir):
    """Bronze ratings of some days, of which only the folders are read."""
    store = TableStore(spark, new_path(spark, "store"), database=_new_database("since"))
    rows = v.ratings_raw(spark, sf_dir)
    rows = rows.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    store.write(rows.withColumn("event_date", F.to_date("timestamp")), "bronze_ratings", "create")
    got = store.read("bronze_ratings", datetime(2024, 1, 5, 12), datetime(2024, 1, 9, 6))
    return presented(got.select("_kafka_offset", "timestamp", "branch_id"))


def dq_layer_counts(spark, sf_dir):
    ratings = v.ratings_raw(spark, sf_dir)
    return quality.layer_counts(
        {
            "bronze_inventory": v.inventory(spark, sf_dir),
            "bronze_instagram": v.instagram(spark, sf_dir),
            "bronze_ratings": ratings,
            "silver_inventory": _silver_inventory(spark, sf_dir),
            "silver_instagram": _silver_instagram(spark, sf_dir),
            "silver_ratings": silver.clean_ratings(ratings, v.as_of(), v.LOOKBACK),
        }
    )


def dq_reasons(spark, sf_dir):
    return quality.reason_counts(v.ratings_raw(spark, sf_dir), v.as_of(), v.LOOKBACK)


def dq_classified(spark, sf_dir):
    rows = quality.classify_ratings(v.ratings_raw(spark, sf_dir), v.as_of(), v.LOOKBACK)
    return rows.select("_kafka_offset", F.array_join("reasons", ",").alias("reasons"))


def latest_rows(spark, sf_dir):
    return presented(stream.latest_rows(v.ratings_raw(spark, sf_dir)))


def table_count_sql(spark, sf_dir):
    v.ratings_raw(spark, sf_dir).createOrReplaceTempView("bronze_ratings_view")
    return spark.sql("SELECT count(*) AS total_rows FROM bronze_ratings_view")


# Sources, sinks and the stream


def _as_csv(df: DataFrame, label: str) -> str:
    path = new_path(df.sparkSession, label)
    df.write.option("header", True).csv(path)
    return path


def csv_instagram(spark, sf_dir):
    path = _as_csv(v.instagram(spark, sf_dir), "instagram-csv")
    return presented(bronze_instagram(spark, path))


def csv_inventory(spark, sf_dir):
    path = _as_csv(v.inventory(spark, sf_dir), "inventory-csv")
    return presented(bronze_inventory(spark, path))


def _dimension_csv(spark, sf_dir, table):
    """The rows of a dimension's source file, made from the given tables."""
    base = {
        "dim_colors": "part",
        "dim_branches": "supplier",
        "dim_employees": "customer",
        "dim_treatments": "part",
    }
    columns = {
        "dim_colors": [
            "p_partkey AS color_id",
            "p_name AS name",
            "p_brand AS hex_code",
            "p_type AS category",
            "p_size > 25 AS active",
        ],
        "dim_branches": [
            "s_suppkey AS branch_id",
            "s_name AS name",
            "cast(s_nationkey AS string) AS city",
            "concat(s_name, ', ', s_nationkey) AS address",
            "s_acctbal > 0 AS active",
            "date'2020-01-31' AS opening_date",
        ],
        "dim_employees": [
            "c_custkey AS employee_id",
            "c_name AS first_name",
            "c_mktsegment AS last_name",
            "c_mktsegment AS role",
            "c_nationkey AS experience_years",
            "c_acctbal > 0 AS active",
            "date'2020-07-30' AS hire_date",
            "c_nationkey % 5 AS branch_id",
        ],
        "dim_treatments": [
            "p_partkey AS treatment_id",
            "p_name AS name",
            "p_retailprice AS price",
            "p_size AS duration_minutes",
            "p_size > 25 AS active",
        ],
    }
    if table == "dim_customers":
        rows = v.customers(spark, sf_dir).selectExpr(
            "customer_id",
            "version_id",
            "first_name",
            "last_name",
            "concat('customer', customer_id, '@example.com') AS email",
            "cast(NULL AS string) AS phone",
            "last_name AS address",
            "last_name AS city",
            "start_date",
            "end_date",
            "is_current",
        )
    elif table == "dim_date":
        rows = v.order_calendar(spark, sf_dir)
    else:
        rows = v.table(spark, sf_dir, base[table]).selectExpr(*columns[table])
    return _as_csv(rows, table)


def _load(table: str) -> Query:
    def load(spark, sf_dir):
        path = _dimension_csv(spark, sf_dir, table)
        return presented(load_dimension(spark, table, path, v.as_of()))

    return load


def csv_inferred(spark, sf_dir):
    """The same file with its types inferred, cast to the declared ones."""
    path = _dimension_csv(spark, sf_dir, "dim_treatments")
    return presented(load_dimension(spark, "dim_treatments", path, v.as_of(), infer_schema=True))


def json_parse(spark, sf_dir):
    parsed = stream.parse_ratings(v.envelopes(spark, sf_dir), v.as_of().cast("timestamp"))
    return presented(parsed, as_text=RATING_IDS)


def _stream(spark, messages, folder, run, rejected=False):
    messages.write.parquet(f"{folder}/topic-{run}")
    query = stream.start_bronze(
        read_envelope_files(spark, f"{folder}/topic-{run}"),
        f"{folder}/bronze",
        f"{folder}/checkpoint-{run}",
        rejected_path=f"{folder}/rejected" if rejected else None,
        until_caught_up=True,
    )
    query.awaitTermination()


def _streamed(spark, sf_dir, rejected=False):
    folder = new_path(spark, "stream")
    _stream(spark, v.envelopes(spark, sf_dir), folder, 0, rejected)
    return folder


def _stored_ratings(rows):
    hidden = (stream.RUN, stream.BATCH, "processed_timestamp")
    return presented(rows.drop(*hidden), as_text=RATING_IDS)


def stream_bronze(spark, sf_dir):
    folder = _streamed(spark, sf_dir)
    return _stored_ratings(stream.read_batches(spark, f"{folder}/bronze"))


def stream_new_checkpoint(spark, sf_dir):
    """Half of the messages with one checkpoint, the others with a new one on the same folder."""
    folder, messages = new_path(spark, "stream"), v.envelopes(spark, sf_dir)
    for run in (0, 1):
        _stream(spark, messages.filter(F.col("offset") % 2 == run), folder, run)
    return _stored_ratings(stream.read_batches(spark, f"{folder}/bronze"))


def stream_table(spark, sf_dir):
    """The stream's days written to the bronze table, twice."""
    store = TableStore(spark, new_path(spark, "store"), database=_new_database("stream"))
    sources = Sources(ratings_path=f"{_streamed(spark, sf_dir)}/bronze")
    for _ in range(2):
        run_job("bronze_ratings", store, sources, v.as_of())
    return _stored_ratings(store.read("bronze_ratings"))


def stream_merged(spark, sf_dir):
    """Half of the messages streamed and merged to the table, then the others by a new checkpoint."""
    store = TableStore(spark, new_path(spark, "store"), database=_new_database("merged"))
    folder, messages = new_path(spark, "stream"), v.envelopes(spark, sf_dir)
    for run in (0, 1):
        _stream(spark, messages.filter(F.col("offset") % 2 == run), folder, run)
        run_job("bronze_ratings", store, Sources(ratings_path=f"{folder}/bronze"), v.as_of())
    return _stored_ratings(store.read("bronze_ratings"))


def stream_stamped(spark, sf_dir):
    """How many stored rows bear a time of processing within the run of the stream."""
    began = datetime.now() - timedelta(minutes=1)
    rows = stream.read_batches(spark, f"{_streamed(spark, sf_dir)}/bronze")
    stamped = F.col("processed_timestamp").between(F.lit(began), F.lit(datetime.now() + timedelta(minutes=1)))
    return rows.agg(F.count("*").alias("total_rows"), F.count_if(stamped).alias("stamped_rows"))


def stream_ledger(spark, sf_dir):
    """Days in the ledger after the stream was merged twice."""
    store = TableStore(spark, new_path(spark, "store"), database=_new_database("ledger"))
    sources = Sources(ratings_path=f"{_streamed(spark, sf_dir)}/bronze")
    for _ in range(2):
        run_job("bronze_ratings", store, sources, v.as_of())
    return presented(ledger(store).select("event_date", "merge_id").dropna())


def _late_stream(spark, sf_dir):
    """Two thirds of the messages; then the others, and some of the first again: what is older than two
    days before the newest of the first is late. Returns the folder of the stream."""
    folder, messages = new_path(spark, "stream"), v.envelopes(spark, sf_dir)
    metrics = BatchMetrics(spark, f"{folder}/metrics")
    spark.streams.addListener(metrics)
    again = "offset % 3 = 0 OR offset % 15 = 1 AND offset % 13 <> 0"
    try:
        for run, part in enumerate(("offset % 3 <> 0", again)):
            messages.filter(part).write.mode("append").parquet(f"{folder}/topic")
            query = stream.start_bronze(
                read_envelope_files(spark, f"{folder}/topic"),
                f"{folder}/bronze",
                f"{folder}/checkpoint",
                until_caught_up=True,
                late_after="48 hours",
            )
            query.awaitTermination()
            metrics.wait(query)
    finally:
        spark.streams.removeListener(metrics)
    return folder


def stream_late_counts(spark, sf_dir):
    return totals(read_metrics(spark, f"{_late_stream(spark, sf_dir)}/metrics"))


def stream_late_kept(spark, sf_dir):
    """The rows that the stream with late messages stored."""
    folder = _late_stream(spark, sf_dir)
    return _stored_ratings(stream.read_batches(spark, f"{folder}/bronze"))


def stream_rejected_all(spark, sf_dir):
    """No message is a rating: all are set aside, and bronze is there and empty."""
    folder = new_path(spark, "stream")
    messages = v.envelopes(spark, sf_dir).filter("string(value) = 'no json'")
    _stream(spark, messages, folder, 0, rejected=True)
    stored = stream.read_batches(spark, f"{folder}/bronze").count()
    rows = stream.read_batches(spark, f"{folder}/rejected", stream.REJECTED)
    columns = ("raw", "_kafka_topic", "_kafka_partition", "_kafka_offset")
    return rows.select(*columns, F.lit(stored).cast("bigint").alias("bronze_rows"))


def stream_batch_counts(spark, sf_dir):
    folder = _streamed(spark, sf_dir)
    return stream.batch_counts(stream.read_batches(spark, f"{folder}/bronze")).agg(
        F.sum("row_count").alias("total_rows")
    )


def stream_rejected(spark, sf_dir):
    folder = _streamed(spark, sf_dir, rejected=True)
    rows = stream.read_batches(spark, f"{folder}/rejected", stream.REJECTED)
    return rows.select("raw", "_kafka_topic", "_kafka_partition", "_kafka_offset")


def _new_database(label: str) -> str:
    return f"tiermill_{label}_{uuid.uuid4().hex}"


def partition_overwrite(spark, sf_dir):
    """All days are stored, then the days from the 20th on are stored again with a higher rating."""
    days = F.to_date("timestamp").alias("event_date")
    rows = v.ratings_raw(spark, sf_dir).select("*", days)
    folder = new_path(spark, "store")
    store = TableStore(spark, folder, database=_new_database("overwrite"))
    store.write(rows, "bronze_ratings", "create")
    corrected = rows.filter(F.col("event_date") >= F.lit("2024-01-20").cast("date")).withColumn(
        "rating_value", F.col("rating_value") + 1
    )
    store.write(corrected, "bronze_ratings", "overwrite_partitions")
    stored = store.read("bronze_ratings").drop("processed_timestamp")
    return presented(stored, as_text=("customer_id",))


def replace_new_columns(spark, sf_dir):
    """A table of keys is replaced by one with other columns."""
    store = TableStore(spark, new_path(spark, "store"), database=_new_database("replace"))
    orders = v.table(spark, sf_dir, "orders")
    store.write(orders.select(F.col("o_orderkey").alias("id")), "plain", "create")
    named = orders.select(F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("owner"))
    store.write(named, "plain", "replace")
    return store.read("plain")


def table_append(spark, sf_dir):
    store = TableStore(spark, new_path(spark, "store"), database=_new_database("append"))
    customers = v.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    for _ in range(2):
        store.write(customers, "plain", "append")
    return store.read("plain")


def store_tables(spark, sf_dir):
    """The tables of a store with their rows: one declared and empty, one partitioned and replaced; a
    dropped one is not listed."""
    store = TableStore(spark, new_path(spark, "store"), database=_new_database("tables"))
    store.create("silver_ratings")
    used = silver.silver_inventory(v.event_inventory(spark, sf_dir), v.as_of())
    for mode in ("create", "replace"):
        store.write(used, "silver_inventory", mode)
    store.write(v.table(spark, sf_dir, "region"), "dropped", "create")
    store.drop("dropped")
    return quality.layer_counts({name: store.read(name) for name in store.tables()})


def _refreshed(spark, sf_dir) -> tuple[TableStore, DataFrame]:
    """All tables from CSV files and a message stream made from the given tables, and their counts."""
    store = TableStore(spark, new_path(spark, "store"), database=_new_database("refresh"))
    tables = ["dim_branches", "dim_employees", "dim_colors", "dim_customers", "dim_treatments"]
    sources = Sources(
        inventory_csv=_as_csv(v.event_inventory(spark, sf_dir), "inventory-csv"),
        instagram_csv=_as_csv(v.instagram(spark, sf_dir), "instagram-csv"),
        dimension_files={t: _dimension_csv(spark, sf_dir, t) for t in [*tables, "dim_date"]},
        ratings_path=f"{_streamed(spark, sf_dir)}/bronze",
    )
    return store, refresh(store, sources, v.as_of().cast("timestamp"))


def full_refresh(spark, sf_dir):
    return _refreshed(spark, sf_dir)[1]


def refresh_resumed(spark, sf_dir):
    """A refresh that fails without its posts, then goes on with the jobs that are missing: which jobs
    were run, and how often they were noted."""
    store = TableStore(spark, new_path(spark, "store"), database=_new_database("resumed"))
    tables = ["dim_branches", "dim_employees", "dim_colors", "dim_customers", "dim_treatments"]
    sources = Sources(
        inventory_csv=_as_csv(v.event_inventory(spark, sf_dir), "inventory-csv"),
        instagram_csv=new_path(spark, "missing-csv"),
        dimension_files={t: _dimension_csv(spark, sf_dir, t) for t in [*tables, "dim_date"]},
        ratings_path=f"{_streamed(spark, sf_dir)}/bronze",
    )
    as_of = v.as_of().cast("timestamp")
    try:
        refresh(store, sources, as_of, run="first")
    except AnalysisException:
        posts = _as_csv(v.event_posts(spark, sf_dir).withColumn("ingestion_date", F.col("post_date")), "csv")
        refresh(store, replace(sources, instagram_csv=posts), as_of, run="first")
    counts = [f"(SELECT count(*) FROM {store.name(t)}) AS {t}" for t in ("bronze_ratings", "bronze_instagram")]
    jobs = store.read("refresh_jobs").groupBy("run", "job").agg(F.count("*").alias("times"))
    return jobs.selectExpr("job", "times", *counts)


def refresh_silver_inventory(spark, sf_dir):
    """The rows of a table after the full refresh."""
    return presented(_refreshed(spark, sf_dir)[0].read("silver_inventory"))


QUERIES: dict[str, Query] = {
    "silver_ratings": silver_ratings,
    "silver_inventory": silver_inventory,
    "silver_instagram": silver_instagram,
    "gold_branch_kpis": gold_branch_kpis,
    "gold_color_engagement": gold_color_engagement,
    "gold_customer_metrics": gold_customer_metrics,
    "dim_date": dim_date,
    "scd2_from_events": scd2_events,
    "scd2_from_events_sliced": scd2_events_sliced,
    "scd2_from_changes": scd2_changes,
    "scd2_from_changes_sliced": scd2_changes_sliced,
    "ratings_star": ratings_star,
    "ratings_star_salted": ratings_star_salted,
    "ratings_star_colocated": ratings_star_colocated,
    "silver_ratings_colocated": silver_ratings_colocated,
    "sessions_star": sessions_star,
    "social_star": social_star,
    "inventory_star": inventory_star,
    "dq_null_counts": dq_null_counts,
    "dq_min_quantity": dq_min_quantity,
    "dq_null_rows": dq_null_rows,
    "dq_check_silver": dq_check_silver,
    "dq_funnel_ratings": dq_funnel_ratings,
    "dq_funnel_inventory": dq_funnel_inventory,
    "dq_funnel_instagram": dq_funnel_instagram,
    "dq_layer_counts": dq_layer_counts,
    "dq_counted_ratings": dq_counted_ratings,
    "dq_counted_inventory": dq_counted_inventory,
    "dq_counted_instagram": dq_counted_instagram,
    "silver_ratings_counted": silver_ratings_counted,
    "dq_footer_counts": dq_footer_counts,
    "table_since": table_since,
    "dq_reasons": dq_reasons,
    "dq_classified": dq_classified,
    "latest_rows": latest_rows,
    "table_count_sql": table_count_sql,
    "late_posts": late_posts,
    "csv_instagram": csv_instagram,
    "csv_inventory": csv_inventory,
    "csv_inferred": csv_inferred,
    "load_dim_colors": _load("dim_colors"),
    "load_dim_branches": _load("dim_branches"),
    "load_dim_employees": _load("dim_employees"),
    "load_dim_customers": _load("dim_customers"),
    "load_dim_treatments": _load("dim_treatments"),
    "load_dim_date": _load("dim_date"),
    "json_parse": json_parse,
    "stream_bronze": stream_bronze,
    "stream_batch_counts": stream_batch_counts,
    "stream_rejected": stream_rejected,
    "stream_new_checkpoint": stream_new_checkpoint,
    "stream_table": stream_table,
    "stream_late_counts": stream_late_counts,
    "stream_late_kept": stream_late_kept,
    "stream_merged": stream_merged,
    "stream_ledger": stream_ledger,
    "stream_stamped": stream_stamped,
    "stream_rejected_all": stream_rejected_all,
    "partition_overwrite": partition_overwrite,
    "replace_new_columns": replace_new_columns,
    "table_append": table_append,
    "store_tables": store_tables,
    "late_posts_stored": late_posts_stored,
    "late_posts_rejected": late_posts_rejected,
    "scd2_closed": scd2_closed,
    "gold_customer_state": gold_customer_state,
    "gold_branch_state": gold_branch_state,
    "gold_color_state": gold_color_state,
    "numbers_updated": numbers_updated,
    "scd2_updated": scd2_updated,
    "scd2_updated_hot": scd2_updated_hot,
    "scd2_events_updated": scd2_events_updated,
    "ratings_star_all_hot": ratings_star_all_hot,
    "refresh_silver_inventory": refresh_silver_inventory,
    "full_refresh": full_refresh,
    "refresh_resumed": refresh_resumed,
}

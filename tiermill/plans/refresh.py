"""The jobs by name, and the full refresh: all of them, each when those that it needs are done."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.operators.history import scd2_from_events
from tiermill.operators.quality import layer_counts
from tiermill.plans import gold, silver
from tiermill.plans.bronze import bronze_instagram, bronze_inventory
from tiermill.plans.dimensions import load_dimension
from tiermill.schemas import SILVER_REQUIRED, TABLES
from tiermill.session import intermediates, written
from tiermill.sources.tables import TableStore
from tiermill.streaming.ledger import merge_batches


@dataclass(frozen=True)
class Sources:
    """Where the data comes from. ``ratings_path`` is the folder of the ratings stream, whose days are
    written to the table ``bronze_ratings``; ``late_instagram_csv`` holds posts that arrive late."""

    inventory_csv: str = ""
    instagram_csv: str = ""
    late_instagram_csv: str = ""
    dimension_files: dict[str, str] = field(default_factory=dict)
    ratings_path: str = ""


Metrics = dict[str, int]
Job = Callable[[TableStore, Sources, "datetime | Column"], Metrics | None]


def bronze_ratings(store: TableStore) -> DataFrame:
    store.create("bronze_ratings")
    return store.read("bronze_ratings")


def _write_silver(store: TableStore, rows: DataFrame, table: str, dropped: DataFrame) -> Metrics:
    """Replace a silver table and return its row and null counts, from the footers of its files, and what
    each rule of the cleaner dropped, counted with the rows."""
    store.write(rows, table, "replace")
    counts = store.footer_counts(table, SILVER_REQUIRED[table]).first().asDict()
    named = {"rows": counts.pop("row_count")} | counts
    return named | {f"dropped_{r['rule']}": r["dropped"] for r in dropped.collect()}


def _dimensions(store, sources, as_of):
    # Replaced as a whole, so that a rerun does not double the rows.
    for table, path in sources.dimension_files.items():
        store.write(load_dimension(store.spark, table, path, as_of), table, "replace")


def _bronze_inventory(store, sources, as_of):
    rows = bronze_inventory(store.spark, sources.inventory_csv)
    store.write(rows, "bronze_inventory", "replace")


def _bronze_instagram(store, sources, as_of):
    rows = bronze_instagram(store.spark, sources.instagram_csv)
    store.write(rows, "bronze_instagram", "replace")


def _late_instagram(store, sources, as_of):
    """Merge late posts into the days they belong to; those too late are kept in a table."""
    if not sources.late_instagram_csv:
        return None
    arrived = written(bronze_instagram(store.spark, sources.late_instagram_csv), "arrived-posts")
    rows, too_late = silver.merge_late_posts(store.read("bronze_instagram"), arrived, as_of)
    store.write(written(rows, "late-posts"), "bronze_instagram", "overwrite_partitions")
    store.create("rejected_late_posts")
    too_late = written(too_late, "too-late")
    # Of equal rows, those beyond what is kept already: a file that comes again adds nothing, and
    # repeated rows within it stay.
    known = store.read("rejected_late_posts").select(too_late.columns)
    days = too_late.select(F.col("post_date").alias("_day")).distinct()
    known = known.join(days, F.col("post_date").eqNullSafe(F.col("_day")), "left_semi")
    store.write(too_late.exceptAll(known), "rejected_late_posts", "append")
    return {"arrived": arrived.count(), "too_late": too_late.count()}


def _bronze_ratings(store, sources, as_of):
    """The days that batches stored since the last run reach, each written as a whole, which also
    gathers the small files of many batches in a few."""
    store.create("bronze_ratings")
    if sources.ratings_path:
        return merge_batches(store, sources.ratings_path)
    return None


def _silver_inventory(store, sources, as_of):
    rows, dropped = silver.counted_inventory(store.read("bronze_inventory"), as_of)
    return _write_silver(store, rows, "silver_inventory", dropped)


def _silver_instagram(store, sources, as_of):
    bronze, days = store.read("bronze_instagram"), store.read("dim_date")
    rows, dropped = silver.counted_instagram(bronze, days)
    return _write_silver(store, rows, "silver_instagram", dropped)


def _silver_ratings(store, sources, as_of):
    rows, dropped = silver.counted_ratings(bronze_ratings(store), as_of)
    return _write_silver(store, rows, "silver_ratings", dropped)


def _customer_rating_versions(store, sources, as_of):
    rows = scd2_from_events(store.read("silver_ratings"), as_of)
    store.write(rows, "customer_rating_versions", "replace")


def _gold_branch_kpis(store, sources, as_of):
    rows = gold.gold_branch_kpis(
        store.read("silver_ratings"), store.read("dim_employees"), store.read("dim_branches")
    )
    store.write(rows, "gold_branch_kpis", "replace")


def _gold_color_engagement(store, sources, as_of):
    rows = gold.gold_color_engagement(
        store.read("silver_inventory"), store.read("silver_instagram")
    )
    store.write(rows, "gold_color_engagement", "replace")


def _gold_customer_metrics(store, sources, as_of):
    rows = gold.gold_customer_metrics(store.read("silver_ratings"))
    store.write(rows, "gold_customer_metrics", "replace")


JOBS: dict[str, Job] = {
    "dimensions": _dimensions,
    "bronze_inventory": _bronze_inventory,
    "bronze_instagram": _bronze_instagram,
    "late_instagram": _late_instagram,
    "bronze_ratings": _bronze_ratings,
    "silver_inventory": _silver_inventory,
    "silver_instagram": _silver_instagram,
    "silver_ratings": _silver_ratings,
    "customer_rating_versions": _customer_rating_versions,
    "gold_branch_kpis": _gold_branch_kpis,
    "gold_color_engagement": _gold_color_engagement,
    "gold_customer_metrics": _gold_customer_metrics,
}


def run_job(name: str, store: TableStore, sources: Sources, as_of: datetime | Column) -> Metrics:
    """Run one job; any failure is raised. Returns row, null and drop counts for a silver table, how
    many late posts came, and too late, and how many batches and days of the stream were merged.

    What the job wrote for its own use is deleted once its table is written.
    """
    with intermediates(store.spark):
        return JOBS[name](store, sources, as_of) or {}


# The jobs whose tables a job reads.
NEEDS: dict[str, tuple[str, ...]] = {
    "late_instagram": ("bronze_instagram",),
    "silver_inventory": ("bronze_inventory",),
    "silver_instagram": ("late_instagram", "dimensions"),
    "silver_ratings": ("bronze_ratings",),
    "customer_rating_versions": ("silver_ratings",),
    "gold_branch_kpis": ("silver_ratings", "dimensions"),
    "gold_color_engagement": ("silver_inventory", "silver_instagram"),
    "gold_customer_metrics": ("silver_ratings",),
}
RUNS = "refresh_jobs"


def refresh(
    store: TableStore,
    sources: Sources,
    as_of: datetime | Column,
    run: str | None = None,
    parallel: int = 4,
) -> DataFrame:
    """Run all jobs and return the row count of each bronze, silver and gold table.

    A job starts when those that it needs are done, up to ``parallel`` at once, each in a scheduler pool
    of its own. If one fails, those that run are waited for, no other is started, and the failure is
    raised. With the name of a ``run``, finished jobs are noted in a table, and the same run started
    again goes on with those that are not; it has to have the same ``as_of``.
    """
    done = _finished(store, run)
    _run_graph(store, sources, as_of, run, done, parallel)
    built = [name for name in JOBS if name not in ("dimensions", "late_instagram")]
    return layer_counts({name: store.read(name) for name in built})


def _finished(store: TableStore, run: str | None) -> set[str]:
    if run is None:
        return set()
    store.create(RUNS)
    return {r["job"] for r in store.read(RUNS).filter(F.col("run") == run).select("job").collect()}


def _run_graph(store, sources, as_of, run: str | None, done: set[str], parallel: int) -> None:
    context = store.spark.sparkContext

    def start(name: str) -> str:
        context.setLocalProperty("spark.scheduler.pool", name)
        run_job(name, store, sources, as_of)
        return name

    waiting = [name for name in JOBS if name not in done]
    with ThreadPoolExecutor(parallel) as pool:
        running: set[Future] = set()
        while waiting or running:
            ready = [name for name in waiting if done.issuperset(NEEDS.get(name, ()))]
            for name in ready[: parallel - len(running)]:
                waiting.remove(name)
                running.add(pool.submit(start, name))
            ended, running = wait(running, return_when=FIRST_COMPLETED)
            # Noted here, one after the other: two appends to one table would disturb each other. Those
            # that went well are noted before the failure of another one is raised.
            failed = [job for job in ended if job.exception()]
            if failed:
                rest, running = wait(running)
                ended |= rest
            for job in ended:
                if not job.exception():
                    done.add(job.result())
                    if run is not None:
                        noted = [(run, job.result(), datetime.now())]
                        store.write(store.spark.createDataFrame(noted, TABLES[RUNS]), RUNS, "append")
            if failed:
                raise failed[0].exception()

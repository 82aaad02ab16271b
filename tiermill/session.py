"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}
# What the innermost block of ``intermediates`` in this thread or context has stored.
_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)


def local_session(app: str = "tiermill", cores: int | str = "*", **conf) -> SparkSession:
    """A session for tests and benchmarks on one machine; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master without that setting gets a folder of its own; on a cluster a
    machine-local folder would lose data, so a missing setting is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.conf.get("spark.app.id")
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="tiermill-")
    return _LOCAL_DIRS[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; never reused, so a rerun cannot read stale files."""
    return os.path.join(shared_dir(spark), "tiermill", f"{label}-{uuid.uuid4().hex}")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back (runs a job).

    Cuts the lineage: values that depend on how rows were laid out over tasks are fixed by the write,
    and a lost executor re-reads files instead of re-deriving them.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    held = _WRITTEN.get()
    if held is not None:
        held.append(path)
    return spark.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, name: str):
    """A path and the file system it is on, as Hadoop objects."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Delete at the end of the block what ``written`` stored in it. The results built on it have to
    be saved by then; outside such a block the files stay until the shared folder is cleaned. Blocks
    in other threads keep their own lists."""
    held: list[str] = []
    token = _WRITTEN.set(held)
    try:
        yield
    finally:
        _WRITTEN.reset(token)
        for stored in held:
            path, files = hadoop_path(spark, stored)
            files.delete(path, True)

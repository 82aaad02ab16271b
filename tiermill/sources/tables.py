"""Named tables: create, read, append, replace, overwrite touched partitions, drop.

The default provider is Parquet in Spark's own catalog. A whole-table replacement is written beside
the old files before the table is pointed at it, so a failed write leaves the old rows in place and a
table can be replaced by a query that reads it. The files of the version before are kept for queries
that still read them, older ones are deleted. With ``provider="iceberg"`` (connector on the
classpath) the table format does this by itself.
"""

from __future__ import annotations

import os
import re
import uuid
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermill.schemas import TABLES, conform
from tiermill.session import hadoop_path

# Partition columns of the tables that have any.
PARTITIONED_BY = {
    "bronze_ratings": ["event_date"],
    "bronze_instagram": ["post_date"],
    "silver_inventory": ["report_date"],
}
# What a day partition is derived from, where it is not the column that readers ask for.
TIME_OF_DAY = {"bronze_ratings": "timestamp"}
# A table that is registered beside the one it will replace.
NEXT = "__next"
# Spark's name of the folder of rows without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# Bytes of a bucket that one task reads without harm, and the share of all bytes beyond which a larger
# one counts as hot. The number of the bucket in the name of a file that Spark has written.
HOT_BYTES = 512 << 20
HOT_SHARE = 0.05
BUCKET_FILE = re.compile(r"_(\d{5,})(?:\.c\d+)?\.[a-z.]*parquet$")
MODES = ("create", "append", "replace", "overwrite_partitions")


def in_days(day: str | Column, values: list) -> Column:
    """True where ``day`` is one of the values, of which one may be null. Spark prunes folders by it."""
    column = F.col(day) if isinstance(day, str) else day
    known = [value for value in values if value is not None]
    kept = column.isin(known) if known else F.lit(False)
    return kept | column.isNull() if None in values else kept


class TableStore:
    """The tables of one database, with their files below ``root``."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        database: str = "default",
        provider: str = "parquet",
    ):
        self.spark, self.root, self.database, self.provider = spark, root, database, provider
        location = f"LOCATION '{root}'" if provider == "parquet" else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} {location}")

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def exists(self, table: str) -> bool:
        """True if the table is there; a replacement that was cut short is completed first."""
        found = self.spark.catalog.tableExists(self.name(table))
        if not found and self.spark.catalog.tableExists(self.name(table + NEXT)):
            self._rename(table + NEXT, table)
            return True
        return found

    def _rename(self, old: str, new: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(old)} RENAME TO {self.name(new)}")

    def tables(self) -> list[str]:
        listed = self.spark.sql(f"SHOW TABLES IN {self.database}")
        names = {row["tableName"] for row in listed.collect() if not row["isTemporary"]}
        return sorted({name.removesuffix(NEXT) for name in names})

    def read(
        self, table: str, since: date | datetime | None = None, until: date | datetime | None = None
    ) -> DataFrame:
        """The rows of a table; with ``since`` or ``until`` (both included) those of that time in a table
        partitioned by days, of which only the folders that can hold them are read.

        A day that was derived from a time is a day of the writer's time zone, so the folders a day
        before and after are read as well.
        """
        self.exists(table)
        rows = self.spark.table(self.name(table))
        if since is None and until is None:
            return rows
        if table not in PARTITIONED_BY:
            raise ValueError(f"{table} is not partitioned by days")
        day = PARTITIONED_BY[table][0]
        time = TIME_OF_DAY.get(table, day)
        slack = timedelta(days=0 if time == day else 1)
        for bound, keep in ((since, "__ge__"), (until, "__le__")):
            if bound is not None:
                of = bound.date() if isinstance(bound, datetime) else bound
                nearest = of - slack if keep == "__ge__" else of + slack
                exact = of if time == day else bound
                rows = rows.filter(getattr(F.col(day), keep)(F.lit(nearest)))
                rows = rows.filter(getattr(F.col(time), keep)(F.lit(exact)))
        return rows

    def footer_counts(self, table: str, columns: list[str] | None = None) -> DataFrame:
        """One row: ``row_count`` and ``nulls_<column>`` of a table. Of a Parquet table they come from the
        footers of its files; no column is read.

        Spark takes counts from footers only with settings of their own, so this runs in a session
        beside the store's; the settings of that one stay as they are.
        """
        total = F.count(F.lit(1))
        nulls = [(total - F.count(c)).alias(f"nulls_{c}") for c in columns or []]
        if self.provider != "parquet":
            return self.read(table).agg(total.alias("row_count"), *nulls)
        self.exists(table)
        beside = self.spark.newSession()
        beside.conf.set("spark.sql.sources.useV1SourceList", "")
        beside.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        stored = self.spark.table(self.name(table)).schema
        files = beside.read.schema(stored).parquet(self._location(table))
        counted = files.agg(total.alias("row_count"), *nulls)
        # Without any file there is no footer, and the sum of no counts is null, although Spark takes a
        # count to be none and would drop a plain default.
        none = {c: F.coalesce(F.nullif(F.col(c), F.lit(-1)), F.lit(0)) for c in counted.columns}
        return counted.withColumns(none)

    def count(self, table: str) -> DataFrame:
        return self.spark.sql(f"SELECT count(*) AS total_rows FROM {self.name(table)}")

    def create(self, table: str, schema: T.StructType | None = None) -> None:
        """Create an empty table with declared columns unless it exists."""
        if not self.exists(table):
            empty = self.spark.createDataFrame([], schema or TABLES[table])
            self._create(empty, table, PARTITIONED_BY.get(table, []))

    def drop(self, table: str) -> None:
        """Drop the table with all its files."""
        for name in (table, table + NEXT):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(name)}")
        if self.provider == "parquet":
            folder, files = hadoop_path(self.spark, os.path.join(self.root, table))
            files.delete(folder, True)

    def drop_old_files(self, table: str, keep: int = 0) -> None:
        """Delete the files of replaced versions of a Parquet table, but for the ``keep`` newest."""
        current, _ = hadoop_path(self.spark, self._location(table))
        folder, files = hadoop_path(self.spark, os.path.join(self.root, table))
        old = [v for v in files.listStatus(folder) if v.getPath().getName() != current.getName()]
        old.sort(key=lambda version: version.getModificationTime(), reverse=True)
        for version in old[keep:]:
            files.delete(version.getPath(), True)

    def drop_partitions(self, table: str, values: list) -> None:
        """Drop the given partitions of a Parquet table that is partitioned by one column, with their
        files; those that are not there do no harm."""
        column = self._partitions(table)[0]
        root, files = hadoop_path(self.spark, self._location(table))
        for value in values:
            written_as = "NULL" if value is None else f"'{value}'"
            self.spark.sql(
                f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION ({column} = {written_as})"
            )
            folder = NO_VALUE if value is None else value
            files.delete(hadoop_path(self.spark, f"{root}/{column}={folder}")[0], True)
        self.spark.catalog.refreshTable(self.name(table))

    def set_property(self, table: str, name: str, value: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(table)} SET TBLPROPERTIES ('{name}' = '{value}')")

    def property(self, table: str, name: str) -> str | None:
        """What ``set_property`` stored with the table, or None; a replacement may lose it."""
        found = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").filter(F.col("key") == name)
        row = found.first()
        return row["value"] if row else None

    def write(self, df: DataFrame, table: str, mode: str, partition_by: list[str] | None = None) -> None:
        """``create`` (fails if the table exists), ``append``, ``replace`` or
        ``overwrite_partitions`` (an error for a table without partitions).

        ``partition_by`` counts when the table is created, unless PARTITIONED_BY names it.

        Columns are matched by name and cast to the declared types first. Rows for a partitioned
        table are gathered by partition, so that each gets few files and a large one several tasks.
        """
        if table in TABLES:
            df = conform(df, TABLES[table])
        partitions = self._partitions(table) or partition_by or []
        if partitions:
            df = df.hint("rebalance", *partitions)
        if mode not in MODES:
            raise ValueError(f"unknown write mode {mode}")
        if mode == "overwrite_partitions" and not partitions:
            raise ValueError(f"{table} has no partitions; use replace to write all of it")
        if mode == "create" and self.exists(table):
            raise AnalysisException(f"table {self.name(table)} already exists")
        if not self.exists(table):
            self._create(df, table, partitions)
        elif mode == "append":
            self._append(df, table)
        elif mode == "replace":
            self._replace(df, table)
        else:
            self._overwrite_partitions(df, table)

    def write_bucketed(self, df: DataFrame, table: str, keys: list[str], buckets: int) -> None:
        """Create or replace a table whose rows lie in ``buckets`` buckets by the hash that Spark shuffles
        by, sorted by the keys within each file: what is grouped by, or joined on, these keys (or more)
        needs no shuffle then.

        Rows are gathered by bucket first; a bucket with very many rows is written by several tasks.
        """
        if self.provider != "parquet":
            raise ValueError("buckets are for Parquet tables")
        if table in TABLES:
            df = conform(df, TABLES[table])
        bucket = F.pmod(F.hash(*keys), F.lit(buckets)).alias("_bucket")
        gathered = df.select("*", bucket).hint("rebalance", "_bucket").drop("_bucket")
        found, name = self.exists(table), table
        if found:
            name = table + NEXT
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(name)}")
        writer = gathered.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
        writer.option("path", self._new_location(table)).saveAsTable(self.name(name))
        if found:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
            self._rename(name, table)
            self.drop_old_files(table, keep=1)

    def read_bucketed(self, table: str, hot_share: float = HOT_SHARE) -> DataFrame:
        """The rows of a bucketed table. If one bucket holds more than ``HOT_BYTES`` and more than
        ``hot_share`` of all bytes, which a hot key makes it do, the buckets are not used: a task reads a
        whole bucket, while without them Spark deals the files out evenly and shuffles what it has to.
        """
        rows = self.read(table)
        folder, files = hadoop_path(self.spark, self._location(table))
        sizes: dict[str, int] = {}
        for status in files.listStatus(folder):
            bucket = BUCKET_FILE.search(status.getPath().getName())
            if bucket:
                sizes[bucket[1]] = sizes.get(bucket[1], 0) + status.getLen()
        largest = max(sizes.values(), default=0)
        if largest <= max(HOT_BYTES, hot_share * sum(sizes.values())):
            return rows
        return self.spark.read.schema(rows.schema).parquet(self._location(table))

    def _partitions(self, table: str) -> list[str]:
        """The partition columns, by PARTITIONED_BY or else by the catalog."""
        if table in PARTITIONED_BY or self.provider != "parquet" or not self.exists(table):
            return PARTITIONED_BY.get(table, [])
        listed = self.spark.catalog.listColumns(self.name(table))
        return [column.name for column in listed if column.isPartition]

    def _format_writer(self, df: DataFrame, table: str, partitions: list[str]):
        writer = df.writeTo(self.name(table)).using(self.provider)
        writer = writer.tableProperty("write.format.default", "parquet")
        return writer.partitionedBy(*map(F.col, partitions)) if partitions else writer

    def _create(self, df: DataFrame, table: str, partitions: list[str]) -> None:
        if self.provider != "parquet":
            self._format_writer(df, table, partitions).create()
            return
        writer = df.write.format("parquet").partitionBy(*partitions)
        writer.option("path", self._new_location(table)).saveAsTable(self.name(table))

    def _new_location(self, table: str) -> str:
        return os.path.join(self.root, table, f"v-{uuid.uuid4().hex}")

    def _append(self, df: DataFrame, table: str) -> None:
        if self.provider != "parquet":
            df.writeTo(self.name(table)).append()
            return
        df.select(self.read(table).columns).write.insertInto(self.name(table))

    def _replace(self, df: DataFrame, table: str) -> None:
        if self.provider != "parquet":
            self._format_writer(df, table, self._partitions(table)).createOrReplace()
            return
        partitions, location = self._partitions(table), self._new_location(table)
        df.write.partitionBy(*partitions).parquet(location)
        stored = [(f.name, f.dataType) for f in self.read(table).schema.fields]
        if not partitions and stored == [(f.name, f.dataType) for f in df.schema.fields]:
            self.spark.sql(f"ALTER TABLE {self.name(table)} SET LOCATION '{location}'")
        else:
            self._register_anew(df.schema, table, location)
        self.spark.catalog.refreshTable(self.name(table))
        self.drop_old_files(table, keep=1)

    def _register_anew(self, schema: T.StructType, table: str, location: str) -> None:
        """Point the table at files with other columns, or with partitions of their own. The new table
        is complete before the old one goes; if this is cut short in between, ``exists`` goes on."""
        partitions, fresh = self._partitions(table), self.name(table + NEXT)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        self.spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        self.spark.sql(f"CREATE TABLE {fresh} ({columns}) USING parquet {by} LOCATION '{location}'")
        if partitions:
            self.spark.catalog.recoverPartitions(fresh)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
        self._rename(table + NEXT, table)

    def _overwrite_partitions(self, df: DataFrame, table: str) -> None:
        if self.provider != "parquet":
            df.writeTo(self.name(table)).overwritePartitions()
            return
        # The writer's own option: a setting of the session would hold for the jobs beside this one.
        writer = df.select(self.read(table).columns).write.mode("overwrite")
        writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*self._partitions(table)).parquet(self._location(table))
        self._register_new_partitions(table)
        self.spark.catalog.refreshTable(self.name(table))

    def _register_new_partitions(self, table: str) -> None:
        """Make partitions known for which there are folders; those that the catalog has stay untouched."""
        column = self._partitions(table)[0]
        folder, files = hadoop_path(self.spark, self._location(table))
        names = {f.getPath().getName() for f in files.listStatus(folder) if f.isDirectory()}
        listed = self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").collect()
        new = sorted({n for n in names if n.startswith(f"{column}=")} - {r["partition"] for r in listed})
        if any("%" in name for name in new) or len(self._partitions(table)) > 1:
            self.spark.catalog.recoverPartitions(self.name(table))
        elif new:
            values = [name.partition("=")[2] for name in new]
            literals = ["NULL" if value == NO_VALUE else f"'{value}'" for value in values]
            added = " ".join(f"PARTITION ({column} = {literal})" for literal in literals)
            self.spark.sql(f"ALTER TABLE {self.name(table)} ADD IF NOT EXISTS {added}")

    def _location(self, table: str) -> str:
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}")
        return described.filter(F.col("col_name") == "Location").first()["data_type"]

"""Message envelopes to bronze ratings, in batch and as a stream."""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tiermill.schemas import RATING_MESSAGE
from tiermill.session import hadoop_path

PAYLOAD = [f.name for f in RATING_MESSAGE.fields]
TRIGGER = "10 seconds"
RUN, BATCH, DAY = "run_id", "batch_id", "event_date"

_POSITION = [
    T.StructField("processed_timestamp", T.TimestampType()),
    T.StructField("_kafka_topic", T.StringType()),
    T.StructField("_kafka_partition", T.IntegerType()),
    T.StructField("_kafka_offset", T.LongType()),
]
_FOLDERS = [T.StructField(RUN, T.StringType()), T.StructField(BATCH, T.LongType())]
STORED = T.StructType(
    [*RATING_MESSAGE.fields, *_POSITION, *_FOLDERS, T.StructField("event_date", T.DateType())]
)
REJECTED = T.StructType([*_POSITION, T.StructField("raw", T.StringType()), *_FOLDERS])


def parse_ratings(
    envelopes: DataFrame, processed_at: Column | None = None, keep_raw: bool = False
) -> DataFrame:
    """Envelope rows to bronze rows, with the message text as ``raw`` if asked for.

    Text that is no JSON object gives nulls in all payload columns, a field of the wrong type gives a
    null in that field. ``event_date`` is the day of the rating, by which bronze is partitioned.
    """
    processed = F.current_timestamp() if processed_at is None else processed_at
    text = F.col("value").cast("string")
    return envelopes.select(
        F.from_json(text, RATING_MESSAGE).alias("data"),
        text.alias("raw"),
        F.col("topic").alias("_kafka_topic"),
        F.col("partition").alias("_kafka_partition"),
        F.col("offset").alias("_kafka_offset"),
    ).select(
        "data.*",
        processed.alias("processed_timestamp"),
        "_kafka_topic",
        "_kafka_partition",
        "_kafka_offset",
        F.to_date("data.timestamp").alias("event_date"),
        *(["raw"] if keep_raw else []),
    )


def unreadable() -> Column:
    """True for a parsed row without any payload: the message was not a rating at all."""
    return F.coalesce(*[F.col(c).cast("string") for c in PAYLOAD]).isNull()


def write_batch(
    batch: DataFrame, batch_id: int, path: str, partition_by: list[str], run_id: str = "0"
) -> None:
    """Write one micro-batch to a folder of its own. A replayed batch replaces that folder, so the
    rows of a batch are stored once however often it runs. Batches are counted anew for each
    checkpoint, so ``run_id`` names the checkpoint. An empty batch writes nothing."""
    if batch.isEmpty():
        return
    if partition_by:
        batch = batch.hint("rebalance", *partition_by)
    writer = batch.write.mode("overwrite").partitionBy(*partition_by)
    writer.parquet(f"{path}/{RUN}={run_id}/{BATCH}={batch_id}")


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the query when it made its checkpoint: the same after every restart,
    another one for a new checkpoint."""
    text = spark.read.text(os.path.join(checkpoint, "metadata"), wholetext=True).first()[0]
    return json.loads(text)["id"]


def start_bronze(
    envelopes: DataFrame,
    path: str,
    checkpoint: str,
    rejected_path: str | None = None,
    until_caught_up: bool = False,
    trigger: str = TRIGGER,
    late_after: str | None = None,
) -> StreamingQuery:
    """Start the stream from envelopes to bronze files; empty batches write nothing.

    It runs every ten seconds, or with ``until_caught_up`` works off what is there and ends. With
    ``rejected_path`` unreadable messages go there, as text, instead of to bronze. With ``late_after``
    messages that come again are dropped, and those that are later than that: a ``BatchMetrics``
    listener counts both.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        run = run_id(batch.sparkSession, checkpoint)
        # Kept, so that the topic is not read and parsed again for the second look at it.
        batch.persist()
        try:
            good = batch if rejected_path is None else batch.filter(~unreadable())
            write_batch(good.drop("raw"), batch_id, path, ["event_date"], run)
            if rejected_path is not None:
                rejected = batch.filter(unreadable()).drop("event_date", *PAYLOAD)
                write_batch(rejected, batch_id, rejected_path, [], run)
        finally:
            batch.unpersist()

    parsed = parse_ratings(envelopes, keep_raw=True)
    writer = (
        (parsed if late_after is None else drop_repeats(parsed, late_after))
        .writeStream.foreachBatch(store)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if until_caught_up:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def read_batches(spark: SparkSession, path: str, schema: T.StructType = STORED) -> DataFrame:
    """All stored batches as one table, none if nothing was stored yet; ``event_date``, ``run_id`` and
    ``batch_id`` prune by folder. Rejected messages have the schema REJECTED."""
    folder, files = hadoop_path(spark, path)
    if not files.exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def batch_counts(batches: DataFrame) -> DataFrame:
    """(run_id, batch_id, row_count) of the stored batches. The progress of a query is no substitute: it
    counts a row once for every time that a batch is read."""
    return batches.groupBy(RUN, BATCH).agg(F.count("*").alias("row_count"))


def latest_rows(ratings: DataFrame, rows: int = 5) -> DataFrame:
    """The last rows by time; ties are broken by topic position."""
    return ratings.orderBy(
        F.desc("timestamp"),
        F.desc("_kafka_topic"),
        F.desc("_kafka_partition"),
        F.desc("_kafka_offset"),
    ).limit(rows)


def drop_repeats(ratings: DataFrame, delay: str = "48 hours") -> DataFrame:
    """Drop redelivered messages (same topic position) of a stream; state is kept for ``delay``."""
    return ratings.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(
        ["_kafka_topic", "_kafka_partition", "_kafka_offset"]
    )

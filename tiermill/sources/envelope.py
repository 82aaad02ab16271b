"""Streams of message envelopes: key, value, topic, partition, offset, timestamp.

With the Kafka connector on the classpath the envelopes come from a topic; without it, from a folder
of Parquet files with the same columns. What follows is the same for both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
    ]
)


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    max_per_batch: int | None = None,
) -> DataFrame:
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", "false")
    )
    if max_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", max_per_batch)
    return reader.load()


def read_envelope_files(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(ENVELOPE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)

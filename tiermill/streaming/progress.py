"""What each micro-batch took in, kept, found repeated and dropped as late, stored once per batch."""

from __future__ import annotations

import json
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from tiermill.session import hadoop_path

METRICS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("rows_in", T.LongType()),
        T.StructField("rows_kept", T.LongType()),
        T.StructField("rows_repeated", T.LongType()),
        T.StructField("rows_late", T.LongType()),
        T.StructField("watermark", T.StringType()),
        T.StructField("milliseconds", T.LongType()),
    ]
)


def batch_metrics(progress: dict) -> dict:
    """One row of METRICS from the progress that Spark reports for a batch.

    The rows that came in are those that the first stateful step was given: kept, repeated and late
    ones. A stream without one has the rows that its source gave, all of them kept.
    """
    states = progress.get("stateOperators") or []
    if states:
        state = states[0]
        kept = state.get("numRowsUpdated", 0)
        repeated = (state.get("customMetrics") or {}).get("numDroppedDuplicateRows", 0)
        late = state.get("numRowsDroppedByWatermark", 0)
    else:
        kept, repeated, late = progress.get("numInputRows", 0), 0, 0
    return {
        "run_id": progress["id"],
        "batch_id": progress["batchId"],
        "rows_in": kept + repeated + late,
        "rows_kept": kept,
        "rows_repeated": repeated,
        "rows_late": late,
        "watermark": (progress.get("eventTime") or {}).get("watermark"),
        "milliseconds": progress.get("batchDuration", 0),
    }


class BatchMetrics(StreamingQueryListener):
    """Writes the metrics of every batch of every query of the session to a file of its own below
    ``path``. The file is named by checkpoint and batch, so a batch that is done again replaces it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.ended = spark, path, {}

    def onQueryStarted(self, event) -> None:
        self.ended.setdefault(str(event.runId), Event())

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        if progress.get("numInputRows", 0) == 0 and not progress.get("batchDuration"):
            return
        row = batch_metrics(progress)
        name = f"{self.path}/{row['run_id']}-{row['batch_id']}.json"
        path, files = hadoop_path(self.spark, name)
        out = files.create(path, True)
        try:
            out.write(bytearray(json.dumps(row).encode()))
        finally:
            out.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), Event()).set()

    def wait(self, query, seconds: float = 60) -> None:
        """Until the last metrics of a query that has ended are written: events come in order."""
        if not self.ended.setdefault(str(query.runId), Event()).wait(seconds):
            raise TimeoutError("the end of the query was not reported")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The stored metrics, one row per batch that had rows."""
    folder, files = hadoop_path(spark, path)
    if not files.exists(folder):
        return spark.createDataFrame([], METRICS)
    return spark.read.schema(METRICS).json(path).filter("rows_in > 0")


def totals(metrics: DataFrame) -> DataFrame:
    """One row: the sums over all batches."""
    names = ["rows_in", "rows_kept", "rows_repeated", "rows_late"]
    return metrics.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in names])

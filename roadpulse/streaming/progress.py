"""What every batch of a job read, wrote and dropped, as Spark reports it."""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from roadpulse.functions.times import moment
from roadpulse.streaming import records

BATCHES = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("rows_read", T.LongType()),
        T.StructField("rows_written", T.LongType()),
        # keys that reached the state behind the watermark; rows of one key count once a batch
        T.StructField("late_keys", T.LongType()),
    ]
)


class BatchAudit(StreamingQueryListener):
    """Records one row per batch of one query; a replayed batch replaces its row.

    Records are written by the driver after the batch. If the driver dies in between, the batch
    has no record: rows written are then still in the table's ledger, which commits with it.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.name = f"roadpulse-{uuid.uuid4().hex}"
        self.run, self.ended = None, threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.run = event.runId

    def onQueryProgress(self, event) -> None:
        batch = event.progress
        if batch.runId != self.run:
            return
        counted = batch.observedMetrics.get("batch")
        record = {
            "batch_id": batch.batchId,
            "rows_read": batch.numInputRows,
            "rows_written": counted["rows"] if counted is not None else 0,
            "late_keys": sum(s.numRowsDroppedByWatermark for s in batch.stateOperators),
        }
        records.write(self.spark, self.folder, f"batch-{batch.batchId:012d}", record, moment())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.run:
            self.ended.set()

    def wait(self, seconds: float = 60) -> bool:
        """Wait until all batches of a query that has ended are recorded; then stop listening."""
        complete = self.ended.wait(seconds)
        self.spark.streams.removeListener(self)
        return complete


def batches_folder(table_path: str) -> str:
    return f"{table_path}.batches"


def read_batches(spark: SparkSession, table_path: str) -> DataFrame:
    """One row per batch: rows read and written, and keys dropped as late."""
    return records.read(spark, batches_folder(table_path), BATCHES)

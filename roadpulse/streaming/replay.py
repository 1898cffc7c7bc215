"""Run the streaming jobs over landed slices of a feed, one restart per slice."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse import settings
from roadpulse.session import STREAM_CONF
from roadpulse.sources.feeds import FeedSource, encode_feed
from roadpulse.sources.replay import as_payload
from roadpulse.streaming import files
from roadpulse.streaming.outbox import AlertChannel

@dataclass(frozen=True)
class FailingChannel(AlertChannel):
    """A channel whose first ``failures`` sends fail; attempts are counted beside its path."""

    failures: int = 0

    def send(self, messages: DataFrame, batch_id: int) -> None:
        spark, tried = messages.sparkSession, f"{self.path}.attempts"
        attempt = len(files.children(spark, tried)) + 1
        files.write_text(spark, f"{tried}/{attempt}", "")
        if attempt <= self.failures:
            raise OSError(f"attempt {attempt}: the channel is down")
        super().send(messages, batch_id)


FEED_KEYS = {"traffic": "corridor_id", "weather": "location", "vehicle": "vehicle_id"}


def envelopes(feed: DataFrame, kind: str) -> DataFrame:
    """Feed rows as a broker would deliver them; the offset is the event's number."""
    meta = feed.withColumn("offset", F.col("event_id")).drop("event_id")
    return encode_feed(as_payload(meta, kind), FEED_KEYS[kind], keep=("offset",)).select(
        F.lit(settings.TOPICS[kind]).alias("topic"), "key", "value", "offset"
    )


def replay(
    spark: SparkSession,
    slices: Iterable[DataFrame],
    feed_path: str,
    start: Callable[[SparkSession, FeedSource], object],
    state_partitions: int | None = None,
) -> None:
    """Land each slice of envelopes and let the job catch up with it, then stop it.

    Every slice restarts the job from its checkpoint. State partitions are fixed by the first
    start, so they are set on a session of their own, which otherwise has the caller's settings
    and keeps state as the command line's jobs do. The landed slices are removed at the end.
    """
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            session.conf.set(key, value)
    for key, value in STREAM_CONF.items():
        session.conf.set(key, value)
    if state_partitions:
        session.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    for rows in slices:
        rows.write.mode("append").parquet(feed_path)
        query = start(session, FeedSource(format="parquet", path=feed_path))
        query.awaitTermination()
    files.delete(spark, feed_path)

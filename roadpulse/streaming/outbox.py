"""Delivery of logged alerts: the log is the queue, a cursor says how far it was sent.

A batch sends everything the log holds beyond the cursor, so what a failed channel missed goes
with the next batch that gets through. The cursor moves after the channel has taken the
messages: they are sent at least once, and exactly once to a channel of files, where every
version has a folder that a repeated send replaces.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.operators.alerts import alert_messages
from roadpulse.sources.feeds import write_feed
from roadpulse.streaming import files
from roadpulse.streaming.store import UpsertTable, read_ledger, rows_above

logger = logging.getLogger("roadpulse.outbox")

_SENT = "sent-"
MESSAGES = "version bigint, key string, value string"


@dataclass(frozen=True)
class AlertChannel:
    """Where alert messages (key, JSON value) go after the alert log has them.

    ``kafka`` sends to a topic; any file format writes one folder per version under ``path``,
    which a repeated send replaces.
    """

    format: str = "json"
    path: str | None = None
    topic: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def send(self, messages: DataFrame, batch_id: int) -> None:
        """Send rows of version, key and value, of which ``batch_id`` is the newest batch."""
        if self.format == "kafka":
            write_feed(messages, self.topic, self.options)
            return
        messages.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "version"
        ).format(self.format).options(**self.options).save(self.path)

    def received(self, spark: SparkSession) -> DataFrame:
        """What a channel of files has taken (version, key, value); none before the first send."""
        if not files.exists(spark, self.path):
            return spark.createDataFrame([], MESSAGES)
        return spark.read.schema(MESSAGES).format(self.format).options(**self.options).load(self.path)


@dataclass(frozen=True)
class Outbox:
    """Alerts of a log on their way to one channel."""

    log: UpsertTable
    channel: AlertChannel
    name: str = "channel"

    @property
    def path(self) -> str:
        return f"{self.log.path}.outbox/{self.name}"

    def sent(self, spark: SparkSession) -> int:
        """The last version the channel has taken; -1 at first."""
        marks = [int(n.removeprefix(_SENT)) for n in files.children(spark, self.path, _SENT)]
        return max(marks, default=-1)

    def _move(self, spark: SparkSession, version: int) -> None:
        files.write_text(spark, f"{self.path}/{_SENT}{version}", "")
        for mark in files.children(spark, self.path, _SENT):
            if int(mark.removeprefix(_SENT)) < version:
                files.delete(spark, f"{self.path}/{mark}")

    def pending(self, spark: SparkSession, after: int | None = None, upto: int | None = None) -> DataFrame:
        """Logged alerts beyond the cursor, with their version.

        The ledger names the dates they lie on; no others are read.
        """
        after = self.sent(spark) if after is None else after
        rows = rows_above(spark, self.log, after)
        return rows if upto is None else rows.where(F.col("version") <= upto)

    def deliver(self, spark: SparkSession, version: int | None = None) -> None:
        """Send what is pending up to ``version`` (default: all) and move the cursor.

        A replayed batch sends its version again. Errors of the channel are the caller's, and
        leave the cursor where it was.
        """
        last = self.sent(spark)
        if version is None:
            newest = read_ledger(spark, self.log, last).where(F.col("version") % 2 == 0).agg(F.max("version"))
            version = newest.first()[0]
            if version is None or version <= last:
                return
        rows = self.pending(spark, min(last, version - 1), version)
        messages = alert_messages(rows.select("version", *self.log.columns.names), keep=("version",))
        if not messages.isEmpty():
            self.channel.send(messages, version // 2)
        if version > last:
            self._move(spark, version)

    def catch_up(self, spark: SparkSession, tries: int) -> None:
        """Send what is pending once no more batches come; the last of so many errors is raised."""
        for left in reversed(range(tries)):
            try:
                return self.deliver(spark)
            except Exception:
                if not left:
                    raise
                logger.exception("alert channel failed, %s tries left", left)

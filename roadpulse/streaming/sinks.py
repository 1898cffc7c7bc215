"""Micro-batch sinks."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame

from roadpulse.functions.times import moment
from roadpulse.operators.alerts import build_alerts
from roadpulse.streaming.outbox import AlertChannel, Outbox
from roadpulse.streaming.store import UpsertTable, advance_newest, batch_version, write_version

logger = logging.getLogger("roadpulse.sinks")

BatchSink = Callable[[DataFrame, int], None]


def upsert_sink(
    table: UpsertTable,
    then: BatchSink | None = None,
    files_per_batch: int | None = None,
    written_at=None,
    keep_newest: bool = False,
) -> BatchSink:
    """Write each batch as one version of the table, then hand it to ``then``.

    ``keep_newest`` also merges it into the table of newest rows, from the files just written.

    The batch is persisted only when it is read twice. ``files_per_batch`` shuffles the
    (already aggregated) rows into that many writers, which leaves the state upstream fully
    parallel. A failed write fails the batch, so the stream retries it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        reuse = then is not None
        rows = batch.persist() if reuse else batch
        try:
            placed = rows
            if files_per_batch is not None:
                placed = rows.repartition(files_per_batch, *table.keys)
            write_version(placed, table, batch_version(batch_id), moment(written_at))
            if keep_newest:
                advance_newest(rows.sparkSession, table, batch_version(batch_id))
            logger.info("batch %s written to %s", batch_id, table.path)
            if then is not None:
                then(rows, batch_id)
        finally:
            if reuse:
                rows.unpersist()

    return write


def alert_sink(
    table: UpsertTable,
    channel: AlertChannel | None = None,
    created_at=None,
    files_per_batch: int | None = None,
) -> BatchSink:
    """Log an alert for every anomalous row of the batch, then deliver what the channel lacks.

    The channel only gets what the log has. A failed log fails the batch: Spark repeats it, and
    the version replaces itself. A failed channel is logged and does not fail the batch; its
    messages go with the next batch. The batch is persisted, so writing fewer files does not
    slow the state down.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        now = moment(created_at)  # the log and the channel carry the same time
        alerts = build_alerts(batch, now)
        if files_per_batch is not None:
            alerts = alerts.coalesce(files_per_batch)
        write_version(alerts, table, batch_version(batch_id), now)
        if channel is None:
            return
        try:
            Outbox(table, channel).deliver(batch.sparkSession, batch_version(batch_id))
        except Exception:
            logger.exception("batch %s: alert channel failed", batch_id)

    return write

"""Daily maintenance: corridor list, baselines, folding and retention."""

from __future__ import annotations

import logging
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse import schemas
from roadpulse.functions.times import instant, moment
from roadpulse.operators.baselines import (
    BASELINE_KEYS,
    BASELINE_VALUES,
    baseline_parts,
    baselines_of_parts,
)
from roadpulse.operators.merge import CORRIDOR_UPDATES, insert_if_absent, merge_by_key
from roadpulse.settings import DEFAULTS, Thresholds
from roadpulse.streaming import files, progress, records, store

logger = logging.getLogger("roadpulse.daily")


def _as(df: DataFrame, schema) -> DataFrame:
    """Columns of a schema; the ones a frame lacks are null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def read_corridors(spark: SparkSession, path: str) -> DataFrame:
    return store.read_snapshot(spark, path, schemas.CORRIDORS)


def read_baselines(spark: SparkSession, path: str) -> DataFrame:
    return store.read_snapshot(spark, path, schemas.CONGESTION_BASELINES)


def seed_corridors(spark: SparkSession, seed: DataFrame, path: str) -> None:
    """Add the seed's corridors where the table lacks them."""
    merged = insert_if_absent(read_corridors(spark, path), seed, ["corridor_id"])
    store.publish_snapshot(spark, _as(merged, schemas.CORRIDORS), path)


def refresh_corridors(spark: SparkSession, listing: DataFrame, path: str) -> bool:
    """Upsert the corridor list; an empty list changes nothing. Errors are the caller's."""
    if listing.isEmpty():
        logger.warning("the corridor list is empty; nothing to refresh")
        return False
    merged = merge_by_key(
        read_corridors(spark, path), listing, ["corridor_id"], CORRIDOR_UPDATES
    )
    store.publish_snapshot(spark, merged, path)
    return True


def _parts_folder(metrics: store.UpsertTable) -> str:
    return f"{metrics.path}.baseline_parts"


def _parts_held(spark: SparkSession, metrics: store.UpsertTable) -> dict[str, int]:
    """Dates that have baseline parts, with the fold they were made from."""
    held, root = {}, _parts_folder(metrics)
    for name in files.children(spark, root, "event_date="):
        made = [int(v.split("=")[1]) for v in files.children(spark, f"{root}/{name}", "version=")]
        if made:
            held[name.split("=")[1]] = max(made)
    return held


def add_baseline_parts(spark: SparkSession, metrics: store.UpsertTable, since=None) -> int:
    """Add up every folded date once, from ``since`` on; returns how many dates that were.

    A date that was folded again is added up again, and parts of dates that are gone go too.
    """
    folded = store.folded_days(spark, metrics, since)
    held, root = _parts_held(spark, metrics), _parts_folder(metrics)
    todo = {day: version for day, version in folded.items() if held.get(day) != version}
    if todo:
        rows = store.read_table(spark, metrics, days=sorted(todo))
        parts = baseline_parts(rows.withColumn("event_date", F.to_date("event_time")), "event_date")
        folds = F.create_map(*[F.lit(x) for pair in todo.items() for x in pair])
        made = parts.withColumn("version", folds[F.col("event_date").cast("string")].cast("long"))
        made.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "event_date", "version"
        ).parquet(root)
    current = set(store.days_held(spark, metrics))
    for day, version in held.items():
        if day not in current:
            files.delete(spark, f"{root}/event_date={day}")
        elif day in todo:
            files.delete(spark, f"{root}/event_date={day}/version={version}")
    return len(todo)


def _usable_parts(
    spark: SparkSession, metrics: store.UpsertTable, since, now, th: Thresholds
) -> dict[str, int]:
    """Dates whose rows all count, by the fold their parts were made from.

    They lie wholly within the days that count, were not written to since, and have no rows past
    retention.
    """
    first_whole = (since + timedelta(days=1)).date().isoformat()
    folded, held = store.folded_days(spark, metrics, since), _parts_held(spark, metrics)
    same = {day: v for day, v in folded.items() if day >= first_whole and held.get(day) == v}
    if not same:
        return {}
    oldest = now - timedelta(days=th.retention_days)
    fresh = store.read_ledger(spark, metrics).where(F.col("first_written") > F.lit(oldest))
    days = fresh.select("version", F.explode(F.col("dates").cast("array<string>")).alias("day"))
    whole = {(r["day"], r["version"]) for r in days.where(F.col("day").isin(*same)).collect()}
    return {day: v for day, v in same.items() if (day, v) in whole}


def stored_baselines(
    spark: SparkSession,
    metrics: store.UpsertTable,
    corridors: DataFrame,
    as_of=None,
    th: Thresholds = DEFAULTS,
) -> DataFrame:
    """Baselines of a stored table: one small part per folded date, rows of the other dates.

    The same, to the last digit, as ``baselines`` over all rows.
    """
    now = moment(as_of)
    since = now - timedelta(days=th.baseline_days)
    usable = _usable_parts(spark, metrics, since, now, th)
    others = [d for d in store.days_held(spark, metrics, since) if d not in usable]
    rows = store.read_table(spark, metrics, since, now, th, days=others)
    parts = baseline_parts(rows)
    if usable:
        folders = [f"{_parts_folder(metrics)}/event_date={d}/version={v}" for d, v in usable.items()]
        closed = spark.read.schema(schemas.BASELINE_PARTS).parquet(*folders)
        parts = parts.select(*schemas.BASELINE_PARTS.names).unionByName(closed)
    return baselines_of_parts(parts, corridors, now)


def recalculate_baselines(
    spark: SparkSession,
    metrics: store.UpsertTable,
    corridors: DataFrame,
    path: str,
    as_of=None,
    th: Thresholds = DEFAULTS,
) -> int:
    """Recompute recent baselines and merge them over the stored ones.

    Returns the number recomputed. Stored baselines that got no new samples stay.
    """
    now = moment(as_of)
    fresh = stored_baselines(spark, metrics, corridors, now, th)
    merged = merge_by_key(read_baselines(spark, path), fresh, BASELINE_KEYS, BASELINE_VALUES)
    store.publish_snapshot(spark, _as(merged, schemas.CONGESTION_BASELINES), path)
    written = read_baselines(spark, path).where(F.col("updated_at") == instant(now)).count()
    logger.info("recalculated %s baseline row(s)", written)
    return written


def tidy(
    spark: SparkSession, table: store.UpsertTable, as_of=None, th: Thresholds = DEFAULTS
) -> tuple[int, int]:
    """Fold the dates before yesterday, drop what is past retention, pack the table's records.

    Every kept row of a folded date keeps its own write time, so retention is unaffected. Rows
    of a log do not expire: its dates are only brought into fewer files.
    """
    dropped = 0 if table.keeps_all else store.drop_expired(spark, table, as_of, th)
    folded = store.fold(spark, table, moment(as_of) - timedelta(days=1))
    store.pack_ledger(spark, table)
    records.pack(spark, progress.batches_folder(table.path), progress.BATCHES)
    return folded, dropped

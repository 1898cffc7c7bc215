"""Keyed merges, retention and referential checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.times import before
from roadpulse.operators.latest import latest_by
from roadpulse.settings import DEFAULTS, Thresholds

CORRIDOR_UPDATES = ["name", "city", "start_lat", "start_lon", "end_lat", "end_lon"]


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The greatest row of every key by ``order``, then by the other columns as they stand."""
    others = [c for c in df.columns if c not in keys and c not in order]
    return latest_by(df, keys, [*order, *others])


def merge_by_key(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    order: Sequence[str] = (),
) -> DataFrame:
    """Upsert ``source`` into ``target``.

    Existing rows take only ``update_cols`` from the source and keep their other columns; new
    rows are inserted with whatever columns the source has; rows the source does not mention
    stay as they are. Of several source rows with one key, the greatest by ``order`` counts.
    """
    source = one_per_key(source, keys, order)
    kept = [c for c in target.columns if c not in keys]
    given = [c for c in source.columns if c not in keys]
    old = target.select(*keys, F.struct(*kept).alias("_old"))
    new = source.select(*keys, F.struct(*given).alias("_new"))
    merged = old.join(new, list(keys), "full_outer")

    def value(name: str):
        before_, after = F.col("_old").getField(name), None
        if name in given:
            after = F.col("_new").getField(name)
        if after is None:
            return before_.alias(name)
        if name in update_cols:
            return F.when(F.col("_new").isNotNull(), after).otherwise(before_).alias(name)
        return F.when(F.col("_old").isNotNull(), before_).otherwise(after).alias(name)

    return merged.select(*keys, *[value(c) for c in kept])


def insert_if_absent(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Target rows, and one source row for every key that the target lacks.

    Of several source rows with one key, the greatest by ``order`` is inserted.
    """
    fresh = one_per_key(source, keys, order).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True)


def expire(
    df: DataFrame, as_of, th: Thresholds = DEFAULTS, written: str = "ingested_at"
) -> DataFrame:
    """Rows still within retention, counted from when they were written."""
    return df.where(F.col(written) > before(as_of, days=th.retention_days))


def orphan_rows(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Child rows whose key has no parent."""
    return child.join(parent.select(*keys), list(keys), "left_anti")

"""Freshness checks and reconciliation. Every check is a row; none raises."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.functions.times import age_minutes, instant
from roadpulse.settings import DEFAULTS, Thresholds


def _status(newest: Column, age: Column, th: Thresholds) -> Column:
    return (
        F.when(newest.isNull(), "empty")
        .when(age > th.freshness_minutes, "stale")
        .otherwise("healthy")
    )


def feed_freshness(
    envelopes: DataFrame, topics: DataFrame, as_of, th: Thresholds = DEFAULTS
) -> DataFrame:
    """State of every expected topic: missing, empty, stale or healthy.

    A topic's newest message is the latest among the last messages of its partitions;
    messages with a negative time do not count.
    """
    last = (
        envelopes.groupBy("topic", "partition")
        .agg(F.max_by("timestamp", "offset").alias("last_time"))
        .where(F.unix_micros("last_time") >= 0)
    )
    newest = last.groupBy("topic").agg(F.max("last_time").alias("newest"))
    age = age_minutes(F.col("newest"), instant(as_of))
    return topics.join(newest, "topic", "left").select(
        "topic",
        F.when(F.col("topic_exists"), F.col("newest")).alias("newest"),
        F.when(F.col("topic_exists"), age).alias("age_minutes"),
        F.when(~F.col("topic_exists"), "missing")
        .otherwise(_status(F.col("newest"), age, th))
        .alias("status"),
    )


def table_freshness(tables: dict[str, DataFrame], as_of, th: Thresholds = DEFAULTS) -> DataFrame:
    """State of every table: empty, stale or healthy. Future rows are healthy."""
    newest = reduce(
        DataFrame.unionByName,
        [
            df.agg(F.max("event_time").alias("newest")).select(
                F.lit(name).alias("table_name"), "newest"
            )
            for name, df in tables.items()
        ],
    )
    age = age_minutes(F.col("newest"), instant(as_of))
    return newest.select(
        "table_name",
        "newest",
        age.alias("age_minutes"),
        _status(F.col("newest"), age, th).alias("status"),
    )


def reconcile(
    expected: DataFrame, actual: DataFrame, keys: Sequence[str], tolerance: float = 1e-6
) -> DataFrame:
    """Compare two tables key by key, one boolean per field.

    Doubles match within ``tolerance``, everything else exactly, and two nulls match.
    """
    fields = [f for f in expected.schema.fields if f.name not in keys]
    names = [f.name for f in fields]
    both = expected.select(*keys, F.struct(*names).alias("_want")).join(
        actual.select(*keys, F.struct(*names).alias("_got")), list(keys), "full_outer"
    )
    here, there = F.col("_want").isNotNull(), F.col("_got").isNotNull()

    def same(field: T.StructField) -> Column:
        want, got = F.col("_want").getField(field.name), F.col("_got").getField(field.name)
        equal = want.eqNullSafe(got)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            equal = equal | F.coalesce(F.abs(want - got) < tolerance, F.lit(False))
        return here & there & equal

    checks = [same(f).alias(f"{f.name}_ok") for f in fields]
    compared = both.select(
        *keys, here.alias("in_expected"), there.alias("in_actual"), *checks
    )
    matched = reduce(lambda a, b: a & b, [F.col(f"{n}_ok") for n in names], F.col("in_actual"))
    return compared.withColumn("matched", F.col("in_expected") & matched)

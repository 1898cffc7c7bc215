"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VARIABLE_WIDTH = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key when rows are ordered newest first by ``order``.

    ``order`` should be total within a key. Every task keeps one row per key before the
    shuffle (window group limit), so a key holding much of the data costs no more than others.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return (
        df.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") == 1).drop("_rank")
    )


def newest_values(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The row of every key with the greatest ``order``, which must not be null.

    The same as ``latest_by`` where one column orders the rows and the others have a fixed
    width: one hash aggregate that keeps a row per key and task, without sorting the input.
    """
    newest = [
        F.max(order).alias(order) if c == order else F.max_by(c, order).alias(c)
        for c in df.columns
        if c not in keys
    ]
    return df.groupBy(*keys).agg(*newest).select(*df.columns)


def has_fixed_width(schema: T.StructType, keys: Sequence[str]) -> bool:
    """Whether all columns but the keys fit the buffer of a hash aggregate."""
    return not any(
        isinstance(f.dataType, _VARIABLE_WIDTH) for f in schema.fields if f.name not in keys
    )

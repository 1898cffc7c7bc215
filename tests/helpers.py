from datetime import datetime, timezone

from pyspark.sql import functions as F


def at(text):
    """A moment in UTC."""
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def rows(df, *columns):
    """Sorted tuples of the given columns."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def with_times(df, *columns):
    """Read timestamps as UTC text, whatever the machine's zone."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def plan(df):
    return df._jdf.queryExecution().toString()

"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a running session accepts; all of them are ordinary user options.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# State outgrows executor memory with many corridors; this provider keeps it on disk and
# checkpoints only what a batch changed.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin UTC and adaptive execution on an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str, master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def workspace(spark: SparkSession, label: str) -> str:
    """A new folder for checkpoints and intermediate tables.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``. Only a
    local session without that setting may fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="roadpulse-")
    _made.append(f"{root.rstrip('/')}/roadpulse/{label}-{uuid.uuid4().hex}")
    return _made[-1]


# Work folders of this process that nobody has released, oldest first.
_made: list[str] = []


def mark() -> int:
    """Where the list of work folders stands now, for ``release``."""
    return len(_made)


def release(spark: SparkSession, since: int = 0, but_last: int = 0) -> int:
    """Delete the work folders made since a mark, all but the last so many; returns how many.

    For results that have been read or written elsewhere: frames over these folders can no
    longer be computed.
    """
    gone = _made[since : len(_made) - but_last]
    for path in gone:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        _made.remove(path)
    return len(gone)

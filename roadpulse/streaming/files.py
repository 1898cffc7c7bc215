"""Folder checks through the cluster's own file system client."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def children(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(target)]
    return sorted(n for n in names if n.startswith(prefix))


def has_children(spark: SparkSession, path: str, prefix: str = "") -> bool:
    return bool(children(spark, path, prefix))


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)


def rename(spark: SparkSession, source: str, target: str) -> bool:
    """Move a file or folder to a name that is free; false when the name is taken."""
    fs, old = _open(spark, source)
    new = spark._jvm.org.apache.hadoop.fs.Path(target)
    if fs.exists(new):
        return False
    fs.mkdirs(new.getParent())
    return fs.rename(old, new)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under a name that readers see only when it is complete."""
    fs, target = _open(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{target.getName()}.part")
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(target):
        fs.delete(target, False)
    fs.rename(part, target)

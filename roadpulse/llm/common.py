"""What the operators share: tables, working tables and batches of texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from roadpulse.session import configure, workspace

# A batch of texts between the JVM and Python holds at most so many rows and bytes, whatever
# the length of the texts; only a single longer row goes beyond.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the operators: UTC, adaptive execution, bounded batches."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and whole ``text`` (null: empty) of each row; other columns are left out."""
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    )


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives executors."""
    path = workspace(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_texts(
    df: DataFrame, schema: str, fn: Callable[[list, list[str]], dict[str, list]], text: str = "text"
) -> DataFrame:
    """One output row per input row: ``fn(ids, texts)`` gives the new columns of a batch.

    ``df`` has an id column (passed as it is) and a text column; the id comes out first.
    """
    (key,) = [c for c in df.columns if c != text]
    full = f"{key} {df.schema[key].dataType.simpleString()}, {schema}"
    # stated types: batches without any element would otherwise be of another type
    kinds = {f.name: to_arrow_type(f.dataType) for f in StructType.fromDDL(schema)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(key))
            made = fn(ids, batch.column(batch.schema.get_field_index(text)).to_pylist())
            columns = [pa.array(made[n], kind) for n, kind in kinds.items()]
            yield pa.RecordBatch.from_arrays([ids, *columns], [key, *kinds])

    return df.mapInArrow(run, full)


def text_key(text: Column) -> Column:
    """Names a text next to its doc_id, so that rows that share an id stay apart."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns, whose (doc_id, text_key) is not among ``rejected``."""
    key, rid, rkey = (fresh(docs, n) for n in ("_key", "_rid", "_rkey"))
    bad = rejected.select(F.col("doc_id").alias(rid), F.col("text_key").alias(rkey)).distinct()
    marked = docs.withColumn(key, text_key(docs["text"]))
    hit = marked["doc_id"].cast("long").eqNullSafe(bad[rid]) & (marked[key] == bad[rkey])
    return marked.join(bad, hit, "left_anti").drop(key)


def crc_mod(n: int) -> Column:
    """crc32 of doc_id as text, modulo n; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % n


def small(df: DataFrame, limit: int) -> bool:
    """Whether ``df`` has at most ``limit`` rows, counted without reading more."""
    return df.limit(limit + 1).count() <= limit

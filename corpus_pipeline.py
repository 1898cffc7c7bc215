"""The corpus pipeline: stages that take the documents the stage before has kept.

Every stage calls one operator; all but the last return the columns of documents. Rows of a
stage's input that it does not reject stay as they are, nulls and further columns included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadpulse.llm.common import prepare, stored, table, without
from roadpulse.llm.decontamination import find_leaks
from roadpulse.llm.mixing import poisson_mix
from roadpulse.llm.near_duplicates import keep_one
from roadpulse.llm.secrets import redact
from roadpulse.llm.toxicity import toxicity
from roadpulse.session import mark, release


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic."""
    scored = toxicity(docs, table(spark, sf_dir, "labels"))
    return without(docs, scored.filter("predicted = 1"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal and near-equal texts."""
    prepare(spark)
    return keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without(docs, find_leaks(docs, table(spark, sf_dir, "benchmark")))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret."""
    prepare(spark)
    return redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: documents repeated by their source's rate and dealt out globally."""
    prepare(spark)
    return poisson_mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

# Nearest neighbours, MinHash and pattern scans are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again for the next one.

    Once a stage is written, its working tables and the input it had are removed.
    """
    docs, start = table(spark, sf_dir, "documents"), mark()
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        release(spark, start, but_last=1)
    return STAGES[-1][1](spark, docs, sf_dir)

"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from roadpulse.llm import (
    centroids,
    decontamination,
    fingerprints,
    html_text,
    licenses,
    mixing,
    mixing_model,
    near_duplicates,
    oracle,
    packing,
    periodic_runs,
    secrets,
    token_counts,
    toxicity,
)
from roadpulse.llm.common import table

VOCABULARY = os.environ.get("ROADPULSE_VOCABULARY", "/opt/tokenizers/word_bpe_49k.json")
PACKING_VOCABULARY = os.environ.get("ROADPULSE_PACKING_VOCABULARY") or public_tokenizers.path("byte_bpe_50k.json")

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _QUERIES[name] = fn
        return fn

    return register


@query("op1_html_text")
def _html_text(spark, sf_dir):
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op2_fingerprints")
def _fingerprints(spark, sf_dir):
    """Fingerprints of every text and its edited text, and their likeness."""
    return fingerprints.fingerprint(table(spark, sf_dir, "documents"))


@query("op3_near_duplicates")
def _near_duplicates(spark, sf_dir):
    """Class, text and number of links of every document at a similarity of 0.8."""
    found = near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "text_id", "n_links")


@query("op4_licenses")
def _licenses(spark, sf_dir):
    """License phrases and notices in every document."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query("op5_token_counts")
def _token_counts(spark, sf_dir):
    """Greedy word-piece counts of every document."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), VOCABULARY)


@query("op6_lm_scores")
def _lm_scores(spark, sf_dir):
    """Unigram and context-mixing scores of every document."""
    return mixing_model.score_texts(table(spark, sf_dir, "documents"))


@query("op7_mixing")
def _mixing(spark, sf_dir):
    """Documents repeated so that sources weigh the square root of what they did."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return mixing.poisson_mix(docs)


@query("op8_secrets")
def _secrets(spark, sf_dir):
    """Secrets in every document."""
    return secrets.digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


@query("op9_leaks")
def _leaks(spark, sf_dir):
    """Every document and benchmark item that it leaks."""
    found = decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_key")


@query("op10_toxicity")
def _toxicity(spark, sf_dir):
    """Toxicity score and evidence of every document."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_key")


@query("op11_packing")
def _packing(spark, sf_dir):
    """Pieces of every document and their places in sequences of 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), PACKING_VOCABULARY, with_ids=False)


@query("op12_runs")
def _runs(spark, sf_dir):
    """The longest periodic run of every document, and hashes of all runs and of what they leave."""
    return periodic_runs.digest(table(spark, sf_dir, "documents"))


@query("op13_clusters")
def _clusters(spark, sf_dir):
    """The cluster of every usable vector after five rounds."""
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    """The queries that SQL can express; tests hold the others against brute force."""
    return oracle.oracle_sql()

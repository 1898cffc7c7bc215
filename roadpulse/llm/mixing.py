"""Mixing sources to target weights by Poisson replication.

Every source has a target share of the mixture; its documents are repeated at the mean rate
that gives the source that share. The number of copies of a document is the inverse of the
Poisson distribution with that rate at a uniform value hashed from seed and doc_id, so it does
not depend on partitions, order or retries. Copies are exploded and dealt out globally by a
hash of document and copy.

Column expressions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import fresh, small, stored

# A rate above this is split into equal parts, each inverted with a hash of its own: sums of
# independent Poisson values are Poisson again, and a table of this length leaves out less
# than 1e-30 of a part.
PART = 32
TABLE = 160
# Sources that are joined as one small table; more are joined by a salted shuffle.
SMALL_SOURCES = 10_000
SALTS = 32


def _uniform(parts: str) -> str:
    """52 bits of an MD5 as a double in [0, 1)."""
    return f"cast(conv(substr(md5(concat_ws('|', {parts})), 1, 13), 16, 10) AS double) / 4503599627370496D"


def source_rates(docs: DataFrame, temperature: float, weights: dict[str, float] | None = None) -> DataFrame:
    """source and its mean repetition rate.

    A document weighs its characters plus one. Target shares are ``weights`` (sources that are
    not named get none), or else go with the ``temperature``-th power of a source's weight: 1
    keeps the mixture as it is, 0 makes all sources equal. The mixture keeps the total weight.
    Null is a source like any other.
    """
    size = F.length(F.coalesce(docs["text"], F.lit(""))) + 1
    sums = docs.groupBy(docs["source"].alias("source")).agg(F.sum(size.cast("long")).alias("size"))
    if weights is None:
        share = F.pow(F.col("size").cast("double"), F.lit(float(temperature)))
    else:
        names = F.create_map(*(F.lit(x) for pair in weights.items() for x in pair))
        share = F.coalesce(names[F.col("source")], F.lit(0.0)) if weights else F.lit(0.0)
    sums = sums.withColumn("share", share.cast("double"))
    totals = sums.agg(F.sum("size").alias("all_size"), F.sum("share").alias("all_share"))
    rate = F.expr("coalesce(try_divide(share * all_size, all_share * size), 0D)")
    return sums.join(F.broadcast(totals)).select("source", rate.alias("rate"))


def _inverse_tables(rates: DataFrame) -> DataFrame:
    """Adds the number of parts of each rate and the distribution function of one part."""
    parts = f"cast(greatest(1, ceil(rate / {PART})) AS int)"
    step = (
        "named_struct('p', s.p * l / k, 'c', array_append(s.c, element_at(s.c, -1) + s.p * l / k))"
    )
    grown = f"aggregate(sequence(1, {TABLE - 1}), named_struct('p', exp(-l), 'c', array(exp(-l))), (s, k) -> {step}).c"
    return (
        rates.withColumn("parts", F.expr(parts))
        .withColumn("l", F.expr("rate / parts"))
        .withColumn("cdf", F.expr(grown))
        .select("source", "parts", "cdf")
    )


def poisson_mix(
    docs: DataFrame,
    temperature: float = 0.5,
    weights: dict[str, float] | None = None,
    seed: int = 17,
) -> DataFrame:
    """All columns of ``docs`` plus copy (from 1) and shuffle_key, dealt out globally.

    Documents of a rate below one may have no copy; that is the feature. Rows that share a
    doc_id get the same number of copies. Null ids hash as the empty text, null sources are a
    source, null texts weigh one. If a document already has a column ``copy`` or
    ``shuffle_key``, the new one has underscores before its name.
    """
    copy, key = fresh(docs, "copy"), fresh(docs, "shuffle_key")
    tables = stored(_inverse_tables(source_rates(docs, temperature, weights)), "rates")
    theirs, salt, parts, cdf, copies = (fresh(docs, n) for n in ("_source", "_salt", "_parts", "_cdf", "_copies"))
    tables = tables.select(F.col("source").alias(theirs), F.col("parts").alias(parts), F.col("cdf").alias(cdf))
    if small(tables, SMALL_SOURCES):
        met = docs.join(F.broadcast(tables), docs["source"].eqNullSafe(tables[theirs]))
    else:
        spread = tables.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        left = docs.withColumn(f"{salt}l", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
        met = left.join(
            spread, left["source"].eqNullSafe(spread[theirs]) & (left[f"{salt}l"] == spread[salt])
        ).drop(salt, f"{salt}l")
    name = "coalesce(cast(doc_id AS string), '')"
    u = _uniform(f"'{seed}', j, {name}")
    draws = f"aggregate(sequence(1, {parts}), 0, (n, j) -> n + size(filter({cdf}, c -> c <= {u})))"
    # the uniform value is bound to a name, else it would be hashed for each entry of the table
    draws = (
        f"aggregate(transform(sequence(1, {parts}), j -> {u}), 0,"
        f" (n, x) -> n + size(filter({cdf}, c -> c <= x)))"
    )
    order = f"cast(conv(substr(md5(concat_ws('|', '{seed}', 'order', {copy}, {name})), 1, 13), 16, 10) AS bigint)"
    return (
        met.withColumn(copies, F.expr(draws))
        .filter(F.col(copies) > 0)
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
        .drop(theirs, parts, cdf, copies)
        .withColumn(key, F.expr(order))
        .repartition(F.col(key))
        .sortWithinPartitions(key)
    )

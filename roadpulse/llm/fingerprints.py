"""Document fingerprints by closed syncmers.

A text is a sequence of words; its k-mers are K consecutive words, and the inner substrings of a
k-mer are its runs of S words. A k-mer is taken if the smallest hash among its inner substrings
lies at the first or the last of them. That depends on the k-mer alone, so the same passage
gives the same anchors wherever it stands. The fingerprint is the hashes of the taken k-mers in
text order; two of them are compared by the Jaccard likeness of their anchors.

Column expressions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

K = 5
S = 2
# Characters of scripts that do not put spaces between words are words of their own.
_SOLID = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}"
# Documents are dealt out by ranges of doc_id; so many ranges at most.
MOST_RANGES = 4096


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def words(text: str) -> str:
    """SQL for the words of a text; the common case needs no character classes."""
    plain = rf"regexp_extract_all({text}, r'\S+', 0)"
    solid = rf"regexp_extract_all({text}, r'[{_SOLID}]|[^\s{_SOLID}]+', 0)"
    return f"CASE WHEN octet_length({text}) > length({text}) AND {text} RLIKE r'[{_SOLID}]' THEN {solid} ELSE {plain} END"


def anchors(text: str) -> str:
    """SQL for the anchors of a text: 32-bit hashes of its closed syncmers, in text order.

    A text of one to K - 1 words, or (of a few more) without any closed syncmer, has one anchor,
    the hash of all its words; a text without words has none.
    """
    runs = K - S + 1
    inner = ", ".join(f"s[i + {j}]" for j in range(1, runs - 1))
    taken = f"least(s[i], s[i + {runs - 1}]) <= least({inner})"
    value = f"hash(s[i], s[i + 2], s[i + {runs - 1}])"
    mers = f"transform(filter(sequence(0, size(s) - {runs}), i -> {taken}), i -> {value})"
    pairs = "zip_with(slice(w, 1, size(w) - 1), slice(w, 2, size(w) - 1), (a, b) -> xxhash64(a, b))"
    some = "if(size(m) = 0, array(hash(w)), m)"
    body = (
        f"CASE WHEN size(w) = 0 THEN cast(array() AS array<int>)"
        f" WHEN size(w) < {K} THEN array(hash(w)) ELSE {_let('m', _let('s', pairs, mers), some)} END"
    )
    return _let("w", words(text), body)


def as_text(a: str) -> str:
    """SQL for the fingerprint as a string: the anchors in text order, comma-joined."""
    return f"concat_ws(',', cast({a} AS array<string>))"


def likeness(a: str, b: str) -> str:
    """SQL for the Jaccard likeness of two lists of anchors; 1 for two empty ones."""
    return (
        f"CASE WHEN size({a}) = 0 AND size({b}) = 0 THEN 1D"
        f" ELSE cast(size(array_intersect({a}, {b})) AS double) / size(array_union({a}, {b})) END"
    )


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, anchors and those of the next document by doc_id, of the first after the last.

    Rows are dealt out by ranges of doc_id of about equal size, so nothing is sorted in one
    task. The first row of every range also goes to the range before it. Null ids stand first;
    rows that share an id stand in the order of their texts' hashes.
    """
    spark = docs.sparkSession
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    ).withColumn("key", F.xxhash64("text"))
    ranges = min(MOST_RANGES, 8 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    marks = ", ".join(str(i / ranges) for i in range(1, ranges))
    cuts = rows.agg(F.expr(f"percentile_approx(doc_id, array({marks}), {max(10_000, 10 * ranges)})").alias("c"))
    bounds = sorted(set(cuts.first()["c"] or []))
    place = "0"
    if bounds:
        listed = ", ".join(f"{b}L" for b in bounds)
        steps = ", ".join(str(1 << i) for i in reversed(range(len(bounds).bit_length())))
        # binary search for the number of bounds that are not above doc_id
        place = (
            f"CASE WHEN doc_id IS NULL THEN 0 ELSE aggregate(array({steps}), 0, (n, s) -> if("
            f"coalesce(get(array({listed}), n + s - 1) <= doc_id, false), n + s, n)) END"
        )
    placed = rows.withColumn("range", F.expr(place))
    # one row for each range, so this order may stand in one task
    by_range = Window.orderBy("range")
    firsts = placed.groupBy("range").agg(
        F.min("doc_id").alias("first_id"), F.max(F.col("doc_id").isNull()).alias("first_null")
    )
    firsts = firsts.withColumn("first_id", F.when(~F.col("first_null"), F.col("first_id")))
    last = firsts.agg(F.max("range").alias("last"))
    firsts = (
        firsts.withColumn("before", F.lag("range").over(by_range))
        .join(F.broadcast(last))
        .select(F.col("range").alias("of"), F.coalesce("before", "last").alias("before"), "first_id")
    )
    heads = (
        placed.join(
            F.broadcast(firsts),
            (F.col("range") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("first_id")),
        )
        .groupBy("before")
        .agg(F.min(F.struct("key", "text")).alias("head"))
        .select(F.col("before").alias("range"), F.lit(1).alias("tail"), F.lit(None).cast("long").alias("doc_id"), "head.key", "head.text")
    )
    body = placed.select("range", F.lit(0).alias("tail"), "doc_id", "key", "text")
    order = Window.partitionBy("range").orderBy("tail", F.col("doc_id").asc_nulls_first(), "key")
    return (
        body.unionByName(heads)
        .withColumn("a", F.expr(anchors("text")))
        .withColumn("next_text", F.lead("text").over(order))
        .withColumn("x", F.lead("a").over(order))
        .filter("tail = 0")
        .select("doc_id", "text", "a", "next_text", "x")
    )


def fingerprint(docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and their likeness.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many
    of the next document (`with_next`). One row per input row, repeated rows and null ids
    included; null texts are empty. Two texts without words have likeness 1; a text and one
    without words 0. The only document is its own next one. Further columns are left out.
    """
    half = "cast(floor(n_chars / 2) AS int)"
    rows = (
        with_next(docs)
        .withColumn("n_chars", F.length("text").cast("long"))
        .withColumn(
            "edited",
            F.expr(f"concat(substr(text, 1, cast(n_chars AS int) - {half}), substr(next_text, 1, {half}))"),
        )
        .select(
            "doc_id",
            "n_chars",
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            "a",
            F.expr(anchors("edited")).alias("e"),
            "x",
        )
    )
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.expr(as_text("a")).alias("fingerprint"),
        F.expr(as_text("e")).alias("edited_fingerprint"),
        F.expr(likeness("a", "e")).alias("near_edited"),
        F.expr(likeness("a", "x")).alias("near_next"),
    )
